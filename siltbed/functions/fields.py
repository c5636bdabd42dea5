"""Field-level expressions over one delimited text message.

Everything here works on the UTF-8 bytes of the column (trim, replace,
substring_index), so a message is never decoded into an array of fields just
to look at one of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Optional sign, ASCII digits, nothing else; \z because $ would let a final newline through.
STRICT_LONG_PATTERN = r"^[+-]?[0-9]+\z"


def check_delimiter(delimiter: str) -> str:
    if len(delimiter) != 1 or not delimiter.isascii():
        raise ValueError(f"delimiter must be one ASCII character, got {delimiter!r}")
    return delimiter


def field_count(value: Column, delimiter: str = ",") -> Column:
    """Number of fields when trailing empty fields do not count.

    The empty message has one (empty) field; a message of delimiters only has none.
    """
    check_delimiter(delimiter)
    # Trimming walks the whole message, so only those that need it are trimmed.
    padded = value.endswith(delimiter)
    kept = F.when(padded, F.rtrim(value, F.lit(delimiter))).otherwise(value)
    delimiters = F.octet_length(kept) - F.octet_length(F.replace(kept, F.lit(delimiter), F.lit("")))
    return F.when(padded & (kept == ""), F.lit(0)).otherwise(delimiters + 1)


def field_at(value: Column, index: int, delimiter: str = ",", n_fields: Column | None = None) -> Column:
    """Zero-based field, NULL when the message has no such field.

    Pass ``n_fields`` when the count is already a column, to spare counting again.
    """
    check_delimiter(delimiter)
    if n_fields is None:
        n_fields = field_count(value, delimiter)
    head = F.substring_index(value, delimiter, index + 1)
    return F.when(n_fields > index, F.substring_index(head, delimiter, -1))


def strict_long(text: Column) -> Column:
    """64-bit integer, or NULL unless the text is exactly a signed run of digits in range."""
    return F.when(text.rlike(STRICT_LONG_PATTERN), text.try_cast("bigint"))


def utf16_length(value: Column) -> Column:
    """Message size in UTF-16 units, NULL counted as 0.

    Only a message with non-ASCII bytes is re-encoded.
    """
    chars = F.char_length(value)
    encoded = F.octet_length(F.encode(value, "UTF-16BE"))
    size = F.when(F.octet_length(value) == chars, chars).otherwise(F.shiftright(encoded, 1))
    return F.coalesce(size, F.lit(0)).cast("bigint")


def decode_text(data: Column) -> Column:
    """UTF-8 text from bytes, each malformed sequence replaced by U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))
