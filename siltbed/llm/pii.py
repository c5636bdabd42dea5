"""Personal data in plain and disguised form, with spans in the source text.

Base spans come from the text as it is. Then transducers rewrite it: look-alike
letters and digits become ASCII, zero-width characters go, spelled digits become
digits, and written-out "at" and "dot" become signs. Every character of the
result keeps the stretch of source characters it came from, so that an
identifier found in the rewritten text has a span in the source. Spans that
involve a rewritten character and lie in no base span of their kind are added.

Defined cases: null and empty texts have no spans; spans count code points, end
exclusive; candidates that fail their check (octets, Luhn, digit count) are
dropped without a second try.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import free_name, mapped

KINDS = ("email", "ip", "card", "phone")

# Fixed values of the contract: local part, domain, address, card and phone. Runs are
# taken possessively and only from their first character: a later start inside a run
# cannot match where the first one did not, and long runs would cost their square.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL_TAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(_EMAIL_TAIL)
_EMAIL = re.compile(rf"(?<![{_LOCAL}]){_EMAIL_TAIL}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str) -> bool:
    return 8 <= sum(c.isdigit() for c in text) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _EMAIL_HERE.match(text, at) or _EMAIL.search(text, at):
        yield m.span()
        at = m.end()


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    found = []
    if "@" in text:
        found += [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for kind, pattern, holds in (("ip", _IP, _octets), ("card", _CARD, _card), ("phone", _PHONE, _phone)):
            if kind != "phone" or "+" in text:
                found += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m.group())]
    return found


# Letters that look like ASCII ones, each with the letter it stands for.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "Ѕ": "S", "І": "I", "Ј": "J",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-",
    "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}
#: Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Digits as words.
DIGIT_WORDS = {w: str(n) for n, w in enumerate(("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"))}

_FOREIGN = re.compile(f"[{re.escape(''.join(LOOKALIKES))}{INVISIBLE}！-～]|(?![0-9])\\d")
_DIGIT_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_JOIN = r"(?:[\x20,-]{1,3}|\x20?dot\x20?)"
_SPELLED = re.compile(rf"(?:\bplus[\x20-])?\b(?:{_DIGIT_WORD}|[0-9]){_JOIN}(?:(?:{_DIGIT_WORD}|[0-9]){_JOIN}){{2,}}(?:{_DIGIT_WORD}|[0-9])\b", re.I)
_SPELLED_PART = re.compile(rf"plus[\x20-]|{_DIGIT_WORD}|\x20?dot\x20?|[\x20,-]+", re.I)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = re.compile(rf"\x20*{_OPEN}\x20*(?:at|@)\x20*{_CLOSE}\x20*", re.I)
_DOT = re.compile(rf"\x20*{_OPEN}\x20*(?:dot|\.)\x20*{_CLOSE}\x20*", re.I)
#: Endings that tell a spoken address ("joe at example dot com") from prose with "at" and "dot".
ENDINGS = "com|org|net|edu|gov|info|io|ai|eu|de|fr|es|it|nl|ch|at|uk|us|ca|au|jp|cn|br|in|ru|pl|se"
_AT_DOT = re.compile(
    rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:\x20at\x20|@|\x20@\x20)[A-Za-z0-9-]+(?:(?:\x20dot\x20|\.|\x20\.\x20)[A-Za-z0-9-]+)*?"
    rf"(?:\x20dot\x20|\.)(?:{ENDINGS})\b",
    re.I,
)
_AT_DOT_PART = re.compile(r"\x20(?:at|dot|@|\.)\x20", re.I)


class Rewritten:
    """A text, the source stretch of each of its characters, and which of them were rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.new = bytearray(len(text))

    def apply(self, pattern: re.Pattern, make: Callable[[str], str]) -> None:
        """Replace each match by nothing or by one character."""
        out, start, end, new, gone, at = [], [], [], bytearray(), [], 0
        for m in pattern.finditer(self.text):
            s, e = m.span()
            put = make(m.group())
            out += [self.text[at:s], put]
            start += self.start[at:s]
            end += self.end[at:s]
            new += self.new[at:s]
            if put:
                start.append(self.start[s])
                end.append(self.end[e - 1])
                new.append(1)
            else:
                gone.append(len(new))
            at = e
        if at:
            self.text = "".join([*out, self.text[at:]])
            self.start, self.end, self.new = start + self.start[at:], end + self.end[at:], new + self.new[at:]
            # What follows a removed character has a new neighbour.
            for place in gone:
                if place < len(self.new):
                    self.new[place] = 1

    def within(self, outer: re.Pattern, inner: re.Pattern, make: Callable[[str], str]) -> None:
        """Apply ``inner`` inside the matches of ``outer`` only."""
        zones = [m.span() for m in outer.finditer(self.text)]
        if not zones:
            return
        parts, at = [], 0
        for s, e in [*zones, (len(self.text), len(self.text))]:
            parts += [(at, s, False), (s, e, True)]
            at = e
        done = Rewritten("")
        for s, e, inside in parts:
            piece = Rewritten("")
            piece.text, piece.start, piece.end, piece.new = self.text[s:e], self.start[s:e], self.end[s:e], self.new[s:e]
            if inside:
                piece.apply(inner, make)
            done.text += piece.text
            done.start += piece.start
            done.end += piece.end
            done.new += piece.new
        self.text, self.start, self.end, self.new = done.text, done.start, done.end, done.new


def _plain(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    return LOOKALIKES.get(c) or str(unicodedata.decimal(c))


def _spelled(part: str) -> str:
    word = part.strip(" ,-").lower()
    return "+" if word == "plus" else "." if word == "dot" else DIGIT_WORDS.get(word, "")


def _sign(part: str) -> str:
    return "@" if part.strip().lower() in ("at", "@") else "."


def rewrite(text: str) -> Rewritten | None:
    """None if no transducer changes the text."""
    now = Rewritten("")
    state = None
    if not text.isascii() and _FOREIGN.search(text):
        state = now = Rewritten(text)
        now.apply(_FOREIGN, _plain)
    low = (state.text if state else text).lower()
    spoken = (" at " in low or "@" in low) and _AT_DOT.search(low)
    if spoken or _AT.search(low) or _DOT.search(low) or _SPELLED.search(low):
        if state is None:
            state = now = Rewritten(text)
        now.within(_SPELLED, _SPELLED_PART, _spelled)
        now.apply(_AT, lambda _: "@")
        now.apply(_DOT, lambda _: ".")
        now.within(_AT_DOT, _AT_DOT_PART, _sign)
    return state if state is not None and any(state.new) else None


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the spans that the transducers add, each by kind as listed, then start."""
    if not text:
        return [], []
    base = detect(text)
    now = rewrite(text)
    if now is None:
        return base, []
    more = []
    for kind, s, e in detect(now.text):
        if any(now.new[s:e]):
            a, b = now.start[s], now.end[e - 1]
            if not any(k == kind and x <= a and b <= y for k, x, y in base):
                more.append((kind, a, b))
    return base, more


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans (base and added) and n_added of every document."""
    schema = "doc_id bigint, " + "".join(f"n_{k} bigint, " for k in KINDS) + "base_sha256 string, spans string, n_added bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, added = [[] for _ in KINDS], [], [], []
            for text in batch.column("text"):
                base, more = find(text.as_py())
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(x[0] == kind for x in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                every = _ordered(base + more)
                spans.append(_joined(every))
                added.append(len(every) - len(base))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string())]
            columns += [pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").transform(mapped, run, schema)


def masked(text: str) -> str:
    """The text with every identifier replaced by its kind in brackets; overlapping spans are one, of the first's kind."""
    base, more = find(text)
    out, at = [], 0
    for kind, s, e in sorted(base + more, key=lambda x: (x[1], -x[2])):
        if s < at:
            if e > at:
                at = e
            continue
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def mask(documents: DataFrame) -> DataFrame:
    """The documents with identifiers masked; ``n_chars`` is that of the new text. A null text stays null."""
    names = documents.columns
    spare = free_name(names, "masked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if (t := x.as_py()) is None else masked(t) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, spare])

    schema = T.StructType([*documents.schema.fields, T.StructField(spare, T.StringType())])
    done = documents.transform(mapped, run, schema).withColumn("text", F.col(spare))
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length("text").cast("bigint"))
    return done.select(*names)
