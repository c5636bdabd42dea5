from siltbed.functions.event_time import (
    DEFAULT_UTC_OFFSET_HOURS,
    MAX_EPOCH_MS,
    in_supported_range,
    local_day,
    local_hour,
)
from siltbed.functions.fields import (
    check_delimiter,
    decode_text,
    field_at,
    field_count,
    strict_long,
    utf16_length,
)
from siltbed.functions.routes import LINE_FILE_SUFFIX, hour_route, line_file_name, path_prefix

__all__ = [
    "DEFAULT_UTC_OFFSET_HOURS",
    "LINE_FILE_SUFFIX",
    "MAX_EPOCH_MS",
    "check_delimiter",
    "decode_text",
    "field_at",
    "field_count",
    "hour_route",
    "in_supported_range",
    "line_file_name",
    "local_day",
    "local_hour",
    "path_prefix",
    "strict_long",
    "utf16_length",
]
