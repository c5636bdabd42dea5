"""Route and file-name text: where a message belongs in the output tree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: suffix of the informational per-batch file name.
LINE_FILE_SUFFIX = ".lzo"


def path_prefix(output: str, topic: Column) -> Column:
    base = output if output.endswith("/") else output + "/"
    return F.concat(F.lit(base), topic, F.lit("/"))


def hour_route(event_day: Column, event_hour: Column) -> Column:
    """``Y-M-D/H`` without zero padding; NULL when the day or hour is NULL."""
    return F.concat(
        F.year(event_day).cast("string"),
        F.lit("-"),
        F.month(event_day).cast("string"),
        F.lit("-"),
        F.day(event_day).cast("string"),
        F.lit("/"),
        event_hour.cast("string"),
    )


def line_file_name(prefix: Column, route: Column, partition: Column, start_offset: Column) -> Column:
    """``<prefix><route>-<partition>.<start offset>.lzo``."""
    return F.concat(
        prefix,
        route,
        F.lit("-"),
        partition.cast("string"),
        F.lit("."),
        start_offset.cast("string"),
        F.lit(LINE_FILE_SUFFIX),
    )
