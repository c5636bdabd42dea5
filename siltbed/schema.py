"""Row types of the log, the landed tables and the offset ledger."""

from __future__ import annotations

from pyspark.sql import types as T


# By type name, because parsing a DDL string needs a running session.
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LOG_SCHEMA = _schema("topic string, partition int, offset bigint, key string, value string")

# One row per topic-partition and commit; next_offset is exclusive. Messages and characters are those the batch
# read at or past the saved position; the times are epoch milliseconds of the batch's start and its ledger entry;
# the sketch counts the routes of its landed rows and can be merged with others.
LEDGER_SCHEMA = _schema(
    "topic string, grp string, partition int, start_offset bigint, next_offset bigint, "
    "batch_id bigint, commit_key string, n_messages bigint, fetch_chars bigint, opened_ms bigint, committed_ms bigint, "
    "routes_sketch binary"
)

# What a ledger's snapshot keeps of it.
LEDGER_HEADS_SCHEMA = _schema("topic string, grp string, partition int, next_offset bigint")

# What a compaction put in, took out and holds since: a pack of a day, or a commit.
MANIFEST_SCHEMA = _schema("action string, day string, pack string, commit_key string, n_rows bigint")

# Offsets that one file of a log holds of a partition; topic and partition are null for a file without rows.
ZONES_SCHEMA = _schema("path string, uri string, topic string, partition int, earliest bigint, latest bigint")

# Start-offset input: latest is exclusive.
BOUNDS_SCHEMA = _schema("topic string, partition int, earliest bigint, latest bigint")

# Bucket columns of the two kinds of mapper.
HOUR_BUCKETS = _schema("event_day date, event_hour int")
ROUTE_BUCKETS = _schema("route string")


def messages_schema(buckets: T.StructType) -> T.StructType:
    """Rows of the messages table: data columns, then directory columns.

    Declared in full, because the type of a directory column would otherwise be
    guessed from its text.
    """
    data = _schema("partition int, offset bigint, line string, reject_reason string, chars int")
    directories = _schema("commit_key string, outcome string, topic string")
    return T.StructType([*data.fields, *directories.fields, *buckets.fields])


def packs_schema(buckets: T.StructType) -> T.StructType:
    """Rows of the packs: those of landed messages, with the day's directory above the pack's."""
    data = _schema("partition int, offset bigint, line string, commit_key string")
    first, *others = buckets.fields
    return T.StructType([*data.fields, *_schema("topic string").fields, first, *_schema("pack string").fields, *others])
