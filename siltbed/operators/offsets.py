"""Where each topic-partition starts, and what lies past that point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators.small_side import MAX_BROADCAST_ROWS, small_side

KEYS = ["topic", "partition"]

EARLIEST, LATEST, NONE = "earliest", "latest", "none"

# The position each reset policy asks for, before clamping.
POLICY_POSITION = {EARLIEST: -1, LATEST: 9_223_372_036_854_775_807}


def next_offset(offset: Column) -> Column:
    """The offset to continue from once ``offset`` has been handled."""
    return offset + F.lit(1)


def partition_bounds(log: DataFrame) -> DataFrame:
    """Earliest offset and (exclusive) latest offset of every partition present.

    Partial aggregation leaves one row per task and partition for the shuffle,
    so one large partition costs no more than a small one.
    """
    return log.groupBy(*KEYS).agg(
        F.min("offset").alias("earliest"),
        next_offset(F.max("offset")).alias("latest"),
    )


# Offsets whose digest is made at a time where a range is compared with what was read of it.
BLOCK = 1 << 16


def _whole_digest(ranges: DataFrame) -> DataFrame:
    """Exclusive or of the hashes of all offsets of every range (topic, partition, start_offset, next_offset)."""
    last = F.col("next_offset") - 1
    block = F.sequence(F.col("a"), F.least(F.col("a") + (BLOCK - 1), last))
    digest = F.aggregate(block, F.lit(0).cast("bigint"), lambda d, o: d.bitwiseXOR(F.xxhash64(o)))
    blocks = ranges.select(*KEYS, "next_offset", F.explode(F.sequence(F.col("start_offset"), last, F.lit(BLOCK))).alias("a"))
    return blocks.select(*KEYS, digest.alias("d")).groupBy(*KEYS).agg(F.bit_xor("d").alias("whole_digest"))


def repeated_messages(rows: DataFrame, ranges: DataFrame) -> DataFrame | None:
    """(topic, partition, offset) of messages that ``rows`` holds more than once; None if there are none.

    ``ranges`` has (topic, partition, start_offset, next_offset, n_messages, digest)
    of the rows, the digest being the exclusive or of the offsets' hashes. A
    partition with as many messages as its range has offsets and that range's
    digest holds each offset once: nothing moves for it. Only rows of other
    partitions, with gaps or repeats, are grouped by offset, without their text.
    """
    odd = (
        ranges.join(_whole_digest(ranges), KEYS)
        .where(
            (F.col("n_messages") != F.col("next_offset") - F.col("start_offset"))
            | (F.col("digest") != F.col("whole_digest"))
        )
        .select(*KEYS)
    )
    if odd.isEmpty():
        return None
    narrow = rows.select(*KEYS, "offset").join(small_side(odd), KEYS, "left_semi")
    repeated = narrow.groupBy(*KEYS, "offset").agg(F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    return None if repeated.isEmpty() else repeated


def ledger_heads(ledger: DataFrame, group: str) -> DataFrame:
    """Saved next offset per topic-partition for one consumer group."""
    return (
        ledger.where(F.col("grp") == group).groupBy(*KEYS).agg(F.max("next_offset").alias("saved_offset"))
    )


def start_position(
    explicit: Column, saved: Column, earliest: Column, latest: Column, policy: str = EARLIEST
) -> Column:
    """Start offset of one partition.

    An explicit offset of 0 or more wins, then the saved offset, then a negative
    explicit offset as given, then the reset policy. The result is clamped into
    the range the log still holds. With no offset at all, policy ``none`` and
    unknown policies are errors.
    """
    wanted = F.coalesce(F.when(explicit >= 0, explicit), saved, explicit)
    if policy in POLICY_POSITION:
        wanted = F.coalesce(wanted, F.lit(POLICY_POSITION[policy]).cast("bigint"))
        return F.greatest(earliest, F.least(latest, wanted))
    # least() and greatest() skip NULLs, so the missing case must fail before the clamp.
    failure = F.raise_error(F.lit(f"no start offset is saved or given and the reset policy is {policy!r}"))
    return F.when(wanted.isNull(), failure.cast("bigint")).otherwise(
        F.greatest(earliest, F.least(latest, wanted))
    )


def resolve_start(
    bounds: DataFrame,
    saved: DataFrame,
    *,
    explicit: DataFrame | int | None = None,
    policy: str = EARLIEST,
) -> DataFrame:
    """``(topic, partition, start_offset)`` for every partition in ``bounds``.

    ``saved`` has (topic, partition, saved_offset); ``explicit`` is one offset for
    all partitions, or a frame (topic, partition, explicit_offset).
    """
    joined = bounds.join(small_side(saved), KEYS, "left")
    if isinstance(explicit, DataFrame):
        joined = joined.join(small_side(explicit), KEYS, "left")
    else:
        joined = joined.withColumn("explicit_offset", F.lit(explicit).cast("bigint"))
    start = start_position(
        F.col("explicit_offset"), F.col("saved_offset"), F.col("earliest"), F.col("latest"), policy
    )
    return joined.select(*KEYS, start.alias("start_offset"))


def incremental_scan(log: DataFrame, starts: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Log rows at or past their partition's start offset.

    ``starts`` is reduced to its smallest offset as well: that one value reaches
    the scan as a pushed filter, so files and row groups wholly below every
    start are not read.
    """
    floor = starts.agg(F.min("start_offset")).scalar()
    return (
        log.where(F.col("offset") >= floor)
        .join(small_side(starts, max_rows), KEYS)
        .where(F.col("offset") >= F.col("start_offset"))
        .drop("start_offset")
    )


def offset_gaps(ranges: DataFrame) -> DataFrame:
    """(topic, partition, gap_start, gap_next, n_missing): offsets between ranges of a partition that none covers.

    ``ranges`` has (topic, partition, start_offset, next_offset), in any order and
    with overlaps; empty ranges cover nothing. A gap is where the log no longer
    held what was wanted, or where a later start was asked for. Nothing is reported
    before a partition's first range and after its last.
    """
    along = Window.partitionBy(*KEYS).orderBy("start_offset", "next_offset")
    reach = F.max("next_offset").over(along.rowsBetween(Window.unboundedPreceding, -1))
    covered = ranges.where(F.col("start_offset") < F.col("next_offset"))
    return (
        covered.select(*KEYS, reach.alias("gap_start"), F.col("start_offset").alias("gap_next"))
        .where(F.col("gap_start") < F.col("gap_next"))
        .withColumn("n_missing", F.col("gap_next") - F.col("gap_start"))
    )
