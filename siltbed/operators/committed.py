"""The exactly-once view of the landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators.offsets import KEYS
from siltbed.operators.small_side import MAX_BROADCAST_ROWS, small_side


def disjoint_ranges(commits: DataFrame) -> DataFrame:
    """(topic, partition, commit_key, start_offset, next_offset) without overlaps: the first commit of an offset has it.

    ``commits`` has a row per topic, partition and commit. First is the one with
    the earliest ``committed_ms``, then the smallest ``batch_id``, then
    ``commit_key``; entries without a time come first. Ranges that touch no other,
    nearly all, pass as they are. The others of one stretch are cut at each other's
    bounds, and each cut goes to its first commit. Empty ranges have no messages
    and are left out.
    """
    ranges = commits.where(F.col("start_offset") < F.col("next_offset")).select(
        *KEYS,
        "commit_key",
        "start_offset",
        "next_offset",
        F.struct(F.col("committed_ms"), F.col("batch_id"), F.col("commit_key")).alias("turn"),
    )
    along = Window.partitionBy(*KEYS).orderBy("start_offset", "next_offset", "turn")
    reach = F.max("next_offset").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start_offset") >= reach), 1).otherwise(0)
    placed = ranges.withColumn("opens", opens).withColumn("stretch", F.sum("opens").over(along))
    sizes = placed.withColumn("n", F.count("*").over(Window.partitionBy(*KEYS, "stretch")))
    columns = [*KEYS, "commit_key", "start_offset", "next_offset"]
    shared = sizes.where(F.col("n") > 1)
    at = [*KEYS, "stretch"]
    bounds = shared.select(*at, F.explode(F.array("start_offset", "next_offset")).alias("low")).distinct()
    cuts = bounds.withColumn("high", F.lead("low").over(Window.partitionBy(*at).orderBy("low"))).where("high is not null")
    owned = (
        cuts.join(shared, at)
        .where((F.col("start_offset") <= F.col("low")) & (F.col("next_offset") >= F.col("high")))
        .groupBy(*at, "low", "high")
        .agg(F.min(F.struct("turn", "commit_key")).alias("first"))
        .select(*KEYS, "first.commit_key", F.col("low").alias("start_offset"), F.col("high").alias("next_offset"))
    )
    return sizes.where(F.col("n") == 1).select(*columns).unionByName(owned)


def committed_read(
    landed: DataFrame, commits: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Landed rows whose batch is in the ledger.

    ``commits`` has one (topic, commit_key) per commit. Files of an abandoned
    attempt, or of one replayed with other boundaries, have a key the ledger does
    not hold and stay hidden. Both join columns are
    directories: a broadcast of the commits prunes the ones to skip before they
    are read. More commits than ``max_rows`` are joined by shuffle instead.

    If ``commits`` has the partition and range of each as well, as
    ``disjoint_ranges`` gives them, a row must also lie in a range of its commit,
    so that messages which two commits hold come once.
    """
    if "start_offset" not in commits.columns:
        return landed.join(small_side(commits, max_rows), ["topic", "commit_key"], "left_semi")
    ranges = small_side(commits.select(*(F.col(c).alias(f"in_{c}") for c in (*KEYS, "commit_key", "start_offset", "next_offset"))), max_rows)
    inside = (
        (F.col("topic") == F.col("in_topic"))
        & (F.col("commit_key") == F.col("in_commit_key"))
        & (F.col("partition") == F.col("in_partition"))
        & (F.col("offset") >= F.col("in_start_offset"))
        & (F.col("offset") < F.col("in_next_offset"))
    )
    return landed.join(ranges, inside, "left_semi")
