"""What one uncommitted batch holds, and whether it is due for a commit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions import utf16_length
from siltbed.operators.offsets import KEYS, next_offset


@dataclass(frozen=True)
class RolloverPolicy:
    """Commit a batch once any threshold is reached.

    The defaults are fixed values: 64 Mi characters, 30 minutes, 20 open paths
    per partition. As triggers, the size and age thresholds become source
    options; sizes are then bytes or offsets, so the character count is
    approximated through ``mean_message_chars``.
    """

    max_chars: int = 64 * 1024 * 1024
    max_age_ms: int = 30 * 60 * 1000
    max_routes: int = 20
    mean_message_chars: int = 256

    def admitted_chars(self, width: int = 1, chars_per_ms: float = 0.0) -> int:
        """Characters of the next batch: the size threshold for each of ``width`` readers, or, if that is more,
        what the measured rate reads within the age threshold. So a batch grows with the cluster and its throughput."""
        return max(self.max_chars * max(1, width), int(chars_per_ms * self.max_age_ms))

    def kafka_options(self, width: int = 1, chars_per_ms: float = 0.0) -> dict[str, str]:
        offsets = max(1, self.admitted_chars(width, chars_per_ms) // self.mean_message_chars)
        return {
            "minOffsetsPerTrigger": str(offsets),
            "maxOffsetsPerTrigger": str(offsets),
            "maxTriggerDelay": f"{self.max_age_ms}ms",
        }

    def file_options(self, width: int = 1, chars_per_ms: float = 0.0) -> dict[str, str]:
        return {"maxBytesPerTrigger": str(self.admitted_chars(width, chars_per_ms))}

    def processing_time(self) -> str:
        return f"{self.max_age_ms} milliseconds"


def batch_commit_metrics(mapped: DataFrame, *extra_keys: str) -> DataFrame:
    """Characters, distinct routes and offset range per topic-partition.

    Characters and offsets count every message, rejected ones included; routes
    count accepted ones. Both the distinct and the plain aggregates combine
    before the shuffle, so what moves is one row per task, partition and route.
    """
    route = F.when(F.col("reject_reason").isNull(), F.col("route"))
    return mapped.groupBy(*KEYS, *extra_keys).agg(
        F.sum(utf16_length(F.col("line"))).alias("fetch_chars"),
        F.count_distinct(route).alias("n_routes"),
        F.min("offset").alias("start_offset"),
        next_offset(F.max("offset")).alias("next_offset"),
    )


#: Bits of a route sketch's size: its estimates have a standard error of about 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12


def route_sketch(route: Column) -> Column:
    """Aggregate: a mergeable sketch of the distinct routes, a few KB at most however many there are."""
    return F.hll_sketch_agg(route, F.lit(SKETCH_BITS))


def routes_of_commits(commits: DataFrame) -> DataFrame:
    """(topic, partition, n_commits, n_routes): estimated distinct routes over all commits, from their sketches alone.

    ``commits`` are ledger rows. One without a sketch counts as a commit without routes.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("routes_sketch"))
    return commits.groupBy(*KEYS).agg(
        F.count("*").alias("n_commits"),
        F.when(F.count("routes_sketch") > 0, merged).otherwise(F.lit(0)).cast("bigint").alias("n_routes"),
    )


def rollover_reason(
    fetch_chars: Column, age_ms: Column, n_routes: Column, policy: RolloverPolicy = RolloverPolicy()
) -> Column:
    """First threshold reached: ``size``, ``age`` or ``paths``; NULL when none is."""
    return (
        F.when(fetch_chars >= policy.max_chars, "size")
        .when(age_ms >= policy.max_age_ms, "age")
        .when(n_routes >= policy.max_routes, "paths")
    )


def read_rate(commits: DataFrame, last: int = 16) -> float:
    """Characters per millisecond over the last commits of a ledger; 0.0 where none has times."""
    timed = commits.where(F.col("committed_ms") > F.col("opened_ms")).groupBy("commit_key")
    each = timed.agg(F.sum("fetch_chars").alias("chars"), F.max("committed_ms").alias("at"), F.min("opened_ms").alias("opened"))
    recent = each.orderBy(F.desc("at")).limit(last)
    row = recent.agg(F.sum("chars").alias("chars"), F.sum(F.col("at") - F.col("opened")).alias("ms")).first()
    return float(row["chars"]) / row["ms"] if row["ms"] and row["chars"] else 0.0
