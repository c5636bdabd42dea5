"""The landing job: a log stream to landed rows, exactly once.

A micro-batch is committed in this order: its rows are written under a commit
key, its offset ranges and key are added to the ledger, Spark records the batch
in its checkpoint. The key is the query id and the batch id, which a restart
from the checkpoint keeps. A failure before the ledger write leaves rows that
the replay overwrites and that ``committed`` does not show; after it, the replay
finds its key in the ledger and does nothing. A query that has lost its
checkpoint has a new id, and starts from the positions in the ledger, which it
notes in its checkpoint: rows below them were landed before and are skipped.
Any other row below the saved position has come late. It is kept as a reject
with the reason ``behind_position``; nothing a stream reads goes without trace.
"""

from __future__ import annotations

import inspect
import json
import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltbed.functions import hour_route, utf16_length
from siltbed.operators.committed import committed_read, disjoint_ranges
from siltbed.operators.mapping import Mapper, get_mapper
from siltbed.operators.metrics import RolloverPolicy, read_rate, route_sketch, routes_of_commits
from siltbed.operators.offsets import EARLIEST, KEYS, next_offset, offset_gaps, partition_bounds, repeated_messages, resolve_start
from siltbed.operators.small_side import MAX_BROADCAST_ROWS, small_side
from siltbed.sources.log import FileLog, FrameLog, KafkaLog, kafka_starting_offsets
from siltbed.streaming.ledger import OffsetLedger
from siltbed.streaming.packs import MAX_FOLDERS, PackManifest, day_text
from siltbed.streaming.tables import (
    LANDED,
    REJECTED,
    path_exists,
    read_commit,
    read_landed,
    read_landed_commits,
    read_or_empty,
    read_rejected,
    write_messages,
)

LOGGER = logging.getLogger(__name__)

REQUIRED = ("source", "topic", "group", "mapper", "output")

# batch_id of ledger rows that record a chosen start position, not a batch.
OPENING_BATCH = -1

BEHIND_POSITION = "behind_position"


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


class OutOfOrderError(RuntimeError):
    """A batch holds offsets below the position this run has already committed."""


@dataclass
class LandingJob:
    """Settings and commit logic of one landing query.

    ``start_offset`` and ``auto_offset_reset`` apply when the query has no
    checkpoint yet; after that it resumes. ``parameters`` is a dict or a JSON
    object of keyword arguments for the mapper; other text is handed to it as
    ``parameters``.

    ``rollover`` bounds the batches of a stream, those of a backlog too; None
    leaves them unbounded, and a source with trigger options of its own keeps
    those. The bound is for ``n_partitions`` partitions, by default as many as the
    cluster has task slots, or what the last commits' rate reads within the
    policy's age, if that is more. ``clock`` gives the epoch milliseconds that a
    commit is opened and closed at.
    """

    source: FileLog | FrameLog | KafkaLog | None = None
    topic: str | None = None
    group: str | None = None
    mapper: str | Mapper | None = None
    output: str | None = None
    parameters: dict | str = field(default_factory=dict)
    app_name: str = "log_landing"
    start_offset: int | None = None
    auto_offset_reset: str = EARLIEST
    checkpoint: str | None = None
    rebalance: bool = False
    rollover: RolloverPolicy | None = field(default_factory=RolloverPolicy)
    n_partitions: int | None = None
    max_broadcast_rows: int = MAX_BROADCAST_ROWS
    clock: Callable[[], int] = _now_ms

    def __post_init__(self):
        missing = [name for name in REQUIRED if not getattr(self, name)]
        if missing:
            raise ValueError(f"landing job is missing: {', '.join(missing)}")
        self.mapper = get_mapper(self.mapper)
        self.output = self.output.rstrip("/")
        self.checkpoint = self.checkpoint or f"{self.output}/checkpoint/{self.topic}/{self.group}"

    # -- running -------------------------------------------------------------

    def start(self, spark: SparkSession, processing_time: str | None = None) -> StreamingQuery:
        """Start the query: everything available now and stop, or one batch per interval."""
        if isinstance(self.source, FrameLog):
            raise ValueError("a DataFrame cannot be streamed; use run_batch, or a FileLog or KafkaLog")
        source = self._bounded(self._open(spark), spark)
        opening = small_side(self._opening(spark), self.max_broadcast_rows)
        log = source.stream(spark).where(F.col("topic") == self.topic)
        query_id: Future[str] = Future()

        def land(batch: DataFrame, batch_id: int) -> None:
            key = f"{query_id.result()}-{batch_id}"
            self.land_batch(batch, batch_id, opening, commit_key=key, keep_late=True)

        trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
        query = (
            # Selected here because a micro-batch is handed over with its columns fixed.
            self._inputs(log)
            .writeStream.queryName(self.app_name)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .foreachBatch(land)
            .start()
        )
        query_id.set_result(query.id)
        return query

    def run(self, spark: SparkSession) -> None:
        """Land everything available now."""
        self.start(spark).awaitTermination()

    def run_batch(self, spark: SparkSession, batch_id: int = 0) -> None:
        """Land the source's current content as one bounded batch, without a checkpoint."""
        log = self._open(spark).read(spark)
        self.land_batch(log.where(F.col("topic") == self.topic), batch_id)

    def _bounded(self, source: FileLog | KafkaLog, spark: SparkSession | None = None) -> FileLog | KafkaLog:
        """The source with the rollover limits as its trigger options."""
        if self.rollover is None or any("pertrigger" in option.lower() for option in source.options):
            return source
        width, rate = self.n_partitions or getattr(source, "n_partitions", None), 0.0
        if spark is not None:
            width = width or spark.sparkContext.defaultParallelism
            commits = OffsetLedger(spark, self.output).commits(self.group)
            rate = read_rate(commits.where(F.col("topic") == self.topic))
        options = self.rollover.kafka_options if isinstance(source, KafkaLog) else self.rollover.file_options
        return replace(source, options={**options(width or 1, rate), **source.options})

    def _opening(self, spark: SparkSession) -> DataFrame:
        """Saved positions when the checkpoint was new; a query that resumes keeps those."""
        path = f"{self.checkpoint}/opening"
        if not path_exists(spark, f"{self.checkpoint}/metadata"):
            OffsetLedger(spark, self.output).heads(self.group).write.mode("overwrite").parquet(path)
        heads = "topic string, partition int, saved_offset bigint"
        return read_or_empty(spark, path, T.StructType.fromDDL(heads)).where(F.col("topic") == self.topic)

    def _open(self, spark: SparkSession) -> FileLog | FrameLog | KafkaLog:
        """Check the output root and settle where a new query starts."""
        ledger = OffsetLedger(spark, self.output)
        if not ledger.read().where(F.col("grp") != self.group).isEmpty():
            raise ValueError(f"{self.output} belongs to another consumer group; use one output root per group")
        if path_exists(spark, f"{self.checkpoint}/metadata"):
            return self.source
        explicit = self.start_offset
        chosen = explicit is not None and explicit >= 0
        saved = ledger.heads(self.group).where(F.col("topic") == self.topic)
        if chosen and not saved.where(F.col("saved_offset") > explicit).isEmpty():
            raise ValueError("start offset is below a committed one; a rewind needs a new output root")
        if isinstance(self.source, KafkaLog):
            return self._open_topic(saved, explicit)
        # A negative explicit offset is below every log, so it means its start, as the default does.
        if chosen or (explicit is None and self.auto_offset_reset != EARLIEST):
            bounds = partition_bounds(self.source.read(spark).where(F.col("topic") == self.topic))
            starts = resolve_start(bounds, saved, explicit=explicit, policy=self.auto_offset_reset)
            # Saved as empty ranges, so that a restart before the first commit starts from the same place.
            ledger.append(self._ranges(starts.withColumn("next_offset", F.col("start_offset")), OPENING_BATCH), self.topic)
        return self.source

    def _open_topic(self, saved: DataFrame, explicit: int | None) -> KafkaLog:
        # One number per topic-partition: the same map the connector keeps on the driver.
        positions = {row["partition"]: row["saved_offset"] for row in saved.toLocalIterator()}
        if not positions and explicit is None and self.auto_offset_reset in ("earliest", "latest"):
            return replace(self.source, starting_offsets=self.auto_offset_reset)
        if not positions and explicit is not None and explicit < 0:
            return replace(self.source, starting_offsets=EARLIEST)
        if self.source.n_partitions is None:
            raise ValueError("starting from given or saved offsets needs KafkaLog.n_partitions")
        offsets = kafka_starting_offsets(
            self.topic, self.source.n_partitions, positions, explicit, self.auto_offset_reset
        )
        return replace(self.source, starting_offsets=offsets)

    # -- one batch -----------------------------------------------------------

    def land_batch(
        self,
        batch: DataFrame,
        batch_id: int,
        opening: DataFrame | None = None,
        *,
        commit_key: str | None = None,
        keep_late: bool = False,
        commit: bool = True,
    ) -> None:
        """Land one bounded batch of log rows and commit its offsets.

        ``opening`` holds the saved positions when the run began; by default the
        current ones. Rows below them were committed by an earlier run and are
        skipped. Other rows below the current position are out of order: an error,
        or with ``keep_late`` rejects with a reason.

        The batch is read once. A total mapper's rows are the messages, so late ones
        are marked among its output, and offset ranges and sizes are read back from
        narrow columns of the files just written. Another mapper may drop or repeat messages, so its
        batch is persisted and measured there. Ranges and sizes cover accepted,
        rejected and dropped messages alike. A message that the batch holds twice
        lands once: the batch is then written again.

        ``commit=False`` leaves the rows provisional, as a failure just before the
        ledger write would. So does a second writer of the topic that commits while
        this batch runs: the batch fails with FencedWriterError, and when it is offered
        again it starts from the other's positions.
        """
        opened_ms = self.clock()
        ledger = OffsetLedger(batch.sparkSession, self.output)
        if commit_key is None:
            commit_key = f"{uuid.uuid4()}-{batch_id}"
        elif ledger.has_commit(commit_key):
            LOGGER.info("batch %s is already committed", batch_id)
            return
        # Before the positions are read: a commit of another writer from here on is noticed by its number.
        entry = ledger.last(self.topic)
        heads = small_side(ledger.heads(self.group), self.max_broadcast_rows)
        rows = (
            self._inputs(batch)
            .join(heads if opening is None else opening, KEYS, "left")
            .where(F.col("saved_offset").isNull() | (F.col("offset") >= F.col("saved_offset")))
            .drop("saved_offset")
        )
        kept: list[DataFrame] = []
        try:
            if not self.mapper.total:
                rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(rows)
            write = self._write_total if self.mapper.total else self._write_other
            messages, late = write(rows, heads, commit_key, keep_late)
            ranges = self._checked_ranges(messages, heads, kept)
            repeated = None if ranges is None else repeated_messages(messages, ranges)
            if repeated is not None:
                LOGGER.warning("batch %s holds messages more than once; each lands once", batch_id)
                # Written down before the files that it was found in are replaced.
                path = f"{self.output}/repeats/{commit_key}"
                repeated.write.mode("overwrite").parquet(path)
                once = self._once(rows, batch.sparkSession.read.schema(repeated.schema).parquet(path))
                messages, late = write(once, heads, commit_key, keep_late)
                ranges = self._checked_ranges(messages, heads, kept)
            if late is not None:
                ranges = self._with_late(ranges, late, ledger, kept)
            if commit and ranges is not None:
                ranges = ranges.join(self._sketches(batch.sparkSession, commit_key), KEYS, "left")
                ledger.append(self._ranges(ranges, batch_id, commit_key, opened_ms, self.clock()), self.topic, entry)
                LOGGER.info("batch %s is committed", batch_id)
        finally:
            for frame in kept:
                frame.unpersist()

    def _write_total(
        self, rows: DataFrame, heads: DataFrame, commit_key: str, keep_late: bool
    ) -> tuple[DataFrame, DataFrame | None]:
        """Write by a mapper with one row a message; (messages, late ones or None) read back."""
        mapped = self.mapper(rows, **self._mapper_arguments())
        is_behind = F.coalesce(F.col("reject_reason") == BEHIND_POSITION, F.lit(False))
        if keep_late:
            if "reject_reason" not in mapped.columns:
                mapped = mapped.withColumn("reject_reason", F.lit(None).cast("string"))
            reason = F.when(F.col("offset") < F.col("saved_offset"), BEHIND_POSITION).otherwise(F.col("reject_reason"))
            mapped = mapped.join(heads, KEYS, "left").withColumn("reject_reason", reason).drop("saved_offset")
        write_messages(mapped, self.output, commit_key, self.mapper.buckets, rebalance=self.rebalance)
        written = read_commit(rows.sparkSession, self.output, commit_key, self.mapper.buckets)
        # Rejects have a folder of their own, so this look at their reasons opens no other file.
        if not keep_late or written.where((F.col("outcome") == REJECTED) & is_behind).isEmpty():
            return written, None
        return written.where(~is_behind), written.where((F.col("outcome") == REJECTED) & is_behind)

    def _write_other(
        self, rows: DataFrame, heads: DataFrame, commit_key: str, keep_late: bool
    ) -> tuple[DataFrame, DataFrame | None]:
        """Write by a mapper that may drop or multiply messages; (messages, late ones or None) of the persisted rows."""
        fresh, late = rows, None
        if keep_late:
            placed = rows.join(heads, KEYS, "left")
            is_late = F.coalesce(F.col("offset") < F.col("saved_offset"), F.lit(False))
            late, fresh = placed.where(is_late).drop("saved_offset"), placed.where(~is_late).drop("saved_offset")
            late = None if late.isEmpty() else late
        mapped = self.mapper(fresh, **self._mapper_arguments())
        if late is not None:
            reason = F.lit(BEHIND_POSITION).alias("reject_reason")
            rejects = late.select(*KEYS, "offset", F.col("value").alias("line"), reason)
            mapped = mapped.unionByName(rejects, allowMissingColumns=True)
        write_messages(mapped, self.output, commit_key, self.mapper.buckets, rebalance=self.rebalance)
        return fresh.withColumn("chars", utf16_length(F.col("value"))), late

    def _once(self, rows: DataFrame, repeated: DataFrame) -> DataFrame:
        """``rows`` with one of each repeated message; only those are shuffled."""
        key = [*KEYS, "offset"]
        repeated = small_side(repeated, self.max_broadcast_rows)
        others = [c for c in rows.columns if c not in key]
        one = rows.join(repeated, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*others)).alias("one"))
        return rows.join(repeated, key, "left_anti").unionByName(one.select(*key, "one.*"))

    def _with_late(
        self, ranges: DataFrame | None, late: DataFrame, ledger: OffsetLedger, kept: list[DataFrame]
    ) -> DataFrame | None:
        """Add an empty range at the saved position for partitions of which the batch has late rows only."""
        columns = [*KEYS, "start_offset", "next_offset", "n_messages", "fetch_chars"]
        counts = late.groupBy(*KEYS).agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(counts)
        LOGGER.warning("messages behind the saved position are kept as rejects in %s", self.output)
        only = counts.join(ledger.heads(self.group), KEYS)
        if ranges is not None:
            only = only.join(ranges.select(*KEYS), KEYS, "left_anti")
        at, nothing = F.col("saved_offset"), F.lit(0).cast("bigint")
        empty = only.select(
            *KEYS, at.alias("start_offset"), at.alias("next_offset"), nothing.alias("n_messages"), nothing.alias("fetch_chars")
        )
        return empty if ranges is None else ranges.select(*columns).unionByName(empty)

    def _sketches(self, spark: SparkSession, commit_key: str) -> DataFrame:
        """Route sketch per topic-partition of the commit's landed rows; of the buckets, only the directories' names are read."""
        rows = read_commit(spark, self.output, commit_key, self.mapper.buckets).where(F.col("outcome") == LANDED)
        route = F.concat_ws("/", *(F.col(name).cast("string") for name in self.mapper.buckets.fieldNames()))
        return rows.groupBy(*KEYS).agg(route_sketch(route).alias("routes_sketch"))

    def _inputs(self, log: DataFrame) -> DataFrame:
        """What the mapper reads, and the message, whose size every commit records."""
        return log.select(*KEYS, "offset", *dict.fromkeys((*self.mapper.inputs, "value")))

    def _checked_ranges(self, rows: DataFrame, heads: DataFrame, kept: list[DataFrame]) -> DataFrame | None:
        """Offset range, messages and characters per topic-partition, None if there are no rows."""
        ranges = (
            rows.groupBy(*KEYS)
            .agg(
                F.min("offset").alias("start_offset"),
                next_offset(F.max("offset")).alias("next_offset"),
                F.count("*").alias("n_messages"),
                F.sum(F.coalesce(F.col("chars").cast("bigint"), F.lit(0))).alias("fetch_chars"),
                F.bit_xor(F.xxhash64("offset")).alias("digest"),
            )
            .join(heads, KEYS, "left")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        kept.append(ranges)
        behind = F.count_if(F.col("start_offset") < F.col("saved_offset")).alias("n_behind")
        beyond = F.count_if(F.col("start_offset") > F.col("saved_offset")).alias("n_beyond")
        totals = ranges.agg(F.count("*").alias("n"), behind, beyond).first()
        if totals["n_behind"]:
            raise OutOfOrderError(f"{totals['n_behind']} partitions hold messages behind their saved position")
        if totals["n_beyond"]:
            LOGGER.warning("%s partitions of %s start past their saved position; see gaps()", totals["n_beyond"], self.topic)
        return ranges if totals["n"] else None

    def _ranges(
        self, ranges: DataFrame, batch_id: int, commit_key: str = "", opened_ms: int | None = None, committed_ms: int | None = None
    ) -> DataFrame:
        return ranges.withColumns(
            {
                "grp": F.lit(self.group),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "commit_key": F.lit(commit_key),
                "opened_ms": F.lit(opened_ms).cast("bigint"),
                "committed_ms": F.lit(committed_ms).cast("bigint"),
            }
        )

    def _mapper_arguments(self) -> dict:
        # The output root goes to mappers that name it.
        named = inspect.signature(self.mapper.transform).parameters
        return {**({"output": self.output} if "output" in named else {}), **self._parameters()}

    def _parameters(self) -> dict:
        if isinstance(self.parameters, dict):
            return self.parameters
        if not self.parameters.strip():
            return {}
        # Free text goes to mappers that take it; others have no use for it.
        free = {"parameters": self.parameters} if self.mapper.takes("parameters") else {}
        try:
            parsed = json.loads(self.parameters)
        except json.JSONDecodeError:
            return free
        return parsed if isinstance(parsed, dict) else free

    # -- reading back --------------------------------------------------------

    def committed(self, spark: SparkSession, days: list | None = None) -> DataFrame:
        """Landed rows of committed batches, each message once.

        ``days`` are values of the first bucket; only their packs are then opened,
        beside the commits that no compaction has taken in yet. See ``compact``.
        """
        # The manifest is listed before the ledger: a commit missing in the one is then still found in the other.
        manifest = PackManifest(spark, self.output, self.topic, self.mapper.buckets)
        fresh, _ = self._unpacked(spark, manifest)
        if days is not None:
            fresh = fresh.where(day_text(self.mapper.buckets.fieldNames()[0]).isin(["" if d is None else str(d) for d in days]))
        if not manifest.last:
            return fresh
        packed = manifest.rows(manifest.packs(), days, self.max_broadcast_rows)
        return fresh.unionByName(packed.select(*fresh.columns))

    def compact(self, spark: SparkSession, *, commit: bool = True) -> bool:
        """Gather the rows of the commits since the last compaction by day; False if there are none.

        Readers see the same messages before, during and after it. One compaction of a
        topic may run at a time, beside landing and reading: a second one fails with
        FencedWriterError. ``commit=False`` leaves its packs hidden, as a failure would.
        """
        manifest = PackManifest(spark, self.output, self.topic, self.mapper.buckets)
        fresh, keys = self._unpacked(spark, manifest)
        if keys.isEmpty():
            return False
        manifest.compact(fresh, keys, self.max_broadcast_rows, commit=commit)
        return True

    def _unpacked(self, spark: SparkSession, manifest: PackManifest) -> tuple[DataFrame, DataFrame]:
        """Committed rows that no pack holds, and the keys of their commits."""
        commits = OffsetLedger(spark, self.output).commits(self.group).where(F.col("topic") == self.topic)
        if not manifest.last:
            rows = read_landed(spark, self.output, self.mapper.buckets).where(F.col("topic") == self.topic)
            return committed_read(rows, disjoint_ranges(commits), self.max_broadcast_rows), commits.select("commit_key").distinct()
        held = small_side(manifest.held(), self.max_broadcast_rows).withColumn("held", F.lit(True))
        placed = commits.join(held, "commit_key", "left")
        keys = placed.where("held is null").select("commit_key").distinct()
        # Offsets that a pack has stay there: its commits come before all others.
        first = placed.withColumn("committed_ms", F.when(F.col("held").isNull(), F.coalesce("committed_ms", F.lit(0))))
        ranges = disjoint_ranges(first.drop("held")).join(small_side(keys, self.max_broadcast_rows), "commit_key", "left_semi")
        named = [r["commit_key"] for r in keys.limit(MAX_FOLDERS + 1).collect()]
        if len(named) > MAX_FOLDERS:
            rows = read_landed(spark, self.output, self.mapper.buckets).where(F.col("topic") == self.topic)
        else:
            named = [key for key in named if path_exists(spark, f"{self.output}/messages/commit_key={key}")]
            if named:
                rows = read_landed_commits(spark, self.output, named, self.topic, self.mapper.buckets)
            else:
                rows = read_landed(spark, f"{self.output}/none", self.mapper.buckets)
        return committed_read(rows, ranges, self.max_broadcast_rows), keys

    def committed_rejects(self, spark: SparkSession) -> DataFrame:
        """Rejected rows of committed batches with their reasons."""
        # Late messages lie below the range of the commit that brought them, so its key alone admits them.
        behind = F.col("reject_reason") == BEHIND_POSITION
        keys = OffsetLedger(spark, self.output).commit_keys(self.group).where(F.col("topic") == self.topic)
        late = read_rejected(spark, self.output, self.mapper.buckets).where(behind & (F.col("topic") == self.topic))
        placed = self._committed(spark, read_rejected).where(~behind)
        return placed.unionByName(committed_read(late, keys, self.max_broadcast_rows))

    def gaps(self, spark: SparkSession) -> DataFrame:
        """Offsets between the first and the last committed one that no commit covers; see ``offset_gaps``."""
        return offset_gaps(OffsetLedger(spark, self.output).commits(self.group).where(F.col("topic") == self.topic))

    def routes(self, spark: SparkSession) -> DataFrame:
        """Estimated distinct routes per partition over all commits, without reading landed rows."""
        return routes_of_commits(OffsetLedger(spark, self.output).commits(self.group).where(F.col("topic") == self.topic))

    def commit_metrics(self, spark: SparkSession) -> DataFrame:
        """Messages, characters, open routes, offset range and times of each committed batch and partition.

        All but the routes are the ledger's, which are those of the input: dropped
        and rejected messages count, a message that goes to two routes counts once,
        and late ones, which are outside the range, do not. Routes are those of the
        committed rows, without their text.
        """
        commits = OffsetLedger(spark, self.output).commits(self.group).where(F.col("topic") == self.topic)
        rows = self._committed(spark, read_landed)
        if "route" not in rows.columns:
            rows = rows.withColumn("route", hour_route(F.col("event_day"), F.col("event_hour")))
        keys = [*KEYS, "commit_key"]
        routes = rows.groupBy(*keys).agg(F.count_distinct("route").alias("n_routes"))
        columns = ["batch_id", "n_messages", "fetch_chars", "start_offset", "next_offset", "opened_ms", "committed_ms"]
        return commits.select(*keys, *columns).join(routes, keys, "left").na.fill({"n_routes": 0})

    def _committed(self, spark: SparkSession, read: Callable[..., DataFrame]) -> DataFrame:
        # The ledger is listed first: a batch committed meanwhile is then missing as a whole, not in part.
        commits = OffsetLedger(spark, self.output).commits(self.group).where(F.col("topic") == self.topic)
        rows = read(spark, self.output, self.mapper.buckets).where(F.col("topic") == self.topic)
        return committed_read(rows, disjoint_ranges(commits), self.max_broadcast_rows)
