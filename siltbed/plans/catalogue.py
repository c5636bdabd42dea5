"""The named queries: one or more per operator, each over the whole message log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import siltbed.plans.sample_mappers  # noqa: F401  (registers the sample mappers)
from siltbed.functions import (
    field_at,
    field_count,
    line_file_name,
    local_day,
    local_hour,
    path_prefix,
    strict_long,
    utf16_length,
)
from siltbed.operators import (
    RolloverPolicy,
    accepted,
    batch_commit_metrics,
    csv_hour_mapper,
    get_mapper,
    incremental_scan,
    ledger_heads,
    next_offset,
    partition_bounds,
    rejected,
    resolve_start,
    rollover_reason,
    settle,
    small_side,
)
from siltbed.plans.messages import TOPIC, before_cut, binary_records, events, is_first_half, messages
from siltbed.scratch import scratch_dir
from siltbed.sources import FileLog, FrameLog, decode_messages, tail_log
from siltbed.sources.zones import FileZones
from siltbed.streaming import (
    LandingJob,
    OffsetLedger,
    append_log_files,
    export_named_text,
    export_text,
    payload_of,
    read_landed,
    read_named_text,
    read_text,
)

KEYS = ("topic", "partition", "offset")
GROUP = "etl"
OUTPUT_ROOT = "/landing"

# Thresholds small enough that every outcome occurs in the test log at sf0.01.
ROLLOVER_BLOCK = 40
SMALL_POLICY = RolloverPolicy(max_chars=2_140, max_age_ms=1_800_000, max_routes=15)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a trailing ``_query`` only avoids a clash with the operator."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# -- sources and offsets -------------------------------------------------------


@query
def decode_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(binary_records(messages(spark, sf_dir)))



@query
def tail_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tail_log(messages(spark, sf_dir), partition=0)


@query
def next_offset_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = messages(spark, sf_dir)
    return log.select(*KEYS, next_offset(F.col("offset")).alias("next_offset"))



@query
def partition_bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_bounds(messages(spark, sf_dir))



def _bounds(log: DataFrame) -> DataFrame:
    """Partition bounds, computed once however often a query refers to them."""
    return partition_bounds(log).persist(StorageLevel.MEMORY_AND_DISK)


def _start_cases(bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Saved and explicit offsets by partition: none, inside, below, beyond, and both given."""
    half = F.call_function("div", F.col("latest"), F.lit(2))
    saved = (
        F.when(F.col("partition") == 1, half)
        .when(F.col("partition") == 2, F.col("earliest") - 5)
        .when(F.col("partition") == 3, F.col("latest") + 400)
        .when(F.col("partition") == 4, half)
    )
    explicit = F.when(F.col("partition") == 2, F.lit(-5)).when(F.col("partition") == 4, half + 7)
    return (
        bounds.select("topic", "partition", saved.cast("bigint").alias("saved_offset")),
        bounds.select("topic", "partition", explicit.cast("bigint").alias("explicit_offset")),
    )


def _resolved(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    bounds = _bounds(messages(spark, sf_dir))
    saved, explicit = _start_cases(bounds)
    return resolve_start(bounds, saved, explicit=explicit, policy=policy)


@query
def resolve_start_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir, "earliest")


@query
def resolve_start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir, "latest")


@query
def incremental_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = _resolved(spark, sf_dir, "earliest")
    return incremental_scan(messages(spark, sf_dir), starts).select(*KEYS, "key", "value")



@query
def incremental_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from log files, of which only those past their own partitions' starts are read."""
    path = scratch_dir(spark, "log")
    for half in _halves(messages(spark, sf_dir)):
        append_log_files(half, path)
    zones = FileZones(spark, path, scratch_dir(spark, "zones"))
    return zones.scan(_resolved(spark, sf_dir, "earliest")).select(*KEYS, "key", "value")


@query
def commit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits, the second for even partitions only; then the saved positions."""
    bounds = _bounds(messages(spark, sf_dir))
    whole = bounds.join(before_cut(bounds), ["topic", "partition"]).withColumns(
        {"grp": F.lit(GROUP), "commit_key": F.lit("")}
    )
    ledger = OffsetLedger(spark, scratch_dir(spark, "ledger"))
    first = whole.withColumns({"start_offset": F.col("earliest"), "next_offset": F.col("cut")})
    ledger.commit(first.withColumn("batch_id", F.lit(0).cast("bigint")))
    second = whole.withColumns({"start_offset": F.col("cut"), "next_offset": F.col("latest")})
    ledger.commit(second.where(F.col("partition") % 2 == 0).withColumn("batch_id", F.lit(1).cast("bigint")))
    heads = ledger_heads(ledger.read(), GROUP)
    return heads.select("topic", F.lit(GROUP).alias("grp"), "partition", F.col("saved_offset").alias("next_offset"))


# -- scalar functions ----------------------------------------------------------


@query
def field_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(*KEYS, field_count(F.col("value")).alias("n_fields"))



@query
def field_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(*KEYS, field_at(F.col("value"), 9).alias("f9"))


@query
def parse_event_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = messages(spark, sf_dir).withColumn("f9", field_at(F.col("value"), 9))
    return fields.select(*KEYS, strict_long(F.col("f9")).alias("event_ms"))


@query
def event_local_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_range = accepted(csv_hour_mapper(messages(spark, sf_dir)))
    return in_range.select(*KEYS, "event_day", "event_hour")


@query
def local_parts_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day and hour of every event at three offsets, straight from the time functions."""
    log = messages(spark, sf_dir).withColumn("f9", field_at(F.col("value"), 9))
    timed = settle(log.withColumn("ms", strict_long(F.col("f9"))), event_ms=F.col("ms") % F.lit(4_000_000_000_000))
    ms = F.col("event_ms")
    return timed.where(ms.isNotNull()).select(
        *KEYS,
        local_day(-ms).alias("day_before_epoch"),
        local_hour(-ms).alias("hour_before_epoch"),
        local_day(ms, -5).alias("day_west"),
        local_hour(ms, -5).alias("hour_west"),
        local_day(ms, 0).alias("day_utc"),
        local_hour(ms, 0).alias("hour_utc"),
    )


@query
def message_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(*KEYS, utf16_length(F.col("value")).alias("chars"))


# -- the shipped mapper --------------------------------------------------------


@query
def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_hour_mapper(messages(spark, sf_dir)).select(
        *KEYS, "next_offset", F.col("line").alias("value"), "reject_reason", "event_day", "event_hour", "route"
    )


@query
def accepted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(csv_hour_mapper(messages(spark, sf_dir))).select(*KEYS, "line")


@query
def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = rejected(csv_hour_mapper(messages(spark, sf_dir)))
    return mapped.select(*KEYS, F.col("line").alias("value"), "reject_reason")


@query
def legacy_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = messages(spark, sf_dir)
    starts = _bounds(log).select("topic", "partition", F.col("earliest").alias("start_offset"))
    rows = accepted(csv_hour_mapper(log)).join(small_side(starts), ["topic", "partition"])
    prefix = path_prefix(OUTPUT_ROOT, F.col("topic"))
    name = line_file_name(prefix, F.col("route"), F.col("partition"), F.col("start_offset"))
    return rows.select(*KEYS, name.alias("file_name"))


# -- batch metrics -------------------------------------------------------------


@query
def batch_commit_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_commit_metrics(csv_hour_mapper(messages(spark, sf_dir)))



@query
def rollover_reason_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of 40 offsets as one batch; every seventh batch is given an age past the limit."""
    block = F.call_function("div", F.col("offset"), F.lit(ROLLOVER_BLOCK))
    mapped = csv_hour_mapper(messages(spark, sf_dir)).withColumn("batch_no", block)
    metrics = batch_commit_metrics(mapped, "batch_no")
    age = F.when(F.col("batch_no") % 7 == 3, F.lit(1_800_000)).otherwise(F.lit(600_000))
    reason = rollover_reason(F.col("fetch_chars"), age, F.col("n_routes"), SMALL_POLICY)
    return metrics.withColumn("rollover_reason", reason)



# -- landing -------------------------------------------------------------------


def _job(spark: SparkSession, log: DataFrame | None = None, mapper: str = "csv_hour", **settings) -> LandingJob:
    source = settings.pop("source", None) or FrameLog(log)
    output = settings.pop("output", None) or scratch_dir(spark, "landing")
    return LandingJob(source=source, topic=TOPIC, group=GROUP, mapper=mapper, output=output, **settings)


def _halves(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The log cut in two at each partition's half-way offset."""
    cuts = small_side(before_cut(_bounds(log)))
    cut_log = log.join(cuts, ["topic", "partition"])
    first = is_first_half(F.col("cut"))
    return cut_log.where(first).drop("cut"), cut_log.where(~first).drop("cut")


LANDED_COLUMNS = (*KEYS, "event_day", "event_hour", "line")


@query
def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, messages(spark, sf_dir))
    job.run_batch(spark)
    return read_landed(spark, job.output).select(*LANDED_COLUMNS)


@query
def landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, messages(spark, sf_dir))
    job.run_batch(spark)
    return job.committed_rejects(spark).select(*KEYS, F.col("line").alias("value"), "reject_reason")


@query
def landed_rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows when files are gathered per directory by an adaptive shuffle first."""
    job = _job(spark, messages(spark, sf_dir), rebalance=True)
    job.run_batch(spark)
    return job.committed(spark).select(*LANDED_COLUMNS)


def _exported(spark: SparkSession, path: str) -> DataFrame:
    """Lines of named text files with what their names tell."""
    name = r"^([^/]+)/([^/]+)/([0-9]+)-([0-9]+)[.]([0-9]+)[.]"
    part = [F.regexp_extract("file_name", name, i) for i in range(6)]
    return read_named_text(spark, path).select(
        part[1].alias("topic"),
        F.to_date(part[2], "y-M-d").alias("event_day"),
        part[3].cast("int").alias("event_hour"),
        part[4].cast("int").alias("partition"),
        part[5].cast("bigint").alias("start_offset"),
        "line",
    )


def _export(log: DataFrame, path: str) -> None:
    starts = partition_bounds(log).select("topic", "partition", F.col("earliest").alias("start_offset"))
    export_named_text(accepted(csv_hour_mapper(log)), path, starts)


@query
def text_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "text")
    _export(messages(spark, sf_dir), path)
    return _exported(spark, path)


@query
def text_export_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports, one for each half of the log: hours they share keep the lines of both."""
    path = scratch_dir(spark, "text")
    for half in _halves(messages(spark, sf_dir)):
        _export(half, path)
    return _exported(spark, path)


@query
def text_export_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the name of its file; exporting the second half again replaces its files."""
    path = scratch_dir(spark, "text")
    first, second = _halves(messages(spark, sf_dir))
    for half in (first, second, second):
        _export(half, path)
    return read_named_text(spark, path)


@query
def text_export_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines by Spark's own text writer, which has further codecs, under folders."""
    path = scratch_dir(spark, "text")
    export_text(accepted(csv_hour_mapper(messages(spark, sf_dir))), path)
    return read_text(spark, path).drop("partition", "start_offset")


@query
def late_file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file log whose second file lies below the first: every message is landed or a reject with a reason."""
    log_path = scratch_dir(spark, "log")
    job = _job(spark, source=FileLog(log_path))
    for half in reversed(_halves(messages(spark, sf_dir))):
        append_log_files(half, log_path)
        job.run(spark)
    landed = job.committed(spark).select("topic", "partition", "offset", F.lit("landed").alias("outcome"))
    rejects = job.committed_rejects(spark).select("topic", "partition", "offset", F.col("reject_reason").alias("outcome"))
    return landed.unionByName(rejects)


@query
def two_topics_one_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics in one log, landed by two jobs under one root."""
    log_path, output = scratch_dir(spark, "log"), scratch_dir(spark, "landing")
    split = F.when(F.col("partition") < 2, F.lit("left")).otherwise(F.lit("right"))
    append_log_files(messages(spark, sf_dir).withColumn("topic", split), log_path)
    out = None
    for topic in ("left", "right"):
        job = LandingJob(source=FileLog(log_path), topic=topic, group=GROUP, mapper="csv_hour", output=output)
        job.run(spark)
        rows = job.committed(spark).select(*LANDED_COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file log that grows between two runs of the same streaming job."""
    log_path = scratch_dir(spark, "log")
    job = _job(spark, source=FileLog(log_path))
    for half in _halves(messages(spark, sf_dir)):
        append_log_files(half, log_path)
        job.run(spark)
    return job.committed(spark).select(*LANDED_COLUMNS)


@query
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt dies between writing its rows and the ledger; the batch is replayed, then offered again.

    Returns every row on disk, so a duplicate would show.
    """
    log = messages(spark, sf_dir)
    job = _job(spark, log)
    job.land_batch(log, 0, commit_key="attempt-0", commit=False)
    job.land_batch(log, 0, commit_key="attempt-0")
    job.land_batch(log, 0, commit_key="attempt-0")
    return read_landed(spark, job.output).select(*LANDED_COLUMNS)


@query
def committed_read_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt lands the whole log and loses its commit; the replay has other boundaries.

    Each line comes with the start of the committed range that holds it.
    """
    log = messages(spark, sf_dir)
    job = _job(spark, log)
    job.land_batch(log, 0, commit=False)
    for batch_id, half in enumerate(_halves(log)):
        job.land_batch(half, batch_id)
    return _with_start_offset(spark, job).select(*LANDED_COLUMNS, "start_offset")


def _with_start_offset(spark: SparkSession, job: LandingJob) -> DataFrame:
    keys = ["topic", "partition", "commit_key"]
    ranges = OffsetLedger(spark, job.output).read().select(*keys, "start_offset")
    return job.committed(spark).join(small_side(ranges), keys)


@query
def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that a second batch wrote to again, without touching the first batch's files."""
    job = _job(spark, messages(spark, sf_dir))
    for batch_id, half in enumerate(_halves(messages(spark, sf_dir))):
        job.land_batch(half, batch_id)
    hours = _with_start_offset(spark, job).groupBy("topic", "event_day", "event_hour", "partition")
    batches = hours.agg(F.count_distinct("start_offset").alias("n_batches"), F.count("*").alias("n_lines"))
    return batches.where(F.col("n_batches") > 1)


@query
def commit_metrics_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and range of the input of three commits by a mapper that drops and multiplies messages.

    The second half lands first, in one batch with no late message; then the first half comes late for even
    partitions, whose messages are rejects and count for nothing, and in order for none.
    """
    log = messages(spark, sf_dir)
    job = _job(spark, log, mapper="alerts")
    nothing = OffsetLedger(spark, job.output).heads(GROUP)
    first, second = _halves(log)
    job.land_batch(second, 0, nothing, commit_key="a")
    odd = F.col("partition") % 2 == 1
    mixed = first.where(~odd).unionByName(log.where(odd).withColumn("offset", F.col("offset") + 10_000_000))
    job.land_batch(mixed, 1, nothing, commit_key="b", keep_late=True)
    return job.commit_metrics(spark).drop("opened_ms", "committed_ms")


@query
def repeated_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh offset is in the log twice; each message lands once."""
    log = messages(spark, sf_dir)
    job = _job(spark, log.unionByName(log.where(F.col("offset") % 7 == 0)))
    job.run_batch(spark)
    return read_landed(spark, job.output).select(*LANDED_COLUMNS)


@query
def committed_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers land overlapping ranges, neither knowing of the other: the first commit's rows are shown.

    Each line comes with the commit that it is shown from.
    """
    log = messages(spark, sf_dir)
    bounds = _bounds(log)
    job = _job(spark, log)
    nothing = OffsetLedger(spark, job.output).heads(GROUP)
    thirds = small_side(bounds.select("topic", "partition", F.call_function("div", F.col("latest"), F.lit(3)).alias("third")))
    placed = log.join(thirds, ["topic", "partition"])
    lower = placed.where(F.col("offset") < 2 * F.col("third")).drop("third")
    upper = placed.where(F.col("offset") >= F.col("third")).drop("third")
    batches = (("lower", lower), ("upper", upper))
    for key, batch in batches:
        job.land_batch(batch, 0, nothing, commit_key=key, commit=False)
    ledger = OffsetLedger(spark, job.output)
    for at, (key, batch) in enumerate(batches):
        ranges = partition_bounds(batch).withColumnsRenamed({"earliest": "start_offset", "latest": "next_offset"})
        entry = {"grp": F.lit(GROUP), "batch_id": F.lit(0).cast("bigint"), "commit_key": F.lit(key)}
        ledger.append(ranges.withColumns({**entry, "committed_ms": F.lit(at).cast("bigint")}))
    return job.committed(spark).select(*LANDED_COLUMNS, "commit_key")


def _thirds(log: DataFrame) -> list[DataFrame]:
    """The log cut in three at a third and two thirds of each partition's offsets."""
    bounds = small_side(_bounds(log).select("topic", "partition", F.call_function("div", F.col("latest"), F.lit(3)).alias("third")))
    placed = log.join(bounds, ["topic", "partition"])
    at, third = F.col("offset"), F.col("third")
    parts = (at < third, (at >= third) & (at < 2 * third), at >= 2 * third)
    return [placed.where(part).drop("third") for part in parts]


@query
def compacted_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits: two are compacted, one after the other, a third compaction dies before its entry.

    Each line comes with the commit that landed it.
    """
    log = messages(spark, sf_dir)
    job = _job(spark, log)
    for batch_id, part in enumerate(_thirds(log)):
        job.land_batch(part, batch_id, commit_key=f"batch-{batch_id}")
        job.compact(spark, commit=batch_id < 2)
    return job.committed(spark).select(*LANDED_COLUMNS, "commit_key")


@query
def compacted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last day of the log, read by day after a compaction of two commits."""
    log = messages(spark, sf_dir)
    job = _job(spark, log)
    for batch_id, half in enumerate(_halves(log)):
        job.land_batch(half, batch_id)
    job.compact(spark)
    ends = accepted(csv_hour_mapper(log)).agg(F.min("event_day"), F.max("event_day")).first()
    return job.committed(spark, days=list(ends)).select(*LANDED_COLUMNS)


@query
def rollover_of_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each of three commits was due, by the size, age and routes that the ledger and the table record.

    The log's parts are opened and committed at given times, so the second is over the age limit.
    """
    log = messages(spark, sf_dir)
    times = iter((0, 600_000, 600_000, 2_500_000, 2_500_000, 2_500_500))
    job = _job(spark, log, clock=lambda: next(times))
    block = F.call_function("div", F.col("offset"), F.lit(ROLLOVER_BLOCK))
    for batch_id in range(3):
        part = log.where(block == batch_id) if batch_id < 2 else log.where(block == 2).where(F.col("offset") % 8 == 0)
        job.land_batch(part, batch_id)
    metrics = job.commit_metrics(spark).withColumn("age_ms", F.col("committed_ms") - F.col("opened_ms"))
    reason = rollover_reason(F.col("fetch_chars"), F.col("age_ms"), F.col("n_routes"), SMALL_POLICY)
    columns = ["topic", "partition", "batch_id", "n_messages", "fetch_chars", "n_routes", "start_offset", "next_offset", "age_ms"]
    return metrics.select(*columns, reason.alias("rollover_reason"))


@query
def routes_of_commits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct routes over two commits, with whether the merged sketches' estimate is within three standard errors."""
    job = _job(spark, messages(spark, sf_dir))
    for batch_id, half in enumerate(_halves(messages(spark, sf_dir))):
        job.land_batch(half, batch_id)
    exact = job.committed(spark).groupBy("topic", "partition").agg(F.count_distinct("event_day", "event_hour").alias("n_exact"))
    near = F.abs(F.col("n_routes") - F.col("n_exact")) <= F.greatest(F.lit(1), F.lit(3 * 1.04 / 64) * F.col("n_exact"))
    both = job.routes(spark).join(exact, ["topic", "partition"])
    return both.select("topic", "partition", "n_commits", F.col("n_exact").alias("n_routes"), near.alias("is_near"))


@query
def offset_gaps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that loses its middle between two batches: what no commit covers."""
    log = messages(spark, sf_dir)
    cuts = small_side(before_cut(_bounds(log)))
    placed = log.join(cuts, ["topic", "partition"])
    job = _job(spark, log)
    job.land_batch(placed.where(F.col("offset") < F.col("cut") - 3 * F.col("partition")).drop("cut"), 0)
    job.land_batch(placed.where(F.col("offset") >= F.col("cut")).drop("cut"), 1)
    return job.gaps(spark)


@query
def ledger_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions after more commits than a segment holds, read from a snapshot and the entries after it."""
    bounds = _bounds(messages(spark, sf_dir))
    ledger = OffsetLedger(spark, scratch_dir(spark, "ledger"))
    ledger.SNAPSHOT_EVERY = 3
    step = F.call_function("div", F.col("latest"), F.lit(7))
    for batch_id in range(7):
        ranges = bounds.where(F.col("partition") <= batch_id).select(
            "topic", "partition", F.lit(GROUP).alias("grp"), (batch_id * step).alias("start_offset"),
            ((batch_id + 1) * step).alias("next_offset"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(f"c{batch_id}").alias("commit_key"),
        )
        ledger.append(ranges.where(F.col("partition") != 6 - batch_id), TOPIC, batch_id)
    heads = ledger.heads(GROUP)
    commits = ledger.commits(GROUP).groupBy("topic", "partition").agg(F.count("*").alias("n_commits"))
    return heads.join(commits, ["topic", "partition"])


# -- mappers chosen by name ----------------------------------------------------


@query
def mapper_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named mapper with parameters, landed by route and read back."""
    job = _job(spark, messages(spark, sf_dir), mapper="event_type", parameters='{"prefix": "kind"}')
    job.run_batch(spark)
    return job.committed(spark).select(*KEYS, "route", "line")


@query
def mapper_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return get_mapper("alerts")(messages(spark, sf_dir))


@query
def mapper_row_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-out again, by a Python class."""
    return get_mapper("alert_rows")(messages(spark, sf_dir)).select(*KEYS, "route", "line")


@query
def mapper_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-out by a table function that is set up with the job's output and parameters, landed and read back."""
    job = _job(spark, messages(spark, sf_dir), mapper="alert_table", parameters='{"folder": "alerts", "types": ["error", "purchase"]}')
    job.run_batch(spark)
    return job.committed(spark).select(*KEYS, "route", "line")


# -- producer ------------------------------------------------------------------


@query
def producer_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, key and value both its number."""
    return payload_of(events(spark, sf_dir), "event_id")


@query
def produced_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log written to log files and scanned back."""
    path = scratch_dir(spark, "log")
    append_log_files(messages(spark, sf_dir), path)
    return FileLog(path, TOPIC).read(spark)
