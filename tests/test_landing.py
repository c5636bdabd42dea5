import glob
import gzip

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from siltbed.operators import (
    Mapper,
    RolloverPolicy,
    batch_commit_metrics,
    csv_hour_mapper,
    disjoint_ranges,
    repeated_messages,
    rollover_reason,
)
from siltbed.operators.offsets import KEYS
from siltbed.schema import ROUTE_BUCKETS
from siltbed.sources import FileLog, FrameLog, KafkaLog
from siltbed.streaming import (
    FencedWriterError,
    LandingJob,
    OffsetLedger,
    OutOfOrderError,
    append_log_files,
    export_named_text,
    export_text,
    producer_options,
    producer_payload,
    read_landed,
    read_named_text,
    read_text,
)
from siltbed.streaming import landing as landing_module
from siltbed.streaming.ledger import _Folder
from siltbed.streaming.packs import PackManifest

HOUR = 3_600_000


def message(hour, tag=""):
    return f"{tag},b,c,d,e,f,g,h,i,{hour * HOUR}"


def job_for(tmp_path, source, **settings):
    settings = {"topic": "t", "group": "g", "mapper": "csv_hour", "output": str(tmp_path / "out"), **settings}
    return LandingJob(source=source, **settings)


def offsets_of(frame):
    return sorted((r.partition, r.offset) for r in frame.select("partition", "offset").collect())


@pytest.fixture
def log_path(tmp_path):
    return str(tmp_path / "log")


def test_missing_settings_are_named():
    with pytest.raises(ValueError, match="source, topic, group, mapper, output"):
        LandingJob()
    with pytest.raises(ValueError, match="missing: group$"):
        LandingJob(source=FileLog("x"), topic="t", mapper="csv_hour", output="o")


def test_stream_lands_each_message_once_over_restarts(spark, log_of, tmp_path, log_path):
    job = job_for(tmp_path, FileLog(log_path))
    append_log_files(log_of([(p, o, message(o // 3)) for p in range(2) for o in range(9)]), log_path)
    job.run(spark)
    job.run(spark)  # nothing new
    append_log_files(log_of([(0, 9, message(0, "late")), (1, 9, "bad"), (2, 0, message(7))]), log_path)
    job.run(spark)
    assert offsets_of(job.committed(spark)) == sorted([(p, o) for p in range(2) for o in range(9)] + [(0, 9), (2, 0)])
    reject = job.committed_rejects(spark).collect()
    assert [(r.partition, r.offset, r.reject_reason) for r in reject] == [(1, 9, "too_few_fields")]
    late = job.committed(spark).where("line like 'late%'").first()
    assert late.event_hour == 8 and late.commit_key.endswith("-1")
    heads = {r.partition: r.saved_offset for r in OffsetLedger(spark, job.output).heads("g").collect()}
    assert heads == {0: 10, 1: 10, 2: 1}


def test_metrics_of_committed_batches(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    job.land_batch(log_of([(0, 0, message(1)), (0, 1, message(2)), (0, 2, "bad")]), 0, commit_key="a")
    job.land_batch(log_of([(0, 3, message(1))]), 1, commit_key="b")
    job.land_batch(log_of([(0, 4, message(1))]), 2, commit_key="c", commit=False)
    rows = job.commit_metrics(spark).orderBy("commit_key").collect()
    assert [(r.commit_key, r.fetch_chars, r.n_routes, r.start_offset, r.next_offset) for r in rows] == [
        ("a", len(message(1)) + len(message(2)) + 3, 2, 0, 3),
        ("b", len(message(1)), 1, 3, 4),
    ]


def test_batch_of_rejects_only_still_advances(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([(0, 3, "bad"), (0, 4, None)])))
    job.run_batch(spark)
    assert job.committed(spark).count() == 0
    assert job.committed_rejects(spark).count() == 2
    assert OffsetLedger(spark, job.output).heads("g").first().saved_offset == 5


@pytest.mark.parametrize("step", ["write_messages", "append"])
def test_crash_before_or_after_the_ledger_write(spark, log_of, tmp_path, log_path, monkeypatch, step):
    """The batch fails just after the named step; the restarted stream replays it from its checkpoint."""
    job = job_for(tmp_path, FileLog(log_path))
    rows = [(p, o, message(o)) for p in range(2) for o in range(6)]
    append_log_files(log_of(rows), log_path)
    owner = landing_module if step == "write_messages" else OffsetLedger
    real = getattr(owner, step)

    def crash(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, crash)
    with pytest.raises(Exception, match="lost"):
        job.run(spark)
    monkeypatch.undo()
    assert job.committed(spark).count() == (0 if step == "write_messages" else 12)
    job.run(spark)
    assert offsets_of(job.committed(spark)) == sorted((p, o) for p, o, _ in rows)
    assert offsets_of(read_landed(spark, job.output)) == sorted((p, o) for p, o, _ in rows)


def test_lost_checkpoint_and_other_boundaries(spark, log_of, tmp_path):
    """An attempt lands [100,500) and is lost; the replay lands [100,300), then [300,600)."""
    rows = [(0, o, message(1 if o < 400 else 2)) for o in range(100, 600)]
    job = job_for(tmp_path, FrameLog(log_of(rows)))
    log = log_of(rows)
    job.land_batch(log.where("offset < 500"), 0, commit=False)
    job.land_batch(log.where("offset < 300"), 0)
    job.land_batch(log.where("offset >= 300"), 1)
    raw, view = read_landed(spark, job.output), job.committed(spark)
    assert raw.count() == 900
    assert offsets_of(view) == [(0, o) for o in range(100, 600)]
    wide = LandingJob(**{**job.__dict__, "max_broadcast_rows": 0})  # every side past its bound: shuffle joins
    assert offsets_of(wide.committed(spark)) == [(0, o) for o in range(100, 600)]


def test_shuffle_joins_land_the_same_rows(spark, log_of, tmp_path):
    rows = [(p, o, message(o)) for p in range(3) for o in range(5)]
    job = job_for(tmp_path, FrameLog(log_of(rows)), max_broadcast_rows=0, rebalance=True)
    job.run_batch(spark)
    job.run_batch(spark, 1)
    assert offsets_of(read_landed(spark, job.output)) == sorted((p, o) for p, o, _ in rows)


def test_new_checkpoint_skips_what_the_ledger_holds(spark, log_of, tmp_path, log_path):
    append_log_files(log_of([(0, o, message(o)) for o in range(4)]).coalesce(1), log_path)
    job_for(tmp_path, FileLog(log_path)).run(spark)
    append_log_files(log_of([(0, o, message(o)) for o in range(4, 7)]).coalesce(1), log_path)
    one_by_one = FileLog(log_path, options={"maxFilesPerTrigger": "1"})
    again = job_for(tmp_path, one_by_one, checkpoint=str(tmp_path / "other"))
    again.run(spark)
    assert offsets_of(read_landed(spark, again.output)) == [(0, o) for o in range(7)]
    assert offsets_of(again.committed(spark)) == [(0, o) for o in range(7)]


def test_out_of_order_rows_fail_instead_of_vanishing(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    opening = OffsetLedger(spark, job.output).heads("g")
    job.land_batch(log_of([(0, 10, message(1))]), 0, opening)
    with pytest.raises(OutOfOrderError):
        job.land_batch(log_of([(0, 4, message(1)), (0, 11, message(1))]), 1, opening)


def test_start_positions(spark, log_of, tmp_path, log_path):
    append_log_files(log_of([(p, o, message(o)) for p in range(2) for o in range(10)]), log_path)
    explicit = job_for(tmp_path, FileLog(log_path), start_offset=7, output=str(tmp_path / "explicit"))
    explicit.run(spark)
    assert offsets_of(explicit.committed(spark)) == [(p, o) for p in range(2) for o in (7, 8, 9)]
    explicit.run(spark)  # resumes: the explicit offset is for the first start
    latest = job_for(tmp_path, FileLog(log_path), auto_offset_reset="latest", output=str(tmp_path / "latest"))
    latest.run(spark)
    assert latest.committed(spark).count() == 0
    append_log_files(log_of([(0, 10, message(1))]), log_path)
    latest.run(spark)
    assert offsets_of(latest.committed(spark)) == [(0, 10)]
    with pytest.raises(Exception, match="no start offset"):
        job_for(tmp_path, FileLog(log_path), auto_offset_reset="none", output=str(tmp_path / "none")).run(spark)


def test_rewind_and_second_group_need_their_own_root(spark, log_of, tmp_path):
    log = FrameLog(log_of([(0, o, message(o)) for o in range(5)]))
    job_for(tmp_path, log).run_batch(spark)
    with pytest.raises(ValueError, match="new output root"):
        job_for(tmp_path, log, start_offset=2).run_batch(spark)
    with pytest.raises(ValueError, match="another consumer group"):
        job_for(tmp_path, log, group="h").run_batch(spark)


def test_topic_job_takes_saved_offsets(spark, log_of, tmp_path):
    job_for(tmp_path, FrameLog(log_of([(1, o, message(o)) for o in range(5)]))).run_batch(spark)
    job = job_for(tmp_path, KafkaLog("h:1", "t", n_partitions=2))
    assert job._open(spark).starting_offsets == '{"t": {"0": -2, "1": 5}}'
    fresh = job_for(tmp_path, KafkaLog("h:1", "t"), output=str(tmp_path / "fresh"), auto_offset_reset="latest")
    assert fresh._open(spark).starting_offsets == "latest"


def test_custom_mapper_by_name_with_parameters(spark, log_of, tmp_path):
    import siltbed.plans.sample_mappers  # noqa: F401

    log = FrameLog(log_of([(0, 0, "1,2,view"), (0, 1, "1"), (0, 2, "1,2,error")]))
    job = job_for(tmp_path, log, mapper="event_type", parameters='{"prefix": "p"}')
    job.run_batch(spark)
    assert sorted((r.route, r.line) for r in job.committed(spark).collect()) == [
        ("p/error", "1,2,error"),
        ("p/view", "1,2,view"),
    ]


@pytest.mark.parametrize("keep_late", [True, False])
def test_one_write_is_one_scan_without_shuffle(spark, log_of, tmp_path, log_path, monkeypatch, keep_late):
    append_log_files(log_of([(0, o, message(o)) for o in range(5)]), log_path)
    job = job_for(tmp_path, FileLog(log_path))
    job.run_batch(spark)  # so that the ledger is not empty
    plans, real = [], landing_module.write_messages

    def noted(rows, *args, **settings):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        real(rows, *args, **settings)

    monkeypatch.setattr(landing_module, "write_messages", noted)
    append_log_files(log_of([(0, 5, message(5))]), log_path)
    job.land_batch(spark.read.parquet(log_path), 1, keep_late=keep_late, commit=False)
    assert len(plans) == 1 and plans[0].count(f"[file:{log_path}]") == 1
    big_side = plans[0].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in big_side and "Exchange hashpartitioning" not in big_side
    assert "key:string" not in big_side


@pytest.mark.parametrize("mapper", ["csv_hour", "alerts"])
def test_a_streamed_batch_reads_its_source_once(spark, log_of, tmp_path, log_path, mapper):
    """Rows are counted where they are read; late and repeated messages are what a second pass would be for."""
    import siltbed.plans.sample_mappers  # noqa: F401

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value

    job = job_for(tmp_path, FileLog(log_path), mapper=mapper)
    job.land_batch(log_of([(0, o, message(o)) for o in range(10, 20)]), 0)
    batch = log_of([(0, o, message(o)) for o in [3, 4, *range(20, 40)]]).withColumn("value", counted.asNondeterministic()("value"))
    job.land_batch(batch, 1, spark.range(0).selectExpr("'t' topic", "0 partition", "0L saved_offset"), keep_late=True)
    assert read.value == 22
    assert offsets_of(job.committed_rejects(spark)) == [(0, 3), (0, 4)]
    assert set(offsets_of(job.committed(spark))) == {(0, o) for o in range(10, 40)}


@pytest.mark.parametrize("mapper", ["csv_hour", "alerts"])
def test_repeats_within_a_batch_land_once(spark, log_of, tmp_path, log_path, mapper):
    import siltbed.plans.sample_mappers  # noqa: F401

    rows = [(0, o, message(o)) for o in range(5)]
    append_log_files(log_of(rows + rows + [(1, 7, message(1)), (1, 9, message(1))]), log_path)
    job = job_for(tmp_path, FileLog(log_path), mapper=mapper)
    job.run(spark)
    assert offsets_of(job.committed(spark)) == [(0, o) for o in range(5)] + [(1, 7), (1, 9)]
    metrics = job.commit_metrics(spark).orderBy("partition").collect()
    assert [(r.n_messages, r.fetch_chars, r.start_offset, r.next_offset) for r in metrics] == [
        (5, sum(len(v) for _, _, v in rows), 0, 5),
        (2, 2 * len(message(1)), 7, 10),
    ]


def test_a_gap_that_hides_a_repeat_is_seen(spark, log_of):
    """Four messages in a range of four offsets, one of them twice."""
    log = log_of([(0, o, "x") for o in (0, 1, 1, 3)] + [(1, o, "x") for o in range(200_000)])
    ranges = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("start_offset"), (F.max("offset") + 1).alias("next_offset"),
        F.count("*").alias("n_messages"), F.bit_xor(F.xxhash64("offset")).alias("digest"),
    )
    assert offsets_of(repeated_messages(log, ranges)) == [(0, 1)]
    assert repeated_messages(log, ranges.where("partition = 1")) is None


def test_metrics_are_those_of_the_input(spark, log_of, tmp_path):
    import siltbed.plans.sample_mappers  # noqa: F401

    job = job_for(tmp_path, FrameLog(log_of([])), mapper="alerts")
    nothing = spark.range(0).selectExpr("'t' topic", "0 partition", "0L saved_offset")
    job.land_batch(log_of([(0, 10, "1,2,error"), (0, 11, "1,2,view"), (0, 12, None)]), 0, nothing, commit_key="a")
    job.land_batch(log_of([(0, 3, "1,2,late"), (0, 13, "1,2,buy")]), 1, nothing, commit_key="b", keep_late=True)
    rows = job.commit_metrics(spark).orderBy("commit_key").collect()
    assert [(r.n_messages, r.fetch_chars, r.n_routes, r.start_offset, r.next_offset) for r in rows] == [
        (3, 17, 2, 10, 13),
        (1, 7, 1, 13, 14),
    ]


def test_batches_grow_with_the_measured_rate(spark, log_of, tmp_path, log_path):
    times = iter(range(0, 10_000, 10))
    policy = RolloverPolicy(max_chars=100, max_age_ms=1_000)
    job = job_for(tmp_path, FileLog(log_path), rollover=policy, n_partitions=2, clock=lambda: next(times))
    bound = lambda: int(job._bounded(job.source, spark).options["maxBytesPerTrigger"])
    assert bound() == 200
    line = message(1, "x" * 30)
    append_log_files(log_of([(0, o, line) for o in range(50)]).coalesce(1), log_path)
    job.run(spark)
    # The commit took 10 ms by the clock, so a batch of 1,000 ms may have a hundred times as much.
    assert bound() == 100 * 50 * len(line)
    wide = LandingJob(**{**job.__dict__, "n_partitions": None, "output": str(tmp_path / "new")})
    assert int(wide._bounded(wide.source, spark).options["maxBytesPerTrigger"]) == 100 * spark.sparkContext.defaultParallelism


def test_overlapping_commits_show_each_message_once(spark, log_of, tmp_path):
    """Two writers that did not know of each other: the first commit of an offset has it."""
    job = job_for(tmp_path, FrameLog(log_of([])))
    nothing = spark.range(0).selectExpr("'t' topic", "0 partition", "0L saved_offset")
    ledger, log = OffsetLedger(spark, job.output), log_of([(p, o, message(o)) for p in (0, 1) for o in range(30)])
    commits = (("a", 0, 10), ("b", 5, 20), ("c", 8, 12), ("d", 20, 30), ("e", 0, 30))
    for key, low, high in commits:
        job.land_batch(log.where(F.col("offset").between(low, high - 1)), 0, nothing, commit_key=key, commit=False)
    for key, low, high in commits:
        entry = log.groupBy("topic", "partition").agg(F.lit(low).alias("start_offset"), F.lit(high).alias("next_offset"))
        ledger.append(job._ranges(entry, 0, key, 0, ord(key)))
    for settings in ({}, {"max_broadcast_rows": 0}):
        view = LandingJob(**{**job.__dict__, **settings}).committed(spark)
        assert offsets_of(view) == sorted((p, o) for p in (0, 1) for o in range(30))
        owners = {r.offset: r.commit_key for r in view.where("partition = 1").collect()}
        assert [owners[o] for o in (0, 9, 10, 19, 20, 29)] == ["a", "a", "b", "b", "d", "d"]


@pytest.mark.parametrize("total", [True, False])
def test_streamed_mapper_that_drops_messages_still_advances(spark, log_of, tmp_path, log_path, total):
    import siltbed.plans.sample_mappers  # noqa: F401

    mapper = "csv_hour" if total else "event_type"
    append_log_files(log_of([(0, 0, "1,2,view"), (0, 1, "1"), (1, 6, None)]), log_path)
    job = job_for(tmp_path, FileLog(log_path), mapper=mapper)
    job.run(spark)
    heads = {r.partition: r.saved_offset for r in OffsetLedger(spark, job.output).heads("g").collect()}
    assert heads == {0: 2, 1: 7}
    assert job.committed(spark).count() == (0 if total else 1)


def test_text_keeps_offset_order_and_codec(spark, log_of, tmp_path):
    rows = csv_hour_mapper(log_of([(p, o, message(5, f"{p}-{o}")) for o in range(30) for p in (1, 0)]))
    path = str(tmp_path / "text")
    export_text(rows, path)
    lines = []
    for name in sorted(glob.glob(f"{path}/topic=t/event_day=1970-01-01/event_hour=13/*/*/*.gz")):
        with gzip.open(name, "rt") as file:
            lines += file.read().splitlines()
    assert lines == [message(5, f"{p}-{o}") for p in (0, 1) for o in range(30)]
    assert read_text(spark, path).count() == 60
    export_text(csv_hour_mapper(log_of([(0, 99, message(5, "late"))])), path)
    export_text(rows, path)
    assert read_text(spark, path).count() == 61
    with pytest.raises(ValueError):
        export_text(rows, path, compression="lzo")


def test_named_text_files(spark, log_of, tmp_path):
    """One file a route, partition and start; long ranges in slices; the same export again replaces its files."""
    rows = csv_hour_mapper(log_of([(p, o, message(5, f"{p}-{o}")) for o in range(30) for p in (1, 0)]))
    path = str(tmp_path / "text")
    for _ in range(2):
        export_named_text(rows, path, slice_offsets=20)
    names = sorted(n.removeprefix(path + "/") for n in glob.glob(f"{path}/**/*.*", recursive=True) if "_temporary" not in n)
    assert names == [f"t/1970-1-1/13-{p}.{start}.gz" for p in (0, 1) for start in (0, 20)]
    with gzip.open(f"{path}/t/1970-1-1/13-1.20.gz", "rt") as file:
        assert file.read().splitlines() == [message(5, f"1-{o}") for o in range(20, 30)]
    export_named_text(csv_hour_mapper(log_of([(0, 99, message(5, "late"))])), path)
    found = read_named_text(spark, path)
    assert found.count() == 61 and found.where("file_name = 't/1970-1-1/13-0.99.gz'").first().line == message(5, "late")
    with pytest.raises(ValueError):
        export_named_text(rows, path, compression="lzo")


def test_a_failed_export_leaves_no_file(spark, log_of, tmp_path):
    rows = csv_hour_mapper(log_of([(0, o, message(o)) for o in range(9)]))
    bad = F.udf(lambda line: line if "1970" in line else 1 // 0)
    with pytest.raises(Exception, match="ZeroDivision"):
        export_named_text(rows.withColumn("line", bad("line")), str(tmp_path / "text"))
    assert not [n for n in glob.glob(f"{tmp_path}/text/**/*", recursive=True) if n.endswith(".gz")]


def test_disjoint_ranges_of_many_commits(spark):
    """Against a loop over offsets."""
    import random

    rng = random.Random(2)
    commits = [("t", p, f"k{i}", a, a + rng.randint(0, 15), i, i // 2) for p in (0, 1) for i in range(25) for a in [rng.randint(0, 200)]]
    frame = spark.createDataFrame(commits, "topic string, partition int, commit_key string, start_offset long, next_offset long, batch_id long, committed_ms long")
    owner = {}
    for _, p, key, a, b, batch, at in commits:
        for o in range(a, b):
            owner[p, o] = min(owner.get((p, o), (at, batch, key)), (at, batch, key))
    got = {}
    for r in disjoint_ranges(frame).collect():
        for o in range(r.start_offset, r.next_offset):
            assert (r.partition, o) not in got
            got[r.partition, o] = r.commit_key
    assert got == {at: turn[2] for at, turn in owner.items()}


def test_metrics_and_rollover(spark, log_of):
    rows = [(0, 5, message(1)), (0, 6, message(1)), (0, 8, message(2)), (0, 9, "é😀"), (0, 10, None)]
    metrics = batch_commit_metrics(csv_hour_mapper(log_of(rows)))
    row = metrics.first()
    chars = sum(len(message(h)) for h in (1, 1, 2)) + 3
    assert (row.fetch_chars, row.n_routes, row.start_offset, row.next_offset) == (chars, 2, 5, 11)

    def reason(chars, age, routes):
        return spark.range(1).select(rollover_reason(F.lit(chars), F.lit(age), F.lit(routes))).first()[0]

    assert reason(67_108_864, 1_800_000, 20) == "size"
    assert reason(67_108_863, 1_800_000, 20) == "age"
    assert reason(67_108_863, 1_799_999, 20) == "paths"
    assert reason(67_108_863, 1_799_999, 19) is None
    assert RolloverPolicy().kafka_options()["maxTriggerDelay"] == "1800000ms"
    assert RolloverPolicy().file_options(4) == {"maxBytesPerTrigger": str(4 * 67_108_864)}


def test_producer(spark):
    rows = producer_payload(spark).collect()
    assert [(r.key, r.value) for r in rows] == [(str(i), str(i)) for i in range(100)]
    assert producer_options("h:1", "t")["kafka.acks"] == "all"


def test_command_line(tmp_path):
    from siltbed.__main__ import job_from_args

    job, args = job_from_args(
        "--brokers h:1 --topic t --group g --mapper csv_hour --output /o --partitions 4 --continuous".split()
    )
    assert job._bounded(job.source).options["minOffsetsPerTrigger"] == str(4 * 262_144)
    assert args.continuous
    with pytest.raises(ValueError, match="missing: source, mapper"):
        job_from_args("--topic t --group g --output /o".split())


def test_rollover_of_the_job_bounds_every_batch(spark, log_of, tmp_path, log_path):
    for o in range(0, 9, 3):
        append_log_files(log_of([(0, o + i, message(o)) for i in range(3)]).coalesce(1), log_path)
    # A batch takes one file at least, and no more than the bound allows.
    for rollover, commits in ((RolloverPolicy(max_chars=1), 3), (RolloverPolicy(), 1), (None, 1)):
        job = job_for(tmp_path / str(rollover), FileLog(log_path), rollover=rollover)
        job.run(spark)
        assert OffsetLedger(spark, job.output).read().where("batch_id >= 0").count() == commits
        assert offsets_of(job.committed(spark)) == [(0, o) for o in range(9)]


def test_rollover_leaves_trigger_options_of_the_source(tmp_path):
    own = FileLog("x", options={"maxFilesPerTrigger": "1"})
    assert job_for(tmp_path, own)._bounded(own) is own
    topic = KafkaLog("h:1", "t", n_partitions=3)
    limits = job_for(tmp_path, topic)._bounded(topic).options
    assert limits["maxOffsetsPerTrigger"] == str(3 * 262_144) and limits["maxTriggerDelay"] == "1800000ms"


@pytest.mark.parametrize("starts", ["latest", '{"t": {"0": 5, "1": -1}}'])
def test_bounded_read_of_a_topic_does_not_start_at_its_end(spark, starts):
    with pytest.raises(ValueError, match="bounded read"):
        KafkaLog("h:1", "t", starting_offsets=starts).read(spark)


def test_rows_below_the_position_are_kept_as_rejects(spark, log_of, tmp_path, log_path):
    job = job_for(tmp_path, FileLog(log_path, options={"maxFilesPerTrigger": "1"}))
    append_log_files(log_of([(0, o, message(o)) for o in range(5, 10)]).coalesce(1), log_path)
    job.run(spark)
    append_log_files(log_of([(0, o, message(o)) for o in range(5)]).coalesce(1), log_path)
    job.run(spark)
    append_log_files(log_of([(0, 3, message(3)), (0, 10, message(1))]).coalesce(1), log_path)
    job.run(spark)
    assert offsets_of(job.committed(spark)) == [(0, o) for o in range(5, 11)]
    rejects = job.committed_rejects(spark)
    assert {r.reject_reason for r in rejects.collect()} == {"behind_position"}
    assert offsets_of(rejects) == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 3), (0, 4)]
    assert OffsetLedger(spark, job.output).heads("g").first().saved_offset == 11


def test_topics_of_one_root_do_not_mix(spark, log_of, tmp_path, log_path):
    log = log_of([(0, o, message(o)) for o in range(3)]).unionByName(log_of([(0, 0, message(7))], topic="u"))
    append_log_files(log.coalesce(1), log_path)
    for topic, count in (("t", 3), ("u", 1)):
        job = job_for(tmp_path, FileLog(log_path), topic=topic)
        job.run(spark)
        assert job.committed(spark).count() == count


def test_a_commit_during_the_listing_is_missing_as_a_whole(spark, log_of, tmp_path, monkeypatch):
    job = job_for(tmp_path, FrameLog(log_of([(0, 0, message(1))])))
    job.run_batch(spark)

    def slow(*arguments):
        found = read_landed(*arguments)
        job.land_batch(log_of([(0, o, message(o)) for o in (1, 2)]), 1)
        return found

    monkeypatch.setattr(landing_module, "read_landed", slow)
    assert offsets_of(job.committed(spark)) == [(0, 0)]


def test_free_text_parameters_and_frames(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([(0, 0, message(1))])), parameters="free text")
    job.run_batch(spark)
    assert job.committed(spark).count() == 1
    with pytest.raises(ValueError, match="run_batch"):
        job.start(spark)


def test_a_second_writer_fails_by_name(spark, log_of, tmp_path, monkeypatch):
    """Another writer commits while a batch runs: the batch leaves no row to readers, and lands when offered again."""
    job, other = (job_for(tmp_path, FrameLog(log_of([]))) for _ in range(2))
    real = landing_module.write_messages

    def overtaken(*arguments, **settings):
        monkeypatch.setattr(landing_module, "write_messages", real)
        other.land_batch(log_of([(0, 0, message(1, "other")), (0, 1, message(1, "other"))]), 0, commit_key="theirs")
        real(*arguments, **settings)

    monkeypatch.setattr(landing_module, "write_messages", overtaken)
    batch = log_of([(0, o, message(2, "own")) for o in range(3)])
    nothing = OffsetLedger(spark, job.output).heads("g")
    with pytest.raises(FencedWriterError, match="entry 1 of 't'.*'theirs'"):
        job.land_batch(batch, 0, nothing, commit_key="ours")
    assert job.committed(spark).where("line like 'other%'").count() == job.committed(spark).count() == 2
    job.land_batch(batch, 0, commit_key="ours")
    assert offsets_of(job.committed(spark)) == [(0, 0), (0, 1), (0, 2)]


def test_ledger_reads_stay_flat(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(OffsetLedger, "SNAPSHOT_EVERY", 8)
    ledger, files = OffsetLedger(spark, str(tmp_path)), []
    columns = "topic string, partition int, start_offset bigint, next_offset bigint, grp string, commit_key string"
    for n in range(27):
        ledger.append(spark.createDataFrame([("a-b/c", 0, n, n + 1, "g", f"k{n}")], columns), "a-b/c")
        files.append(len(ledger.heads("g").inputFiles()))
    assert max(files) <= 8 and len(ledger.read().inputFiles()) == 3 + 3
    assert ledger.read().count() == 27 and ledger.heads("g").first().saved_offset == 27
    assert ledger.has_commit("k3") and ledger.has_commit("k26") and not ledger.has_commit("k27")
    # A writer that dies before its segment and snapshot: the entries still tell all.
    monkeypatch.setattr(ledger, "_snapshot", lambda *arguments: None)
    for n in range(27, 34):
        ledger.append(spark.createDataFrame([("a-b/c", 0, n, n + 1, "g", f"k{n}")], columns), "a-b/c")
    assert ledger.read().count() == 34 and ledger.heads("g").first().saved_offset == 34


def test_a_ledger_file_is_made_by_many_tasks_and_written_by_one(spark, tmp_path):
    def made_by(batches):
        for batch in batches:
            yield batch.assign(task=TaskContext.get().partitionId())

    ranges = spark.range(0, 60, 1, 6).mapInPandas(made_by, "id bigint, task int")
    folder = _Folder(spark, str(tmp_path / "ledger"))
    assert folder.put(ranges, "entry-t-1.parquet") and not folder.put(ranges, "entry-t-1.parquet")
    assert folder.put(ranges.where("id < 0"), "entry-t-2.parquet")
    first, second = (spark.read.parquet(f"{folder.path}/entry-t-{n}.parquet") for n in (1, 2))
    assert first.count() == 60 and first.select("task").distinct().count() == 6
    assert second.count() == 0 and second.columns == ["id", "task"]


def test_gaps_between_commits(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    job.land_batch(log_of([(0, o, message(o)) for o in (3, 4)] + [(1, 0, message(1))]), 0)
    assert job.gaps(spark).count() == 0
    job.land_batch(log_of([(0, o, message(o)) for o in (9, 10)] + [(1, 1, message(1))]), 1)
    assert [tuple(r) for r in job.gaps(spark).collect()] == [("t", 0, 5, 9, 4)]


def rows_of(frame):
    return sorted(tuple(row) for row in frame.select("partition", "offset", "line", "event_day", "event_hour", "commit_key").collect())


def test_compaction_shows_the_same_rows_before_during_and_after(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    assert not job.compact(spark)
    for batch in range(6):
        rows = [(p, o, message(o % 3 * 24, f"{p}-{o}") if o % 5 else "reject") for p in (0, 1) for o in range(batch * 10, batch * 10 + 10)]
        job.land_batch(log_of(rows), batch)
        before = rows_of(job.committed(spark))
        assert len(before) == (batch + 1) * 16
        opened_before = job.committed(spark)
        job.compact(spark, commit=False)
        assert rows_of(job.committed(spark)) == before
        assert job.compact(spark)
        assert rows_of(job.committed(spark)) == before
        assert rows_of(opened_before) == before
        assert job.committed_rejects(spark).count() == (batch + 1) * 4
    assert not job.compact(spark)
    packs = PackManifest(spark, job.output, "t", job.mapper.buckets).packs().collect()
    assert sum(r.n_rows for r in packs) == len(before)
    sizes = {day: sorted(r.n_rows for r in packs if r.day == day) for day in {r.day for r in packs}}
    assert len(sizes) == 3 and all(b > 2 * a for s in sizes.values() for a, b in zip(s, s[1:]))


def test_a_day_is_read_from_its_own_folders(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    for batch in range(2):
        job.land_batch(log_of([(0, o, message(o * 24)) for o in range(batch * 4, batch * 4 + 4)]), batch)
    job.compact(spark)
    one = job.committed(spark, days=["1970-01-03"])
    assert offsets_of(one) == [(0, 2)]
    assert [f.split("/event_day=")[1][:10] for f in one.inputFiles()] == ["1970-01-03"]
    assert job.committed(spark, days=["2001-01-01"]).isEmpty()
    job.land_batch(log_of([(0, 8, message(48)), (0, 9, message(72))]), 2)
    again = job.committed(spark, days=["1970-01-03"])
    assert offsets_of(again) == [(0, 2), (0, 8)]
    assert len([f for f in again.inputFiles() if "/messages/" in f]) == 2


def test_commits_of_rejects_and_overlaps_are_compacted(spark, log_of, tmp_path):
    job = job_for(tmp_path, FrameLog(log_of([])))
    job.land_batch(log_of([(0, 0, "reject")]), 0)
    assert job.compact(spark) and job.committed(spark).isEmpty()
    nothing = OffsetLedger(spark, job.output).heads("g").limit(0)
    ledger = OffsetLedger(spark, job.output)
    commits = (("b", 1, 5), ("a", 3, 8))
    for key, low, high in commits:
        job.land_batch(log_of([(0, o, message(o, key)) for o in range(low, high)]), 1, nothing, commit_key=key, commit=False)
    for at, (key, low, high) in enumerate(commits):
        row = [("t", "g", 0, low, high, 1, key, 9 - at)]
        ledger.append(spark.createDataFrame(row, "topic string, grp string, partition int, start_offset bigint, next_offset bigint, batch_id bigint, commit_key string, committed_ms bigint"))
        job.compact(spark)
    # The first commit was in a pack before the other, whose time is earlier, came.
    shown = [(r.offset, r.commit_key) for r in job.committed(spark).orderBy("offset").collect()]
    assert shown == [(o, "b") for o in range(1, 5)] + [(o, "a") for o in range(5, 8)]


def test_a_second_compaction_fails_by_name(spark, log_of, tmp_path, monkeypatch):
    job = job_for(tmp_path, FrameLog(log_of([])))
    job.land_batch(log_of([(0, 0, message(0)), (0, 1, message(30))]), 0)
    enter = PackManifest._enter

    def overtaken(self, *args):
        monkeypatch.setattr(PackManifest, "_enter", enter)
        assert job.compact(spark)
        enter(self, *args)

    monkeypatch.setattr(PackManifest, "_enter", overtaken)
    with pytest.raises(FencedWriterError, match="entry 1 of the manifest"):
        job.compact(spark)
    assert offsets_of(job.committed(spark)) == [(0, 0), (0, 1)]


def test_routes_of_any_text_are_compacted(spark, log_of, tmp_path):
    def by_line(log):
        return log.select(*KEYS, "offset", F.col("value").alias("line"), F.nullif(F.col("value"), F.lit("none")).alias("route"))

    mapper = Mapper("any_route", by_line, ROUTE_BUCKETS)
    job = job_for(tmp_path, FrameLog(log_of([])), mapper=mapper, topic="t")
    lines = ["a/b", "a=b", "x y", "50%", "[1]", "none", "{q}", "ü:1"]
    job.land_batch(log_of([(0, i, line) for i, line in enumerate(lines)]), 0)
    before = sorted(map(str, job.committed(spark).collect()))
    job.compact(spark)
    assert len(before) == len(lines) and sorted(map(str, job.committed(spark).select(*job.committed(spark).columns).collect())) == before
    for line in lines:
        assert [r.line for r in job.committed(spark, days=[None if line == "none" else line]).collect()] == [line]
