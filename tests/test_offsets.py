import json

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from siltbed.operators import incremental_scan, ledger_heads, partition_bounds, resolve_start, small_side
from siltbed.schema import BOUNDS_SCHEMA, LEDGER_SCHEMA
from siltbed.sources import FileLog, KafkaLog, decode_messages, kafka_starting_offsets, print_tail, tail_log
from siltbed.sources.zones import FileZones
from siltbed.streaming import OffsetLedger

# partition, saved, explicit, start under earliest, start under latest, start under none
START_CASES = [
    (0, None, None, 10, 100, None),
    (1, 50, None, 50, 50, 50),
    (2, 5, None, 10, 10, 10),
    (3, 500, None, 100, 100, 100),
    (4, 50, 70, 70, 70, 70),
    (5, None, -5, 10, 10, 10),
    (6, 50, -5, 50, 50, 50),
    (7, 100, None, 100, 100, 100),
]


def start_frames(spark, cases):
    bounds = spark.createDataFrame([("t", p, 10, 100) for p, *_ in cases], BOUNDS_SCHEMA)
    saved = spark.createDataFrame([("t", p, s) for p, s, *_ in cases], "topic string, partition int, saved_offset bigint")
    explicit = spark.createDataFrame(
        [("t", p, e) for p, _, e, *_ in cases], "topic string, partition int, explicit_offset bigint"
    )
    return bounds, saved, explicit


@pytest.mark.parametrize(("policy", "column"), [("earliest", 3), ("latest", 4)])
def test_resolve_start(spark, policy, column):
    bounds, saved, explicit = start_frames(spark, START_CASES)
    got = resolve_start(bounds, saved, explicit=explicit, policy=policy)
    assert {r.partition: r.start_offset for r in got.collect()} == {c[0]: c[column] for c in START_CASES}


@pytest.mark.parametrize("policy", ["none", "no_such_policy"])
def test_no_offset_without_a_policy_is_an_error(spark, policy):
    bounds, saved, explicit = start_frames(spark, START_CASES[1:])
    got = resolve_start(bounds, saved, explicit=explicit, policy=policy)
    assert {r.partition: r.start_offset for r in got.collect()} == {c[0]: c[5] for c in START_CASES[1:]}
    with pytest.raises(Exception, match="no start offset"):
        resolve_start(*start_frames(spark, START_CASES)[:2], policy=policy).collect()


def test_one_explicit_offset_for_all(spark):
    bounds, saved, _ = start_frames(spark, START_CASES)
    got = resolve_start(bounds, saved, explicit=33)
    assert {r.start_offset for r in got.collect()} == {33}


def test_bounds_and_scan(spark, log_of, tmp_path):
    rows = [(0, o, f"v{o}") for o in range(5, 20)] + [(1, o, f"w{o}") for o in range(100, 103)]
    log_of(rows).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    bounds = {(r.partition, r.earliest, r.latest) for r in partition_bounds(log).collect()}
    assert bounds == {(0, 5, 20), (1, 100, 103)}
    starts = spark.createDataFrame([("t", 0, 17), ("t", 1, 101)], "topic string, partition int, start_offset bigint")
    expected = {(0, 17), (0, 18), (0, 19), (1, 101), (1, 102)}
    for bound in (1_000_000, 0):  # broadcast, and the shuffle join past the size bound
        scan = incremental_scan(log, starts, max_rows=bound)
        assert {(r.partition, r.offset) for r in scan.collect()} == expected
    plan = incremental_scan(log, starts)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,ScalarSubquery" in plan or "offset" in plan.split("PushedFilters")[1]


def test_small_side_is_broadcast_only_within_its_bound(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    for bound, broadcast in ((10, True), (9, False)):
        joined = big.join(small_side(spark.range(10).withColumnRenamed("id", "k"), bound), "k")
        assert ("ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()) == broadcast
        assert joined.count() == 10


def test_ledger_heads_and_overlap(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path))
    assert ledger.read().count() == 0

    def rows(*ranges):
        columns = T.StructType(LEDGER_SCHEMA.fields[:7])
        return spark.createDataFrame([("t", "g", p, s, n, b, "") for p, s, n, b in ranges], columns)

    ledger.commit(rows((0, 0, 10, 0), (1, 5, 9, 0)))
    ledger.commit(rows((0, 10, 30, 1)))
    heads = {r.partition: r.saved_offset for r in ledger_heads(ledger.read(), "g").collect()}
    assert heads == {0: 30, 1: 9}
    assert ledger_heads(ledger.read(), "other").count() == 0
    with pytest.raises(ValueError, match="overlaps"):
        ledger.commit(rows((1, 8, 12, 2)))


def test_topic_options_and_starting_offsets():
    options = KafkaLog("h:1,h:2", "t", min_partitions=64, options={"maxOffsetsPerTrigger": "9"}).source_options()
    assert options["kafka.bootstrap.servers"] == "h:1,h:2"
    assert (options["subscribe"], options["startingOffsets"]) == ("t", "earliest")
    assert (options["minPartitions"], options["maxOffsetsPerTrigger"]) == ("64", "9")
    assert json.loads(kafka_starting_offsets("t", 3, {1: 50}))["t"] == {"0": -2, "1": 50, "2": -2}
    assert json.loads(kafka_starting_offsets("t", 2, {1: 50}, policy="latest"))["t"] == {"0": -1, "1": 50}
    assert json.loads(kafka_starting_offsets("t", 2, {1: 50}, explicit=70))["t"] == {"0": 70, "1": 70}
    assert json.loads(kafka_starting_offsets("t", 2, {1: 50}, explicit=-5, policy="none"))["t"] == {"0": -2, "1": 50}
    with pytest.raises(ValueError):
        kafka_starting_offsets("t", 2, {1: 50}, policy="none")


def test_decode_and_tail(spark):
    records = spark.createDataFrame(
        [("t", 0, 4, bytearray(b"k"), bytearray(b"a\xffb")), ("t", 1, 5, bytearray(b"k"), bytearray(b"c")), ("t", 0, 6, None, None)],
        "topic string, partition int, offset bigint, key binary, value binary",
    )
    lines = [r.line for r in tail_log(decode_messages(records)).orderBy("offset").collect()]
    assert lines == ["offset = 4, key = k, value = a�b", "offset = 6, key = null, value = null"]


def test_next_offset_reaches_mappers(log_of):
    from siltbed.operators import next_offset

    assert log_of([(0, 41, "x")]).select(next_offset(F.col("offset"))).first()[0] == 42


def test_zones_read_only_files_past_their_own_partitions_start(spark, log_of, tmp_path):
    log_path, columns = str(tmp_path / "a log"), "topic string, partition int, start_offset bigint"
    for low in range(0, 40, 10):
        for partition in (0, 1):
            log_of([(partition, o, "v") for o in range(low, low + 10)]).coalesce(1).write.mode("append").parquet(log_path)
    zones = FileZones(spark, log_path, str(tmp_path / "zones"))
    starts = spark.createDataFrame([("t", 0, 2), ("t", 1, 35)], columns)  # partition 0 lags
    got = zones.scan(starts)
    assert {(r.partition, r.offset) for r in got.collect()} == {(0, o) for o in range(2, 40)} | {(1, o) for o in range(35, 40)}
    assert len(zones.files_past(starts)) == 4 + 1
    log_of([(1, 40, "v")]).coalesce(1).write.mode("append").parquet(log_path)
    log_of([]).coalesce(1).write.mode("append").parquet(log_path)
    late = spark.createDataFrame([("t", 1, 40)], columns)
    assert [r.offset for r in zones.scan(late).collect()] == [40] and len(zones.files_past(late)) == 1
    known = zones.read().count()
    assert zones.scan(spark.createDataFrame([("t", 1, 41)], columns)).count() == 0 and zones.read().count() == known
    assert FileZones(spark, log_path, str(tmp_path / "other")).read().count() == 0


def test_print_tail_prints_one_partition(spark, log_of, tmp_path):
    log_path = str(tmp_path / "log")
    log_of([(0, 4, "shown"), (0, 5, None), (1, 0, "other")]).write.parquet(log_path)
    query = print_tail(FileLog(log_path), spark, str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and "Console" in query.lastProgress["sink"]["description"]
    read = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(read) == 1 and read[0]["sink"]["numOutputRows"] in (2, -1)
