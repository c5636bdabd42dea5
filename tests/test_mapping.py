import pytest
from pyspark.sql import functions as F

from siltbed.operators import accepted, csv_hour_mapper, get_mapper, register_mapper, rejected, row_mapper, table_mapper
from siltbed.operators import mapping

HEAD = "a,b,c,d,e,f,g,h,i"

CASES = [
    (f"{HEAD},1451577600000", "2016-1-1/0", None),
    (f"{HEAD},+12", "1970-1-1/8", None),
    (f"{HEAD},-1", "1970-1-1/7", None),
    (f"{HEAD},5,x,,", "1970-1-1/8", None),
    (",,,,,,,,,5", "1970-1-1/8", None),
    (f"{HEAD}, 12 ", None, "bad_timestamp"),
    (f"{HEAD},12\n", None, "bad_timestamp"),
    (f"{HEAD},12.5", None, "bad_timestamp"),
    (f"{HEAD},,x", None, "bad_timestamp"),
    (f"{HEAD},٣", None, "bad_timestamp"),
    (f"{HEAD},9223372036854775808", None, "bad_timestamp"),
    (f"{HEAD},9223372036854775807", None, "timestamp_out_of_range"),
    (f"{HEAD},-9223372036854775808", None, "timestamp_out_of_range"),
    (HEAD, None, "bad_timestamp"),  # nine fields pass the count but hold no field 9
    ("a,b,c,d,e,f,g,h", None, "too_few_fields"),
    ("a,b,c,,,,,,,,,", None, "too_few_fields"),
    ("", None, "too_few_fields"),
    (None, None, "null_value"),
]


def test_every_message_is_routed_or_rejected_with_a_reason(log_of):
    mapped = csv_hour_mapper(log_of([(0, i, text) for i, (text, _, _) in enumerate(CASES)]))
    rows = mapped.orderBy("offset").collect()
    assert [(r.line, r.route, r.reject_reason) for r in rows] == CASES
    assert [r.next_offset for r in rows] == [r.offset + 1 for r in rows]
    assert accepted(mapped).count() + rejected(mapped).count() == len(CASES)


def test_filter_on_result_stays_in_generated_code_and_reaches_the_scan(spark, log_of, tmp_path):
    log_of([(0, 1, f"{HEAD},5")]).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    wanted = accepted(csv_hour_mapper(log)).where("partition = 0 and offset > 0 and event_hour = 8").select("line")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(offset,0)" in plan and "EqualTo(partition,0)" in plan
    assert "key:string" not in plan  # the key is not read
    assert wanted.count() == 1


def test_positions_and_delimiter_are_parameters(log_of):
    mapped = csv_hour_mapper(log_of([(0, 0, "x|3600000")]), delimiter="|", ts_index=1, min_fields=2, utc_offset_hours=0)
    assert mapped.first().route == "1970-1-1/1"


def test_registry(log_of):
    with pytest.raises(ValueError, match="no mapper named"):
        get_mapper("nowhere")

    @register_mapper("upper_for_test")
    def upper(log, *, route="r"):
        return log.select("topic", "partition", "offset", F.lit(route).alias("route"), F.upper("value").alias("line"))

    try:
        row = get_mapper("upper_for_test")(log_of([(0, 0, "x")]), route="z").first()
        assert (row.route, row.line) == ("z", "X")
    finally:
        mapping._REGISTRY.pop("upper_for_test")


def test_mapper_by_module(log_of, tmp_path, monkeypatch):
    (tmp_path / "own_mappers.py").write_text(
        "class Echo:\n"
        "    def eval(self, topic, partition, next_offset, key, message, parameters):\n"
        "        yield 'echo', message\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    assert get_mapper("siltbed.plans.sample_mappers:alerts").name == "alerts"
    assert get_mapper("own_mappers:Echo").name == "own_mappers:Echo"
    with pytest.raises(ValueError, match="no mapper named"):
        get_mapper("own_mappers:Other")
    with pytest.raises(ModuleNotFoundError):
        get_mapper("no_such_module:Echo")


def test_row_mapper_emits_zero_to_many(log_of):
    class Repeat:
        def eval(self, topic, partition, next_offset, key, message, parameters):
            import json

            for i in range(json.loads(parameters)["times"] if message else 0):
                yield f"{topic}/{partition}", f"{next_offset}:{key}:{message}:{i}"

    rows = row_mapper(Repeat)(log_of([(1, 7, "m"), (1, 8, None)]), times=2).orderBy("line").collect()
    assert [(r.route, r.line, r.offset) for r in rows] == [("t/1", "8:k7:m:0", 7), ("t/1", "8:k7:m:1", 7)]


def test_table_mapper_is_set_up_once_per_task(log_of):
    def handler():
        class Counted:
            def configure(self, topic, output, parameters):
                import uuid

                self.own, self.settings = uuid.uuid4().hex, (topic, output, parameters["times"])

            def eval(self, partition, next_offset, key, message):
                for i in range(self.settings[2] if message else 0):
                    yield self.own, f"{self.settings[0]}{self.settings[1]}:{next_offset}:{key}:{message}:{i}"

        return Counted

    log = log_of([(0, o, "m" if o else None) for o in range(40)]).repartition(3)
    rows = table_mapper(handler())(log, output="/out", times=2).collect()
    assert len(rows) == 2 * 39 and len({r.route for r in rows}) <= 3
    assert sorted(r.line for r in rows if r.offset == 7) == ["t/out:8:k7:m:0", "t/out:8:k7:m:1"]


def test_table_mapper_checks_parameters_before_it_runs(log_of):
    with pytest.raises(Exception, match="types must be a list"):
        get_mapper("alert_table")(log_of([(0, 0, "x")]), types="error").schema
