"""The message log that the catalogue's queries read, derived from ``events``.

Event ``i`` becomes offset ``i div 5`` of partition ``i % 5``. ``i % 40`` picks
the message's shape, so that every rule of the parser is met at every scale.
The same log is written in both dialects: Spark's for the queries, DuckDB's for
their oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "tracking"
N_PARTITIONS = 5

_SHAPES = """
    when 0 then concat(head, ',x')
    when 1 then concat(head, ',f4,f5,f6,f7,f8')
    when 2 then concat(head, ',f4,f5,f6,f7,f8,n/a')
    when 3 then concat(head, ',f4,f5,f6,f7,f8, ', ms, ' ')
    when 4 then concat(head, ',f4,f5,f6,f7,f8,', ms, '.5')
    when 5 then concat(head, ',,,,,,,')
    when 6 then concat(head, ',f4,f5,f6,f7,f8,', ms, ',x,y')
    when 7 then concat(head, ',f4,f5,f6,f7,f8,+', ms)
    when 8 then concat(head, ',f4,f5,f6,f7,f8,9223372036854775807')
    when 9 then null
    when 10 then ''
    when 11 then concat(head, ',f4,f5,f6,f7,f8,', ms - 259200000)
    when 12 then concat(head, ',f4,f5,f6,f7,é😀,', ms)
    else concat(head, ',f4,f5,f6,f7,f8,', ms)
"""

SPARK_MESSAGES = f"""
select '{TOPIC}' as topic, cast(event_id % {N_PARTITIONS} as int) as partition,
  event_id div {N_PARTITIONS} as offset, cast(user_id as string) as key,
  case cast(event_id % 40 as int) {_SHAPES} end as value
from (
  select event_id, user_id,
    concat_ws(',', cast(event_id as string), cast(user_id as string), event_type, props) as head,
    extract(day from since) * 86400000L + extract(hour from since) * 3600000L
      + extract(minute from since) * 60000L + cast(floor(extract(second from since) * 1000) as bigint) as ms
  from (select *, ts - timestamp_ntz'1970-01-01 00:00:00' as since from {{events}}))
"""

DUCKDB_MESSAGES = f"""
select '{TOPIC}' as topic, cast(event_id % {N_PARTITIONS} as int) as "partition",
  event_id // {N_PARTITIONS} as "offset", cast(user_id as varchar) as key,
  case cast(event_id % 40 as int) {_SHAPES} end as value
from (
  select event_id, user_id, concat_ws(',', event_id, user_id, event_type, props) as head,
    epoch_us(ts) // 1000 as ms
  from events)
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows (topic, partition, offset, key, value)."""
    return spark.sql(SPARK_MESSAGES, events=events(spark, sf_dir))


def binary_records(log: DataFrame) -> DataFrame:
    """The log as a topic delivers it, with key and value as bytes."""
    return log.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")})


def before_cut(bounds: DataFrame) -> DataFrame:
    """Per-partition half-way offset."""
    return bounds.select("topic", "partition", F.call_function("div", F.col("latest"), F.lit(2)).alias("cut"))


def is_first_half(cut: Column) -> Column:
    return F.col("offset") < cut
