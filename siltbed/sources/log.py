"""Log sources: a topic, or a directory of Parquet files with the same columns.

Both give (topic, partition, offset, key, value) as a bounded or a streaming
DataFrame. Spark plans every partition of the topic, so none is left unread.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import decode_text
from siltbed.schema import LOG_SCHEMA


@dataclass(frozen=True)
class FileLog:
    """Parquet files of log rows.

    As a stream, files must arrive in offset order per partition, as a topic
    would deliver them; a landing job fails on rows that do not.
    """

    path: str
    topic: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._of_topic(spark.read.schema(LOG_SCHEMA).parquet(self.path))

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(LOG_SCHEMA).options(**self.options)
        return self._of_topic(reader.parquet(self.path))

    def _of_topic(self, log: DataFrame) -> DataFrame:
        return log if self.topic is None else log.where(F.col("topic") == self.topic)


@dataclass(frozen=True)
class FrameLog:
    """Log rows that are already a DataFrame, for bounded landing."""

    frame: DataFrame

    def read(self, spark: SparkSession) -> DataFrame:
        return self.frame.select(*LOG_SCHEMA.fieldNames())


# How the source spells "from the start" and "from the end" per partition.
KAFKA_EARLIEST, KAFKA_LATEST = -2, -1


@dataclass(frozen=True)
class KafkaLog:
    """A topic. Needs the Spark Kafka connector on the class path.

    ``min_partitions`` lets one large topic-partition be read by several tasks;
    ``n_partitions`` is the topic's partition count, for per-partition starts.
    Offsets that are no longer available resume at the earliest one held.
    """

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    min_partitions: int | None = None
    n_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def source_options(self) -> dict[str, str]:
        base = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": "false",
        }
        if self.min_partitions is not None:
            base["minPartitions"] = str(self.min_partitions)
        return {**base, **self.options}

    def starts_at_end(self) -> bool:
        """Whether any partition starts at its end, which only a stream can do."""
        if self.starting_offsets in ("earliest", "latest"):
            return self.starting_offsets == "latest"
        return any(KAFKA_LATEST in offsets.values() for offsets in json.loads(self.starting_offsets).values())

    def read(self, spark: SparkSession) -> DataFrame:
        if self.starts_at_end():
            raise ValueError("a bounded read of a topic cannot start at its end; start a stream")
        return decode_messages(spark.read.format("kafka").options(**self.source_options()).load())

    def stream(self, spark: SparkSession) -> DataFrame:
        return decode_messages(spark.readStream.format("kafka").options(**self.source_options()).load())


def kafka_starting_offsets(
    topic: str,
    n_partitions: int,
    saved: dict[int, int] | None = None,
    explicit: int | None = None,
    policy: str = "earliest",
) -> str:
    """``startingOffsets`` JSON, by the same precedence as ``start_position``.

    The connector wants every partition of the topic named.
    """
    saved = saved or {}
    positions: dict[str, int] = {}
    for partition in range(n_partitions):
        if explicit is not None and explicit >= 0:
            position = explicit
        elif partition in saved:
            position = saved[partition]
        elif explicit is not None or policy == "earliest":
            position = KAFKA_EARLIEST
        elif policy == "latest":
            position = KAFKA_LATEST
        else:
            raise ValueError(f"no offset for partition {partition} of {topic!r} and the reset policy is {policy!r}")
        positions[str(partition)] = position
    return json.dumps({topic: positions})


def decode_messages(records: DataFrame) -> DataFrame:
    """Log rows from records whose key and value are bytes."""
    return records.select(
        "topic",
        "partition",
        "offset",
        decode_text(F.col("key")).alias("key"),
        decode_text(F.col("value")).alias("value"),
    )


def tail_line() -> Column:
    """Debug text of one record; a missing key or value prints as ``null``."""
    return F.concat(
        F.lit("offset = "),
        F.col("offset").cast("string"),
        F.lit(", key = "),
        F.coalesce(F.col("key"), F.lit("null")),
        F.lit(", value = "),
        F.coalesce(F.col("value"), F.lit("null")),
    )


def tail_log(log: DataFrame, partition: int = 0) -> DataFrame:
    """One partition of the log as debug lines."""
    return log.where(F.col("partition") == partition).select("topic", "partition", "offset", tail_line().alias("line"))


def print_tail(source: FileLog | KafkaLog, spark: SparkSession, checkpoint: str, partition: int = 0):
    """Start a console query that prints the tail; give a KafkaLog ``starting_offsets='latest'``."""
    return (
        tail_log(source.stream(spark), partition)
        .select("line")
        .writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )
