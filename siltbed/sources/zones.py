"""A zone map of a log folder: which offsets of which partitions each file holds.

One lagging partition would make a scan start at its position in every file, as
only the smallest start reaches the footers. With the map, a file is read only if
it holds something past the start of one of its own partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.offsets import KEYS, incremental_scan, next_offset
from siltbed.operators.small_side import MAX_BROADCAST_ROWS, small_side
from siltbed.schema import LOG_SCHEMA, ZONES_SCHEMA
from siltbed.streaming.tables import read_or_empty


class FileZones:
    """Zones of the Parquet files under ``log_path``, kept as a table under ``zones_path``.

    Files are taken as unchanging: one is read for its zones once, and of it only
    topic, partition and offset. A file without rows is known, and never read again.
    """

    def __init__(self, spark: SparkSession, log_path: str, zones_path: str):
        self.spark, self.log_path, self.zones_path = spark, log_path, zones_path

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.zones_path, ZONES_SCHEMA)

    def update(self) -> None:
        """Add the files that the table does not hold yet."""
        # Only names are taken: the content column is pruned, so no file is opened here.
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.log_path)
        listed = listed.select("path", F.col("_metadata.file_path").alias("uri"))
        new = listed.join(self.read().select("uri").distinct(), "uri", "left_anti")
        paths = [row["path"] for row in new.toLocalIterator()]  # as many as Spark lists on the driver to read them
        if not paths:
            return
        log = self.spark.read.schema(LOG_SCHEMA).parquet(*paths)
        zones = log.groupBy(F.col("_metadata.file_path").alias("uri"), *KEYS).agg(
            F.min("offset").alias("earliest"), next_offset(F.max("offset")).alias("latest")
        )
        new.join(zones, "uri", "left").select(*ZONES_SCHEMA.fieldNames()).write.mode("append").parquet(self.zones_path)

    def files_past(self, starts: DataFrame) -> list[str]:
        """Paths of the files with an offset at or past its partition's ``start_offset``."""
        held = self.read().join(small_side(starts), KEYS).where(F.col("latest") > F.col("start_offset"))
        return [row["path"] for row in held.select("path").distinct().toLocalIterator()]

    def scan(self, starts: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
        """Log rows at or past their partition's start, from the files that hold any."""
        self.update()
        paths = self.files_past(starts)
        log = self.spark.read.schema(LOG_SCHEMA).parquet(*(paths or [self.log_path]))
        return incremental_scan(log if paths else log.limit(0), starts, max_rows)
