"""Outputs besides the landed table: line text and topics."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from siltbed.operators.small_side import small_side
from siltbed.schema import HOUR_BUCKETS

# Text codecs that Spark can write without extra libraries.
TEXT_CODECS = ("none", "gzip", "bzip2", "lz4", "snappy", "deflate")


def export_text(
    rows: DataFrame, path: str, buckets: T.StructType = HOUR_BUCKETS, compression: str = "gzip"
) -> None:
    """Write mapped or landed lines as text, in offset order, under bucket, partition and start offset.

    The start offset is the smallest of the partition among the exported rows. So
    a later export adds folders to an hour and leaves what is there, and the same
    export again replaces its own. Every task sorts what it has read, which
    follows the log; nothing is shuffled but the start offsets. A line that
    contains a newline becomes two lines of text; the landed table keeps it whole.
    """
    if compression not in TEXT_CODECS:
        raise ValueError(f"text codec must be one of {TEXT_CODECS}, got {compression!r}")
    keys = ["topic", "partition"]
    starts = rows.groupBy(*keys).agg(F.min("offset").alias("start_offset"))
    directories = ["topic", *buckets.fieldNames(), "partition", "start_offset"]
    (
        rows.select("line", "topic", *buckets.fieldNames(), "partition", "offset")
        .join(small_side(starts), keys)
        .select("line", *directories, "offset")
        .sortWithinPartitions(*directories, "offset")
        .drop("offset")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*directories)
        .text(path)
    )


def read_text(spark: SparkSession, path: str, buckets: T.StructType = HOUR_BUCKETS) -> DataFrame:
    """Exported lines with their directory columns."""
    line, topic = T.StructField("line", T.StringType()), T.StructField("topic", T.StringType())
    place = [T.StructField("partition", T.IntegerType()), T.StructField("start_offset", T.LongType())]
    return spark.read.schema(T.StructType([line, topic, *buckets.fields, *place])).text(path)


# The codecs of named text files and the endings that readers know them by.
NAMED_CODECS = {"none": "", "gzip": ".gz", "bzip2": ".bz2", "zstd": ".zst"}

# Offsets of a partition that share a file of a route: what one task writes of a hot route at most.
SLICE_OFFSETS = 1 << 22


def named_text_source() -> type:
    """Data source that writes (name, line) rows, in runs of one name, to a text file for every name.

    Tasks write under ``_temporary``, which readers skip, and tell the driver their
    names; the commit moves the files to them, so a failed attempt or a lost executor
    leaves nothing that is read, and the same export again replaces its own files. Made
    in a function so that it travels by value, and executors need not have this package.
    """
    codecs = dict(NAMED_CODECS)

    @dataclass
    class Written(WriterCommitMessage):
        files: list

    class NamedTextWriter(DataSourceArrowWriter):
        def __init__(self, path: str, codec: str):
            self.path, self.codec, self.job = path, codec, uuid.uuid4().hex

        def _files(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path)

        def write(self, iterator):
            import uuid

            files, root = self._files()
            compression = {"none": None, "bzip2": "bz2"}.get(self.codec, self.codec)
            attempt = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}"
            files.create_dir(attempt, recursive=True)
            written, name, out = [], None, None
            for batch in iterator:
                names, lines = (batch.column(i).to_pylist() for i in (0, 1))
                at = 0
                while at < len(names):
                    end = at
                    while end < len(names) and names[end] == names[at]:
                        end += 1
                    if names[at] != name:
                        if out is not None:
                            out.close()
                        name, place = names[at], f"{attempt}/{len(written)}"
                        out = files.open_output_stream(place, compression=compression)
                        written.append((place, name + codecs[self.codec]))
                    out.write(("\n".join(lines[at:end]) + "\n").encode())
                    at = end
            if out is not None:
                out.close()
            return Written(written)

        def commit(self, messages):
            files, root = self._files()
            moves = [move for message in messages if message is not None for move in message.files]
            for folder in sorted({name.rpartition("/")[0] for _, name in moves}):
                files.create_dir(f"{root}/{folder}", recursive=True)

            def move(pair):
                place, final = pair[0], f"{root}/{pair[1]}"
                if files.get_file_info(final).is_file:
                    files.delete_file(final)
                files.move(place, final)

            with ThreadPoolExecutor(16) as pool:
                list(pool.map(move, moves))
            self._clear(files, root)

        def abort(self, messages):
            self._clear(*self._files())

        def _clear(self, files, root):
            from pyarrow import fs

            if files.get_file_info(f"{root}/_temporary/{self.job}").type != fs.FileType.NotFound:
                files.delete_dir(f"{root}/_temporary/{self.job}")

    class NamedText(DataSource):
        @classmethod
        def name(cls):
            return "named_text"

        def writer(self, schema, overwrite):
            return NamedTextWriter(self.options["path"], self.options["compression"])

    return NamedText


def export_named_text(
    rows: DataFrame,
    path: str,
    starts: DataFrame | None = None,
    compression: str = "gzip",
    slice_offsets: int = SLICE_OFFSETS,
) -> None:
    """Write mapped lines to ``<path>/<topic>/<route>-<partition>.<start offset>.gz``, in offset order.

    ``starts`` has the start offset of each (topic, partition), by default its
    smallest offset among the rows. A route's lines of one partition are one file,
    except that every ``slice_offsets`` offsets begin another, under the offset they
    begin at: so the file of a hot route is written by several tasks. Lines cross one
    shuffle, by file. A later export adds files to an hour; the same again replaces
    its own. A line that contains a newline becomes two lines of text.
    """
    if compression not in NAMED_CODECS:
        raise ValueError(f"codec of named text must be one of {tuple(NAMED_CODECS)}, got {compression!r}")
    keys = ["topic", "partition"]
    if starts is None:
        starts = rows.groupBy(*keys).agg(F.min("offset").alias("start_offset"))
    first = F.col("start_offset")
    start = first + F.call_function("div", F.col("offset") - first, F.lit(slice_offsets)) * F.lit(slice_offsets)
    file = F.concat_ws("", "topic", F.lit("/"), "route", F.lit("-"), F.col("partition").cast("string"), F.lit("."), start.cast("string"))
    spark = rows.sparkSession
    spark.dataSource.register(named_text_source())
    (
        rows.select("topic", "partition", "offset", "route", "line")
        .join(small_side(starts), keys)
        .select(file.alias("name"), F.coalesce("line", F.lit("")).alias("line"), "offset")
        .repartition("name")
        .sortWithinPartitions("name", "offset")
        .select("name", "line")
        .write.format("named_text")
        .option("path", path)
        .option("compression", compression)
        .mode("append")
        .save()
    )


def read_named_text(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line) of exported files; the name is relative to ``path``."""
    root = path.split("://")[-1].removeprefix("file:").rstrip("/")
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    name = F.substring_index(F.col("_metadata.file_path"), f"{root}/", -1)
    return lines.select(name.alias("file_name"), F.col("value").alias("line"))


def producer_payload(spark: SparkSession, n: int = 100) -> DataFrame:
    """``n`` numbered messages whose key and value are both the number."""
    return payload_of(spark.range(n), "id")


def payload_of(rows: DataFrame, number: str) -> DataFrame:
    text = F.col(number).cast("string")
    return rows.select(text.alias("key"), text.alias("value"))


def produce(payload: DataFrame, servers: str, topic: str) -> None:
    """Send key/value rows to a topic and wait for all replicas."""
    writer = payload.select("key", "value").write.format("kafka")
    writer.options(**producer_options(servers, topic)).save()


def producer_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def append_log_files(log: DataFrame, path: str) -> None:
    """Append log rows to a file log, each file sorted by partition and offset."""
    columns = ["topic", "partition", "offset", "key", "value"]
    log.select(*columns).sortWithinPartitions("topic", "partition", "offset").write.mode("append").parquet(path)
