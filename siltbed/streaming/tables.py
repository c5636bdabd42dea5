"""Tables under one output root.

    <root>/messages/commit_key=/outcome=landed/topic=/<buckets>/
    <root>/messages/commit_key=/outcome=rejected/topic=/...
    <root>/ledger/, <root>/ledger_heads/   (see ``ledger``)
    <root>/packs/, <root>/manifest/        (see ``packs``)

Landed and rejected rows are one write, so a batch is scanned and parsed once.
Each commit key is its own folder: writing a batch again replaces that folder
and nothing else, the rows of another attempt never mix with it, and late
messages reach their old hour under the key of the batch that brought them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions import utf16_length
from siltbed.schema import HOUR_BUCKETS, messages_schema

LANDED, REJECTED = "landed", "rejected"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet rows, or no rows when nothing has been written to ``path`` yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # A literal plan cut to no rows is known to be empty: joins with it are planned away.
        nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
        return spark.range(1).select(*nulls).limit(0)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_messages(
    rows: DataFrame,
    root: str,
    commit_key: str,
    buckets: T.StructType = HOUR_BUCKETS,
    *,
    rebalance: bool = False,
    compression: str = "zstd",
) -> None:
    """Write mapped rows as the whole content of one commit key.

    Nothing is shuffled by default: each task writes the hours its slice of the
    log touches, so an hour or partition with most of the rows is still written
    by as many tasks as read it. ``rebalance`` shuffles by directory first for
    fewer files; adaptive execution then splits the directories that are large.
    Each line's length is kept beside it, so that a batch's size can be read back
    without its text.
    """
    directories = ["outcome", "topic", *buckets.fieldNames()]
    reason = F.col("reject_reason") if "reject_reason" in rows.columns else F.lit(None).cast("string")
    shaped = rows.select(
        "partition",
        "offset",
        "line",
        reason.alias("reject_reason"),
        utf16_length(F.col("line")).cast("int").alias("chars"),
        F.when(reason.isNull(), LANDED).otherwise(REJECTED).alias("outcome"),
        *directories[1:],
    )
    if rebalance:
        shaped = shaped.hint("rebalance", *directories)
    (
        shaped.sortWithinPartitions(*directories, "partition", "offset")
        .write.mode("overwrite")
        # The folder holds one batch only, so stale files of an earlier attempt must go with it.
        .option("partitionOverwriteMode", "static")
        .option("compression", compression)
        .partitionBy(*directories)
        .parquet(f"{root}/messages/commit_key={commit_key}")
    )


def read_commit(spark: SparkSession, root: str, commit_key: str, buckets: T.StructType) -> DataFrame:
    """The rows of one commit key, landed and rejected."""
    columns = [field for field in messages_schema(buckets).fields if field.name != "commit_key"]
    return spark.read.schema(T.StructType(columns)).parquet(f"{root}/messages/commit_key={commit_key}")


def read_messages(spark: SparkSession, root: str, buckets: T.StructType = HOUR_BUCKETS) -> DataFrame:
    """Every row on disk, landed and rejected."""
    return read_or_empty(spark, f"{root}/messages", messages_schema(buckets))


def read_landed_commits(spark: SparkSession, root: str, keys: list[str], topic: str, buckets: T.StructType) -> DataFrame:
    """Landed rows of the named commits, whose folders must be there; no other commit's folder is listed."""
    base = f"{root}/messages"
    folders = [f"{base}/commit_key={key}" for key in keys]
    rows = spark.read.schema(messages_schema(buckets)).option("basePath", base).parquet(*folders)
    return rows.where((F.col("outcome") == LANDED) & (F.col("topic") == topic)).drop("outcome", "reject_reason", "chars")


def read_landed(spark: SparkSession, root: str, buckets: T.StructType = HOUR_BUCKETS) -> DataFrame:
    """Every landed row on disk, committed or not. See ``committed_read``."""
    rows = read_messages(spark, root, buckets)
    return rows.where(F.col("outcome") == LANDED).drop("outcome", "reject_reason", "chars")


def read_rejected(spark: SparkSession, root: str, buckets: T.StructType = HOUR_BUCKETS) -> DataFrame:
    """Every rejected row on disk with the reason, committed or not."""
    rows = read_messages(spark, root, buckets)
    return rows.where(F.col("outcome") == REJECTED).drop("outcome", "chars", *buckets.fieldNames())
