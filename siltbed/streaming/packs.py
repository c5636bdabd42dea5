"""Packs: committed rows gathered by day, under a numbered manifest.

    <root>/packs/topic=/<first bucket>=/pack=/<further buckets>/   rows of many commits
    <root>/manifest/entry-<topic>-<number>.parquet                 what each compaction put in and took out

A commit's own folder is above the day, which is what makes its replay an
overwrite; a read by day would open a folder of every commit ever made. A
compaction copies the rows of the commits that no pack holds into one new pack
for each day they touch, day first, with adaptive files. A day's smaller
packs are merged into the new one, so the packs of a day and the times that a row
is copied grow with the logarithm of the day's rows.

The new packs, the packs they replace and the commits they hold become visible
together, by one manifest entry that is created if absent. Before it, readers see
the commits' folders; after it, the packs. Readers that listed the manifest
earlier still find all their files: none are deleted. Of two compactions that
start from the same entry the second fails with FencedWriterError.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.small_side import MAX_BROADCAST_ROWS, small_side
from siltbed.schema import MANIFEST_SCHEMA, packs_schema
from siltbed.streaming.ledger import FencedWriterError, _Folder, _number
from siltbed.streaming.tables import read_or_empty

ADD, REMOVE, HOLDS = "add", "remove", "holds"

#: Folders that a read names one by one.
MAX_FOLDERS = 2_000


def day_text(column: str) -> Column:
    """The text of the first bucket; a null one has the empty text, as both have one directory."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class PackManifest:
    """Which packs of a topic count, and which commits they hold, as of the moment this is made."""

    def __init__(self, spark: SparkSession, root: str, topic: str, buckets: T.StructType):
        self.spark, self.topic, self.buckets = spark, topic, buckets
        self.path = f"{root}/packs"
        self._day = buckets.fieldNames()[0]
        self._folder = _Folder(spark, f"{root}/manifest")
        prefix = f"entry-{quote(topic, safe='')}-"
        self._label = prefix
        self._names = [n for n in self._folder.names() if n.startswith(prefix) and n.removeprefix(prefix).removesuffix(".parquet").isdigit()]
        self.last = max(map(_number, self._names), default=0)

    # -- reading -------------------------------------------------------------

    def actions(self) -> DataFrame:
        if self._names:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(*(f"{self._folder.path}/{n}" for n in self._names))
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields]
        return self.spark.range(1).select(*nulls).limit(0)

    def packs(self) -> DataFrame:
        """(day, pack, n_rows) of the packs that count. A pack is added once and removed once at most, so order does not matter."""
        done = self.actions()
        removed = done.where(F.col("action") == REMOVE).select("day", "pack")
        return done.where(F.col("action") == ADD).select("day", "pack", "n_rows").join(removed, ["day", "pack"], "left_anti")

    def held(self) -> DataFrame:
        """(commit_key) of the commits whose rows are in packs."""
        return self.actions().where(F.col("action") == HOLDS).select("commit_key")

    def rows(self, packs: DataFrame, days: list | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
        """The rows of some of the packs, of the given days only if there are any.

        Their folders are opened by name, so that no other is listed. For more than
        ``MAX_FOLDERS`` the table is listed and its directories are pruned by a join.
        """
        schema = packs_schema(self.buckets)
        if days is not None:
            packs = packs.where(F.col("day").isin(["" if d is None else str(d) for d in days]))
        named = packs.select("day", "pack").limit(MAX_FOLDERS + 1).collect()
        if not named:
            return read_or_empty(self.spark, f"{self.path}/none", schema).drop("pack")
        if len(named) <= MAX_FOLDERS:
            folders = [self._folder_of(r["day"], r["pack"]) for r in named]
            return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).drop("pack")
        table = read_or_empty(self.spark, self.path, schema).where(F.col("topic") == self.topic)
        live = small_side(packs.select(F.col("day").alias("_day"), F.col("pack").alias("_pack")), max_rows)
        return table.join(live, (day_text(self._day) == F.col("_day")) & (F.col("pack") == F.col("_pack")), "left_semi").drop("pack")

    def _folder_of(self, day: str, pack: str) -> str:
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        label = escape(day) if day else "__HIVE_DEFAULT_PARTITION__"
        return f"{self.path}/topic={escape(self.topic)}/{self._day}={label}/pack={pack}"

    # -- writing -------------------------------------------------------------

    def compact(
        self, fresh: DataFrame, keys: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, *, commit: bool = True
    ) -> None:
        """Put ``fresh``, the rows of the commits ``keys`` (commit_key), into packs.

        ``fresh`` has the columns of ``read_landed``. ``commit=False`` writes the packs and no
        manifest entry, as a failure in between would; they stay hidden.
        """
        pack, columns = uuid.uuid4().hex, [c for c in packs_schema(self.buckets).fieldNames() if c != "pack"]
        added = fresh.groupBy(day_text(self._day).alias("day")).agg(F.count("*").alias("n_new"))
        # Smallest packs first, as long as each is at most twice what is gathered until then: what
        # remains of a day then at least doubles from pack to pack.
        by_size = Window.partitionBy("day").orderBy("n_rows", "pack")
        gathered = F.col("n_new") + F.coalesce(F.sum("n_rows").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        fits = F.min(F.col("n_rows") <= 2 * gathered).over(by_size)
        removed = self.packs().join(small_side(added, max_rows), "day").withColumn("fits", fits).where("fits").select("day", "pack", "n_rows")
        rows = fresh.select(*columns).unionByName(self.rows(removed, None, max_rows).select(*columns))
        directories = ["topic", self._day, "pack", *self.buckets.fieldNames()[1:]]
        (
            rows.withColumn("pack", F.lit(pack))
            .select(*(c for c in columns if c not in directories), *directories)
            .hint("rebalance", *directories)
            .sortWithinPartitions(*directories, "partition", "offset")
            .write.mode("append")
            .option("compression", "zstd")
            .partitionBy(*directories)
            .parquet(self.path)
        )
        if commit:
            self._enter(pack, added, removed, keys)

    def _enter(self, pack: str, added: DataFrame, removed: DataFrame, keys: DataFrame) -> None:
        sizes = added.withColumnRenamed("n_new", "n_rows").unionByName(removed.select("day", "n_rows"))
        adds = sizes.groupBy("day").agg(F.sum("n_rows").alias("n_rows"))
        none = F.lit(None).cast("string")
        entry = (
            adds.select(F.lit(ADD).alias("action"), "day", F.lit(pack).alias("pack"), none.alias("commit_key"), "n_rows")
            .unionByName(removed.select(F.lit(REMOVE).alias("action"), "day", "pack", none.alias("commit_key"), "n_rows"))
            .unionByName(keys.select(F.lit(HOLDS).alias("action"), "commit_key"), allowMissingColumns=True)
        )
        number = self.last + 1
        if not self._folder.put(entry.select(*MANIFEST_SCHEMA.fieldNames()), f"{self._label}{number:020d}.parquet"):
            raise FencedWriterError(f"entry {number} of the manifest of {self.topic!r} is another compaction's; its packs count, this one's do not")
