"""The offset ledger: numbered entries, each created once, with segments and a snapshot of the saved positions.

    <root>/ledger/entry-<lane>-<number>.parquet          the ranges of one commit
    <root>/ledger/segment-<lane>-<first>-<last>.parquet  the same rows as those entries
    <root>/ledger_heads/heads-<lane>-<last>.parquet      saved positions after entry <last>

A lane is one writer's sequence, a topic's by default. An entry is written under
a temporary name and renamed to the next number, which fails where that number is
taken: of two writers that both saw entry 7 last, one gets entry 8 and the other
an error that names the commit there. Segments and snapshots only repeat what
entries say, so a crash before either leaves a correct ledger, and readers that
listed entries earlier lose none: entries are kept. A job reads one snapshot and
at most ``SNAPSHOT_EVERY`` entries for its positions, however long it has run.

The rename must fail on an existing name: HDFS does that atomically, a local
file system checks first. An object store needs a committer with such renames.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.offsets import ledger_heads
from siltbed.schema import LEDGER_HEADS_SCHEMA, LEDGER_SCHEMA


class FencedWriterError(RuntimeError):
    """Another writer has committed since this one read its positions."""


def _is_a(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(f".{name}")


class _Folder:
    """Names in a folder of the cluster's file system, and files put there once."""

    def __init__(self, spark: SparkSession, path: str):
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._hadoop, self._gateway, self.path = hadoop, spark.sparkContext._gateway, path
        folder, conf = hadoop.Path(path), spark._jsparkSession.sessionState().newHadoopConf()
        self._folder, self._files = folder, folder.getFileSystem(conf)
        uri = folder.toUri()
        of_scheme = (conf,) if uri.getScheme() is None else (uri, conf)
        self._context = hadoop.FileContext.getFileContext(*of_scheme)

    def names(self) -> list[str]:
        try:
            return sorted(status.getPath().getName() for status in self._files.listStatus(self._folder))
        except Py4JJavaError as error:
            if not _is_a(error, "FileNotFoundException"):
                raise
            return []

    def put(self, rows: DataFrame, name: str) -> bool:
        """Write ``rows`` as one file of that name; False if the name is taken."""
        staging = f"{self.path}/_staging/{uuid.uuid4().hex}"
        # Few rows cross to the task that writes them. A coalesce would fold all tasks of the joins before
        # into that one, with the memory of each added up.
        rows.repartition(1).write.parquet(staging)
        try:
            part = next(s.getPath() for s in self._files.listStatus(self._hadoop.Path(staging)) if s.getPath().getName().startswith("part-"))
            plain = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
            self._context.rename(part, self._hadoop.Path(f"{self.path}/{name}"), plain)
        except Py4JJavaError as error:
            if not _is_a(error, "FileAlreadyExistsException"):
                raise
            return False
        finally:
            self._files.delete(self._hadoop.Path(staging), True)
        return True


def _number(name: str) -> int:
    return int(name.removesuffix(".parquet").rsplit("-", 1)[1])


class OffsetLedger:
    """Committed offset ranges, one numbered entry per commit.

    The saved position of a partition is the largest next_offset of its rows.
    """

    #: Entries of a lane that go into one segment, after which the positions are noted.
    SNAPSHOT_EVERY = 64

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/ledger"
        self._entries = _Folder(spark, self.path)
        self._heads = _Folder(spark, f"{root}/ledger_heads")

    # -- reading -------------------------------------------------------------

    def read(self) -> DataFrame:
        """Every row, from segments and the entries that no segment holds."""
        return self._rows(self._live(self._entries.names()))

    def heads(self, group: str) -> DataFrame:
        """Saved positions of the group, from the last snapshot of each lane and the entries after it."""
        noted = self._last_heads()
        tail = [
            name
            for name in self._live(self._entries.names())
            if name.startswith("part-") or _number(name) > noted.get(self._lane_of(name), ("", 0))[1]
        ]
        rows = self._rows(tail).select(*LEDGER_HEADS_SCHEMA.fieldNames())
        if noted:
            files = [f"{self._heads.path}/{name}" for name, _ in noted.values()]
            rows = rows.unionByName(self.spark.read.schema(LEDGER_HEADS_SCHEMA).parquet(*files))
        return ledger_heads(rows, group)

    def last(self, lane: str) -> int:
        """Number of the lane's last entry, 0 if there is none."""
        prefix = f"entry-{quote(lane, safe='')}-"
        return max((_number(n) for n in self._entries.names() if n.startswith(prefix) and self._lane_of(n) == quote(lane, safe="")), default=0)

    def commits(self, group: str) -> DataFrame:
        """Ranges of the group's batches, without those that only record a start position."""
        return self.read().where((F.col("grp") == group) & (F.col("commit_key") != ""))

    def commit_keys(self, group: str) -> DataFrame:
        """One row per topic and commit of the group."""
        return self.read().where(F.col("grp") == group).select("topic", "commit_key").distinct()

    def has_commit(self, commit_key: str) -> bool:
        return not self.read().where(F.col("commit_key") == commit_key).isEmpty()

    # -- writing -------------------------------------------------------------

    def append(self, ranges: DataFrame, lane: str = "", after: int | None = None) -> None:
        """Add ranges as the next entry of the lane, whole or not at all.

        With ``after``, the entry must come right after that number: if another
        writer has taken it, FencedWriterError. Otherwise the next free number is taken.
        """
        unset = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER_SCHEMA.fields if f.name not in ranges.columns}
        entry, label = ranges.withColumns(unset).select(*LEDGER_SCHEMA.fieldNames()), quote(lane, safe="")
        number = (self.last(lane) if after is None else after) + 1
        while not self._entries.put(entry, f"entry-{label}-{number:020d}.parquet"):
            if after is not None:
                other = self._rows([f"entry-{label}-{number:020d}.parquet"]).select("commit_key").first()
                raise FencedWriterError(f"entry {number} of {lane!r} in {self.path} is commit {other and other['commit_key']!r} of another writer")
            number += 1
        if number % self.SNAPSHOT_EVERY == 0:
            self._snapshot(label, number)

    def commit(self, ranges: DataFrame) -> None:
        """Append ranges, refusing any that starts below its partition's saved position."""
        after = self.last("")
        heads = self.read().groupBy("topic", "grp", "partition").agg(F.max("next_offset").alias("saved_offset"))
        behind = ranges.join(heads, ["topic", "grp", "partition"]).where(F.col("start_offset") < F.col("saved_offset"))
        if not behind.isEmpty():
            raise ValueError("offset range overlaps one already committed; a rewind needs a new output root")
        self.append(ranges, after=after)

    # -- files ---------------------------------------------------------------

    def _snapshot(self, label: str, last: int) -> None:
        first, noted = last - self.SNAPSHOT_EVERY + 1, self._last_heads().get(label)
        rows = self._rows([f"entry-{label}-{n:020d}.parquet" for n in range(first, last + 1)])
        self._entries.put(rows, f"segment-{label}-{first:020d}-{last:020d}.parquet")
        # All entries since the last snapshot, which is more than one segment if a writer died before it.
        since = [f"entry-{label}-{n:020d}.parquet" for n in range((noted[1] if noted else 0) + 1, last + 1)]
        heads = self._rows(since).select(*LEDGER_HEADS_SCHEMA.fieldNames())
        if noted:
            heads = heads.unionByName(self.spark.read.schema(LEDGER_HEADS_SCHEMA).parquet(f"{self._heads.path}/{noted[0]}"))
        heads = heads.groupBy("topic", "grp", "partition").agg(F.max("next_offset").alias("next_offset"))
        self._heads.put(heads, f"heads-{label}-{last:020d}.parquet")

    def _rows(self, names: list[str]) -> DataFrame:
        if names:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(*(f"{self.path}/{name}" for name in names))
        # A literal plan cut to no rows is known to be empty: joins with it are planned away.
        nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in LEDGER_SCHEMA.fields]
        return self.spark.range(1).select(*nulls).limit(0)

    def _last_heads(self) -> dict[str, tuple[str, int]]:
        """File name and number of each lane's last snapshot."""
        return {self._lane_of(name): (name, _number(name)) for name in self._heads.names() if name.startswith("heads-")}

    @staticmethod
    def _lane_of(name: str) -> str:
        kind, _, rest = name.partition("-")
        return rest.rsplit("-", 2 if kind == "segment" else 1)[0]

    def _live(self, names: list[str]) -> list[str]:
        """Files that hold each row once: segments that do not overlap, entries outside them, files of older ledgers."""
        live = [name for name in names if name.startswith("part-")]
        held: dict[str, list[tuple[int, int]]] = {}
        for name in (name for name in names if name.startswith("segment-")):
            first, last = int(name.rsplit("-", 2)[1]), _number(name)
            spans = held.setdefault(self._lane_of(name), [])
            if not spans or first > spans[-1][1]:
                spans.append((first, last))
                live.append(name)
        for name in (name for name in names if name.startswith("entry-")):
            spans, number = held.get(self._lane_of(name), []), _number(name)
            if not any(first <= number <= last for first, last in reversed(spans)):
                live.append(name)
        return live
