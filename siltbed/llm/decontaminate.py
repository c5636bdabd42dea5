"""Benchmark decontamination: test items that documents contain, by size-partitioned MinHash containment search.

Everything is DataFrame functions. Words are runs of letters, marks and digits,
in lower case; shingles are five of them.

Items are partitioned by the power of two of their number q of distinct
shingles. A document contains an item if it has at least need = ceil(0.8 q) of
them. The sketch of an item is its bottom-k MinHash: the q - need + 1 smallest
shingle hashes. A document that has ``need`` shingles lacks at most q - need, so
it has one of the sketch: no containing document is lost. A partition's largest
sketch hash bounds what can match in it, so a document keeps only hashes up to
the bound of the partitions whose smallest need it has shingles for.
Candidates are then verified by the shingles themselves.

Defined cases: null or short texts (under five words) have no shingles, contain
nothing and, as items, are never found; repeated rows give one result; a null
doc_id gives a null doc_id in the result; items with equal texts are each found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import SHINGLE_WORDS, SIMILARITY, id_order, stored
from siltbed.operators.settle import settle
from siltbed.operators.small_side import small_side

WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"


@dataclass(frozen=True)
class ContainmentParameters:
    width: int = SHINGLE_WORDS
    containment: float = SIMILARITY


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK), lambda w: w != "")


def _shingled(frame: DataFrame, width: int, hashed: bool) -> DataFrame:
    """Replace ``text`` by ``shingles``, the distinct ones: hashes, or texts."""
    each = "xxhash64(slice(words, i, {0}))" if hashed else "concat_ws(' ', slice(words, i, {0}))"
    kind = "bigint" if hashed else "string"
    made = f"transform(sequence(1, size(words) - {width - 1}), i -> {each.format(width)})"
    distinct = F.array_distinct(
        F.expr(f"case when size(words) >= {width} then {made} else cast(array() as array<{kind}>) end")
    )
    # Settled, or the words would be split again for every shingle.
    split = settle(frame, words=_words("text")).drop("text")
    return settle(split, shingles=distinct).drop("words")


def _need(q: Column, p: ContainmentParameters) -> Column:
    # In whole thousandths, so that 0.8 x 10 is 8 and not a little more.
    thousandths = round(p.containment * 1000)
    return F.floor((q * thousandths + 999) / 1000).cast("int")


def item_sketches(items: DataFrame, p: ContainmentParameters) -> DataFrame:
    """item_id, q, need, size_class and sketch (smallest hashes) of every item that has shingles."""
    sized = _shingled(items.select("item_id", "text"), p.width, hashed=True).where(F.size("shingles") > 0)
    q = F.size("shingles")
    return sized.withColumn("need", _need(q, p)).select(
        "item_id",
        q.alias("q"),
        "need",
        F.ceil(F.log2(q.cast("double"))).cast("int").alias("size_class"),
        F.slice(F.sort_array("shingles"), F.lit(1), q - F.col("need") + 1).alias("sketch"),
    )


def contained(documents: DataFrame, items: DataFrame, p: ContainmentParameters = ContainmentParameters()) -> DataFrame:
    """id, th, item_id, n_shared, n_shingles, containment of every document that contains an item."""
    keyed = documents.select(id_order().alias("id"), F.xxhash64("text").alias("th"), "text")
    sketches = stored(item_sketches(items, p), "item-sketches")
    partitions = (
        sketches.groupBy("size_class")
        .agg(F.min("need").alias("need"), F.max(F.array_max("sketch")).alias("bound"))
        .orderBy("size_class")
        .collect()  # one row for each power of two
    )
    # The bound of a document: the largest of the partitions it has enough shingles for.
    floor = F.lit(-(1 << 63))
    bound = F.greatest(
        floor, floor, *[F.when(F.size("shingles") >= r["need"], F.lit(r["bound"])).otherwise(floor) for r in partitions]
    )
    sketched = (
        _shingled(keyed, p.width, hashed=True)
        .withColumn("bound", bound)
        .select("id", "th", F.size("shingles").alias("n"), F.explode("shingles").alias("hash"), "bound")
        .where(F.col("hash") <= F.col("bound"))
    )
    wanted = sketches.select("item_id", "need", F.explode("sketch").alias("hash"))
    found = stored(
        sketched.join(small_side(wanted), "hash")
        .where(F.col("n") >= F.col("need"))
        .select("id", "th", "item_id")
        .distinct(),
        "candidates",
    )
    texts = keyed.join(small_side(found.select("id", "th").distinct()), ["id", "th"], "left_semi")
    exact = (
        _shingled(texts.dropDuplicates(["id", "th"]), p.width, hashed=False)
        .join(found, ["id", "th"])
        .join(
            _shingled(items.select("item_id", "text"), p.width, hashed=False).withColumnRenamed("shingles", "of_item"),
            "item_id",
        )
        .select(
            "id",
            "th",
            "item_id",
            F.size(F.array_intersect("of_item", "shingles")).cast("long").alias("n_shared"),
            F.size("of_item").cast("long").alias("n_shingles"),
        )
    )
    return exact.where(F.col("n_shared") >= _need(F.col("n_shingles"), p)).withColumn(
        "containment", F.col("n_shared") / F.col("n_shingles")
    )


def contaminated(documents: DataFrame, items: DataFrame, p: ContainmentParameters = ContainmentParameters()) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment."""
    doc_id = F.when(F.col("id") != (1 << 63) - 1, F.col("id"))
    return contained(documents, items, p).select(
        doc_id.alias("doc_id"), "item_id", "n_shared", "n_shingles", "containment"
    )


def keep_clean(documents: DataFrame, items: DataFrame, p: ContainmentParameters = ContainmentParameters()) -> DataFrame:
    """The documents that contain no item, with their columns."""
    names = documents.columns
    hit = stored(contained(documents, items, p).select("id", "th").distinct(), "hit")
    # The row travels as one column, so that no column of it can clash with these.
    keyed = documents.select(F.struct(*names).alias("row"), id_order().alias("id"), F.xxhash64("text").alias("th"))
    return keyed.join(small_side(hit), ["id", "th"], "left_anti").select("row.*")
