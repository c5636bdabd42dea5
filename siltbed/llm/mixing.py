"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of all words, at most ``limit`` times its own;
what the cap cuts off is shared anew by weight among the others. This has a
closed form: sorted by cap over weight, the capped sources are a prefix, and the
others get one common level times their weight.

Within a source, whole epochs come first. The rest of the target goes to
documents in order of an exponential key, -ln(u) / w, where w is the quality
weight and u comes from a hash of the id, or of the text where the id is null, so
that reruns agree (Efraimidis and Spirakis, 2006: this order is weighted sampling
without replacement). The words
before a document in that order are a prefix sum, taken in two steps: sums of
key ranges per source, then within a range. So a source with a third of all rows
is spread over as many tasks as it has ranges. The document in which the target
falls is taken in part.

Defined cases: a null text has size 0; the null source comes last; a source of
size 0 has target 0; rows of one id have the u of that id, and equal keys follow
each other by size, then by a hash of the text; rows of equal id, text and source
are taken in any order, which gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import WORD_PATTERN, free_name, stored
from siltbed.operators.small_side import small_side

#: Fixed by the contract: weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Characters that prose has few of; their share lowers the quality weight.
NOISE = "!#$%&*|0123456789"
#: What the mix says of a document.
PLAN = ("size", "source_size", "target", "taken")


@dataclass(frozen=True)
class MixingParameters:
    weights: tuple[int, ...] = WEIGHTS
    limit: int = 3
    seed: str = "mix"
    #: Rows that a key range of a source has on average.
    range_rows: int = 4096


def sized(documents: DataFrame, seed: str) -> DataFrame:
    """doc_id, th, source, size, key; ``th`` tells rows of one id apart; the quality weight is between 1/2 and 1."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = F.length(text)
    noise = F.when(chars > 0, (chars - F.length(F.translate(text, NOISE, ""))) / chars).otherwise(F.lit(0.0))
    quality = 1.0 - 0.5 * F.least(F.lit(1.0), 4.0 * noise)
    th = F.xxhash64("text")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), th.cast("string")))
    digest = F.md5(F.concat(name, F.lit(f":{seed}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    size = F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size")
    return documents.select("doc_id", th.alias("th"), "source", size, (-F.ln(u) / quality).alias("key"))


def targets(sizes: DataFrame, p: MixingParameters) -> DataFrame:
    """source, source_size, n, target; one row per source, so its windows are over a small table."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level", F.col("source").isNull(), "source")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(p.weights))).cast("int")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, p.weights)), place + 1).cast("double"))
    cap = F.lit(p.limit) * F.col("source_size")
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    levels = weighed.withColumn("level", cap / F.col("weight")).withColumn("common", rest / F.sum("weight").over(after))
    free = F.col("level") > F.col("common")
    share = F.col("weight") * F.max(F.when(free, F.col("common"))).over(everything)
    return levels.withColumn("share", share).select(
        "source", "source_size", "n", F.when(free, F.round("share", 6)).otherwise(cap.cast("double")).alias("target")
    )


def planned(documents: DataFrame, p: MixingParameters) -> DataFrame:
    """doc_id, th, source, size, source_size, target, taken of every document, and whether it is repeated.

    Repeated are rows of equal id, text and source.
    """
    rows = stored(sized(documents, p.seed), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = stored(targets(sizes, p), "targets").withColumnRenamed("source", "goal_source")
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goal = goal.withColumn("left", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    placed = rows.join(small_side(goal), F.col("source").eqNullSafe(F.col("goal_source"))).withColumn(
        "range", F.floor((1.0 - F.exp(-F.col("key"))) * F.ceil(F.col("n") / p.range_rows))
    )
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of_source"), F.col("range").alias("of_range"), F.coalesce(F.sum("words").over(along), F.lit(0)).alias("offset")
    )
    # Equal rows are neighbours in this order.
    by_key = Window.partitionBy("source", "range").orderBy("key", "size", "th", "doc_id")
    inside = by_key.rowsBetween(Window.unboundedPreceding, -1)
    row = F.struct("doc_id", "th")
    repeated = row.eqNullSafe(F.lag(row).over(by_key)) | row.eqNullSafe(F.lead(row).over(by_key))
    ordered = placed.withColumns({"earlier": F.coalesce(F.sum("size").over(inside), F.lit(0)), "repeated": repeated}).join(
        offsets, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range"))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("offset") - F.col("earlier")))
    taken = (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    return ordered.select("doc_id", "th", "source", "size", "source_size", "target", taken, "repeated")


def mixed(documents: DataFrame, p: MixingParameters = MixingParameters()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return planned(documents, p).select("doc_id", *PLAN)


def _same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_th")) & F.col("source").eqNullSafe(F.col("_source"))


def mix_sources(documents: DataFrame, p: MixingParameters = MixingParameters()) -> DataFrame:
    """The documents that the mix takes words of, with their columns and size, source_size, target, taken.

    Of these four one that the documents have already gets underscores after its name. Every row has its own mix, whatever ids repeat; of repeated rows as many are kept as the mix takes words of.
    """
    names = documents.columns
    # The row travels as one column, so that no column of it can clash with the plan's.
    documents = documents.select("doc_id", "text", "source", F.struct(*names).alias("row"))
    return _mixed_rows(documents, p).select(
        *(F.col("row").getField(name).alias(name) for name in names), *(F.col(c).alias(free_name(names, c)) for c in PLAN)
    )


def _mixed_rows(documents: DataFrame, p: MixingParameters) -> DataFrame:
    """doc_id, text, source, row and the plan's columns of the documents taken."""
    plan = stored(planned(documents, p).where(F.col("taken") > 0), "taken").withColumnsRenamed(
        {"doc_id": "_id", "th": "_th", "source": "_source"}
    )
    kept = documents
    once = kept.join(small_side(plan.where(~F.col("repeated"))), _same_row()).select(*kept.columns, *PLAN)
    plan = plan.where("repeated")
    if plan.isEmpty():
        return once
    # Copies are numbered on both sides and paired by number. Only narrow rows are numbered; the row names are stored
    # with the rows, so that they stay the same.
    key = ["_id", "_th", "_source"]
    copies = stored(
        kept.join(small_side(plan.select(*key).distinct()), _same_row()).withColumn("_row", F.monotonically_increasing_id()), "copies"
    )
    numbered = copies.select(*key, "_row").withColumn("_number", F.row_number().over(Window.partitionBy(*key).orderBy("_row")))
    takes = plan.select(*(F.col(c).alias(f"of{c}") for c in key), *PLAN).withColumn(
        "of_number", F.row_number().over(Window.partitionBy(*(f"of{c}" for c in key)).orderBy(F.desc("taken")))
    )
    pair = [F.col(c).eqNullSafe(F.col(f"of{c}")) for c in (*key, "_number")]
    chosen = stored(numbered.join(takes, pair).select("_row", *PLAN), "chosen")
    return once.unionByName(copies.join(small_side(chosen), "_row").select(*kept.columns, *PLAN))
