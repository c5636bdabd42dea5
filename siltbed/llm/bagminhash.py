"""Near-duplicate documents by BagMinHash over the multiset of five-word shingles.

Signature. A shingle that occurs c times has weight c. Over its weight axis runs
a Poisson process for every signature component; the component keeps the
earliest point that lies below the weight. The axis is cut at 0, 1, 2, 4, 8, ...,
and each section has one process for all components together, whose points draw
a component and a height in the section: points at or above the weight are
thinned out. Points come in order of time, and those later than a document's
horizon cannot be earliest for any component, so most sections need one draw.
Two documents agree in a component with probability equal to their weighted
Jaccard similarity (Ertl, "BagMinHash", 2018, describes the scheme).

Links. Equal multisets are one node. A bucket holds the nodes that share a band.
Its leader is the one with the most rows in all its buckets together, so the
buckets of one group of copies mostly have the same leader, and every node is
compared with the best of its leaders. A bucket whose nodes are then of one class
has no link left that could change the classes. In the others pairs of different
classes are left, and they are met in two steps. First signatures alone are laid
side by side, within tasks: a pair is wanted if enough of its components agree and
no earlier band already holds it, and only the nodes that have a wanted pair go on.
Then their texts are, and one list from shingles to nodes gives a node's exact
similarity with all others of its bucket at once. Classes that a link joins are one
from then on, so a bucket gives fewer links than it has classes.

A bucket's largest class, its major one, is not compared with itself. It is cut into
blocks, as the rest is, and a cell takes two blocks: rest with rest, or rest with
major. So a bucket that a third of all rows share is many tasks of bounded size, and
costs rows times the rows outside its major class.

A pair at 0.8 shares a band with a chance of 1 - 3e-6, and agrees in enough
components with one of 1 - 1e-5.

Classes are the connected components of the links.

Defined cases: null and empty texts have the empty multiset and are copies of
each other; a text of one to four words has one shingle, all its words; a null
id comes after all others; repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import (
    SIMILARITY,
    combine,
    id_order,
    mapped,
    mix,
    pieces,
    row_bounds,
    shingles,
    stored,
    tokens,
    uniform,
    utf8_buffer,
    word_hashes,
)
from siltbed.llm.components import components
from siltbed.operators.small_side import small_side


#: Members of one leader that are compared with one copy of its text, and nodes of a block.
MEMBERS_A_SHARE, BLOCK = 500, 1024

#: Standard deviations by which the agreement of signatures may fall short of the similarity sought.
SHORTFALL = 4.3


@dataclass(frozen=True)
class NearDuplicateParameters:
    bands: int = 24
    rows: int = 4
    similarity: float = SIMILARITY

    @property
    def components(self) -> int:
        return self.bands * self.rows

    @property
    def agreement(self) -> int:
        """Components in which a pair has to agree."""
        m, sim = self.components, self.similarity
        return max(1, math.floor(m * sim - SHORTFALL * math.sqrt(m * sim * (1 - sim))))


def bags(row: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle and count of every distinct shingle of a row, in that order."""
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return row[at], shingle[at], np.diff(np.append(at, len(row)))


def _earliest(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, horizon: np.ndarray, m: int) -> np.ndarray:
    """Identity of the earliest point of every document and component before the horizon; 0 where there is none."""
    first, low, width, which = [np.arange(len(doc))], [np.zeros(len(doc))], [np.ones(len(doc))], [np.zeros(len(doc))]
    section, start = 1, 1
    while (more := np.flatnonzero(count > start)).size:
        for parts, value in ((first, more), (low, start), (width, start), (which, section)):
            parts.append(value if value is more else np.full(len(more), float(value)))
        section, start = section + 1, start * 2
    item = np.concatenate(first).astype(np.int64)
    low, width, which = np.concatenate(low), np.concatenate(width), np.concatenate(which)
    seed = combine(shingle[item], which.astype(np.uint64))
    time = np.zeros(len(item))
    best = np.full(len(horizon) * m, np.inf)
    points = []
    step = 0
    while len(item):
        h = mix(seed + np.uint64((step * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
        time = time - np.log(uniform(h)) / (m * width)
        keep = time < horizon[doc[item]]
        item, low, width, seed, time, h = (x[keep] for x in (item, low, width, seed, time, h))
        height = low + uniform(mix(h ^ np.uint64(0xA0761D6478BD642F))) * width
        under = height < count[item]
        slot = doc[item] * m + (mix(h ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, slot[under], time[under])
        points.append((slot[under], time[under], h[under]))
        step += 1
    out = np.zeros(len(horizon) * m, dtype=np.uint64)
    for slot, time, h in points:
        won = time == best[slot]
        out[slot[won]] = h[won] | np.uint64(1)
    return out.reshape(len(horizon), m)


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m identities of points; all 0 for an empty multiset."""
    out = np.zeros((n, m), dtype=np.uint64)
    weight = np.bincount(doc, count, n)
    horizon = np.where(weight > 0, (np.log(m) + 5.0) / np.maximum(weight, 1), 0.0)
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        place = np.full(n, -1, dtype=np.int64)
        place[todo] = np.arange(len(todo))
        mine = place[doc] >= 0
        got = _earliest(place[doc[mine]], shingle[mine], count[mine], horizon[todo], m)
        out[todo] = got
        todo = todo[(got == 0).any(axis=1)]
        horizon[todo] *= 2
    return out


def _bags_of(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingles and counts of every text."""
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first, end, row, _ = tokens(buf, offs)
    doc, shingle, count = bags(*shingles(row, word_hashes(buf, first, end), len(texts)))
    edges = row_bounds(doc, len(texts))
    return [(shingle[a:b], count[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets given by sorted shingles and counts; 1 for two empty ones."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), max(0, len(b[0]) - 1))
    both = int(np.minimum(a[1], np.where(b[0][at] == a[0], b[1][at], 0)).sum()) if len(a[0]) else 0
    return both / (total - both)


def sketch(documents: DataFrame, p: NearDuplicateParameters) -> DataFrame:
    """id, th, bag, signature and bands of every row.

    ``th`` tells rows of one id apart; ``bag`` is a 128-bit digest of the multiset.
    The signature has a byte of each component.
    """
    m, rows = p.components, p.rows
    frame = documents.select(id_order().alias("id"), F.xxhash64("text").alias("th"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            buf, offs = utf8_buffer(batch.column("text"))
            first, end, row, _ = tokens(buf, offs)
            doc, shingle, count = bags(*shingles(row, word_hashes(buf, first, end), n))
            digest = np.zeros((n, 2), dtype=np.uint64)
            bounds = row_bounds(doc, n)
            for k in (0, 1):
                part = combine(shingle + np.uint64(k), count.astype(np.uint64) + np.uint64(k << 32))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
                digest[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
            sign = signatures(doc, shingle, count, n, m)
            key = np.zeros((n, p.bands), dtype=np.uint64)
            key += np.arange(1, p.bands + 1, dtype=np.uint64)
            for k in range(rows):
                key = combine(key, sign[:, k::rows])
            keys = key.astype(np.int64)
            some = bounds[1:] > bounds[:-1]
            small = (sign >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("th"),
                    pa.array([x.tobytes() for x in digest], pa.binary()),
                    pa.array([x.tobytes() for x in small], pa.binary()),
                    pa.array([k if s else k[:0] for k, s in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                ],
                ["id", "th", "bag", "sign", "bands"],
            )

    return frame.transform(mapped, run, "id bigint, th bigint, bag binary, sign binary, bands array<bigint>")


def packed_texts(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bag, packed), the compressed text of one row of every node (bag, id, th)."""
    rows = documents.select(id_order().alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = rows.join(small_side(nodes.select("bag", "id", "th")), ["id", "th"]).select("bag", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in pieces(batches, "text"):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            packed = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("bag"), pa.array(packed, pa.binary())], ["bag", "packed"])

    # Rows of one id and text are repeats.
    return wanted.transform(mapped, run, "bag binary, packed binary").dropDuplicates(["bag"])


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact similarity of every (leader, member) pair of nodes; ``texts`` is (bag, packed), a row per node."""
    pairs = stored(pairs, "pairs")
    # A leader's text is repeated once for so many members, so that a hot leader's are dealt over several tasks.
    shares = F.ceil(F.count("*") / MEMBERS_A_SHARE).cast("int").alias("shares")
    leading = stored(pairs.groupBy("leader").agg(shares), "leaders")
    of_leader = texts.join(small_side(leading.withColumnRenamed("leader", "bag")), "bag").select(
        F.col("bag").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("packed").alias("leader_text")
    )
    share = F.pmod(F.xxhash64("member"), F.col("shares")).cast("int").alias("share")
    dealt = pairs.join(small_side(leading), "leader").select("leader", "member", share)
    of_member = texts.join(small_side(dealt.withColumnRenamed("member", "bag")), "bag").select(
        "leader", "share", F.col("bag").alias("member"), "packed"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Leaders come in runs; their texts are cut once for each run, members' in lots of about a megabyte.
        for batch in batches:
            sims: list[float] = []
            packed = batch.column("packed")
            sizes = [int.from_bytes(x.as_py()[:8], "little") for x in packed]
            at = 0
            while at < len(sizes):
                end, total = at + 1, sizes[at]
                while end < len(sizes) and total + sizes[end] <= 1 << 20:
                    total, end = total + sizes[end], end + 1
                names = [x.as_py() for x in batch.column("leader").slice(at, end - at)]
                first = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
                heads = _bags_of([_unpack(batch.column("leader_text")[at + k].as_py()) for k in first])
                of = np.repeat(np.arange(len(first)), np.diff([*first, len(names)]))
                mine = _bags_of([_unpack(x.as_py()) for x in packed.slice(at, end - at)])
                sims += [similarity(heads[k], b) for k, b in zip(of, mine, strict=True)]
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("leader"), batch.column("member"), pa.array(sims, pa.float64())],
                ["leader", "member", "sim"],
            )

    return of_member.join(of_leader, ["leader", "share"]).drop("share").transform(mapped, run, "leader binary, member binary, sim double")


def _cells(frame: DataFrame, columns: str, run) -> DataFrame:
    """Run ``run`` on every cell's rows (``cell``, ``side`` and others), a cell at a time, as one table of Arrow."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cell = [], None
        for batch in batches:
            at = batch.column("cell").to_numpy()
            cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(at)], strict=True):
                if b > a and at[a] != cell:
                    if held:
                        yield from run(pa.Table.from_batches(held))
                    held, cell = [], at[a]
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from run(pa.Table.from_batches(held))

    return frame.repartition("cell").sortWithinPartitions("cell").transform(mapped, grouped, columns)


def _dealt(mixed: DataFrame) -> DataFrame:
    """(cell, side, bucket, bag, class) of (bucket, bag, class) rows: each pair of blocks of a bucket that may hold links.

    Blocks come from a count of the bucket's rows, so a cell has about two blocks of rows at most.
    """
    sizes = mixed.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    of_bucket = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "class")).alias("major"), F.sum("n").alias("all")
    ).select(
        "bucket",
        F.col("major.class").alias("major"),
        F.ceil((F.col("all") - F.col("major.n")) / BLOCK).cast("int").alias("minors"),
        F.ceil(F.col("major.n") / BLOCK).cast("int").alias("majors"),
    )
    placed = mixed.join(of_bucket, "bucket")
    hashed = F.xxhash64("bag", "bucket")
    is_major = F.col("class") == F.col("major")
    block = F.when(is_major, F.col("minors") + F.pmod(hashed, F.col("majors"))).otherwise(F.pmod(hashed, F.greatest("minors", F.lit(1))))
    # A cell is a pair of blocks of which the first is not of the major class.
    last = F.col("minors") + F.col("majors") - 1
    first = F.when(is_major, F.sequence(F.lit(0), F.col("minors") - 1)).otherwise(F.sequence(F.lit(0), F.col("block").cast("int")))
    as_second = F.transform(first, lambda i: F.struct(i.alias("x"), F.col("block").cast("int").alias("y")))
    as_first = F.when(is_major, F.array().cast("array<struct<x:int,y:int>>")).otherwise(
        F.transform(F.sequence(F.col("block").cast("int"), last), lambda y: F.struct(F.col("block").cast("int").alias("x"), y.alias("y")))
    )
    cells = placed.withColumn("block", block).select(
        "bucket", "bag", "class", F.explode(F.array_distinct(F.concat(as_first, as_second))).alias("xy"), "block"
    )
    return cells.select(
        F.xxhash64("bucket", "xy.x", "xy.y").alias("cell"), F.col("xy.x").alias("x"), F.col("xy.y").alias("y"), "block", "bag", "class", "bucket"
    )


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a row of a cell is of its first block, of its second, and the code of its class."""
    block, x, y = (table.column(c).to_numpy() for c in ("block", "x", "y"))
    return block == x, block == y, table.column("class").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _wanted(dealt: DataFrame, p: NearDuplicateParameters) -> DataFrame:
    """Rows of the cells that have a pair to compare, by their signatures; ``dealt`` has sign, bands and band as well."""
    least = p.agreement

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        one, two, kind = _sides(table)
        n = len(kind)
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(n, -1)
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64).reshape(n, -1)
        band = table.column("band").to_numpy()
        wanted = np.zeros(n, dtype=bool)
        second = np.flatnonzero(two)
        for i in np.flatnonzero(one):
            others = second[kind[second] != kind[i]]
            agree = (sign[others] == sign[i]).sum(axis=1) >= least
            others = others[agree]
            # The first band that a pair shares has it.
            others = others[~(bands[others, : band[i]] == bands[i, : band[i]]).any(axis=1)]
            wanted[others] = True
            wanted[i] |= len(others) > 0
        if wanted.any():
            kept = table.select(["cell", "x", "y", "block", "bag", "class"]).filter(pa.array(wanted))
            yield from kept.combine_chunks().to_batches()

    columns = "cell bigint, x int, y int, block bigint, bag binary, class binary"
    return _cells(dealt, columns, run)


def _links(wanted: DataFrame, texts: DataFrame, p: NearDuplicateParameters) -> DataFrame:
    """(u, v) links between classes from exact similarities, so many that they join what is similar in a cell."""
    least = p.similarity

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        one, two, kind = _sides(table)
        n = len(kind)
        root = np.arange(n if n else 0)
        classes = kind.astype(np.int64).copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        packed = table.column("packed")
        at = 0
        while at < n:
            end, total = at, 0
            while end < n and (end == at or total < 1 << 20):
                total += int.from_bytes(packed[end].as_py()[:8], "little")
                end += 1
            found += _bags_of([_unpack(packed[k].as_py()) for k in range(at, end)])
            at = end
        weight = np.array([int(c.sum()) for _, c in found])
        owner = np.repeat(root, [len(s) for s, _ in found])
        shingle, count = np.concatenate([s for s, _ in found]), np.concatenate([c for _, c in found])
        order = np.argsort(shingle, kind="stable")
        owner, shingle, count = owner[order], shingle[order], count[order]
        names = table.column("bag")
        u, v = [], []
        for i in np.flatnonzero(one):
            mine, times = found[i]
            low, high = np.searchsorted(shingle, mine, "left"), np.searchsorted(shingle, mine, "right")
            sizes = high - low
            entry = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
            both = np.bincount(owner[entry], np.minimum(count[entry], np.repeat(times, sizes)), n).astype(np.int64)
            either = weight + weight[i] - both
            for j in np.flatnonzero(two & (both / np.maximum(either, 1) >= least) & (classes != classes[i])):
                if classes[j] != classes[i]:
                    classes[classes == classes[j]] = classes[i]
                    u.append(names[i].as_py())
                    v.append(names[j].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])

    return _cells(wanted.join(texts, "bag"), "u binary, v binary", run)


def _roots(links: DataFrame) -> DataFrame:
    return components(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))


def linked_nodes(documents: DataFrame, sketches: DataFrame, p: NearDuplicateParameters) -> tuple[DataFrame, DataFrame]:
    """Nodes (bag, id, th of their first row), and (node, root) of those that resemble another."""
    first = F.min(F.struct("id", "th", "sign", "bands")).alias("f")
    nodes = stored(sketches.groupBy("bag").agg(first).select("bag", "f.*"), "nodes")
    rows = nodes.select("bag", F.posexplode("bands").alias("band", "bucket"))
    many = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    whole = stored(rows.join(many, "bucket"), "buckets")
    # Nodes with the most rows in their buckets rank first.
    rank = whole.groupBy("bag").agg((-F.sum("n")).alias("rank"))
    shared = stored(rank.join(nodes.select("bag", "id", "th"), "bag"), "shared-nodes")
    # Only texts that share a bucket are compared; small sides are measured before they are broadcast.
    texts = stored(packed_texts(documents, shared), "texts")
    ranked = whole.select("bucket", "bag").join(small_side(shared.select("bag", "rank")), "bag")
    low = ranked.groupBy("bucket").agg(F.min(F.struct("rank", F.col("bag").alias("leader"))).alias("first"))
    best = (
        whole.select("bucket", "bag")
        .join(low, "bucket")
        .where(F.col("bag") != F.col("first.leader"))
        .groupBy(F.col("bag").alias("member"))
        .agg(F.min("first").alias("first"))
    )
    alike = compare(best.select("first.leader", "member"), texts).where(F.col("sim") >= p.similarity)
    links = stored(alike.select(F.col("leader").alias("u"), F.col("member").alias("v")), "links")
    root = _roots(links)
    classed = _classed(whole.select("bucket", "band", "bag"), root)
    ends = classed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    mixed = stored(classed.join(ends.select("bucket"), "bucket", "left_semi"), "mixed")
    if mixed.isEmpty():
        return nodes, root
    band = mixed.select("bucket", "band").distinct()
    dealt = _dealt(mixed.select("bucket", "bag", "class")).join(small_side(band), "bucket").drop("bucket")
    wanted = stored(_wanted(dealt.join(small_side(nodes.select("bag", "sign", "bands"), 100_000), "bag"), p), "wanted")
    more = stored(_links(wanted, texts, p), "links")
    return nodes, (root if more.isEmpty() else _roots(links.unionByName(more)))


def _classed(rows: DataFrame, root: DataFrame) -> DataFrame:
    """``rows`` with the class of their node; a node without a link is its own."""
    of = root.select(F.col("node").alias("bag"), F.col("root").alias("class"))
    return rows.join(small_side(of, 100_000), "bag", "left").withColumn("class", F.coalesce("class", "bag"))


def near_duplicates(documents: DataFrame, p: NearDuplicateParameters = NearDuplicateParameters()) -> DataFrame:
    """id, th, class_id and winner (whether the row is its class's first) of every row."""
    sketches = stored(sketch(documents, p), "sketches")
    nodes, root = linked_nodes(documents, sketches, p)
    placed = nodes.select("bag", "id", "th").join(root.withColumnRenamed("node", "bag"), "bag", "left")
    placed = placed.select("bag", "id", "th", F.coalesce("root", "bag").alias("root"))
    first = placed.groupBy("root").agg(F.min(F.struct("id", "th")).alias("first"))
    named = placed.join(first, "root").select("bag", "first")
    return (
        sketches.select("id", "th", "bag")
        .join(named, "bag")
        .select("id", "th", F.col("first.id").alias("class_id"), (F.struct("id", "th") == F.col("first")).alias("winner"))
    )


def _back(column: str):
    return F.when(F.col(column) != (1 << 63) - 1, F.col(column))


def classes(documents: DataFrame, p: NearDuplicateParameters = NearDuplicateParameters()) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its class, of every document."""
    return near_duplicates(documents, p).select(_back("id").alias("doc_id"), _back("class_id").alias("class_id"))


def keep_one(documents: DataFrame, p: NearDuplicateParameters = NearDuplicateParameters()) -> DataFrame:
    """One document of every class, with its columns: the smallest doc_id's."""
    names = documents.columns
    found = stored(near_duplicates(documents, p).where("winner").select("id", "th"), "winners")
    winners = found.groupBy("id", "th").agg(F.count("*").alias("n"))
    # The row travels as one column, so that no column of it can clash with these.
    rows = documents.select(F.struct(*names).alias("row"), id_order().alias("id"), F.xxhash64("text").alias("th"))
    kept = rows.join(small_side(stored(winners, "winners")), ["id", "th"])
    # Repeated rows of a winner are one document.
    once = kept.where("n = 1").unionByName(kept.where("n > 1").dropDuplicates(["id", "th"]))
    return once.select("row.*")
