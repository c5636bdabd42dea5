"""Vector codes by product quantisation, with the nearest entry found through a GNAT over each codebook.

A vector becomes integers, floor(256 * x), and is cut into equal consecutive
parts. Each part position has a codebook that starts as the parts of the smallest
vec_ids; a round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and moves each entry to the floored mean of
its parts. A round is one scan: tasks search, add up per entry and position, and
Spark adds the tasks' sums, so only a codebook's worth of numbers is collected.

The search (Brin, "Near neighbor search in large metric spaces", 1995): a node of
the tree holds split points, every other entry of it goes to its nearest split
point's child, and for each child and split point the node stores the range of
their distances. A query measures its distance to a split point; where the ball
of its best distance so far lies strictly outside a child's range, by more than
rounding can amount to, the child goes as a whole. What is left is decided by
integer distances, ties included. All queries of a batch descend together: a node
sees those that have not eliminated it.

Defined cases: rows whose vector is null or has null, NaN or infinite components
are dropped. Vectors of unlike lengths, or of one that is no multiple of the
parts, are filled up with zeros to the longest length rounded up to such a
multiple; empty ones are zero vectors. Fewer vectors than entries give codebooks
of as many entries; none give no rows. Null vec_ids come after all others, and
rows of one vec_id are ordered by their vectors; repeated rows all count. Sums
are exact; floor(256 * x) saturates at 2^53 in size, and an error past 64 bits at
the largest long. Only vec_id, the vector and the label are read; a frame may have
any other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import mapped
from siltbed.operators.small_side import small_side

#: Split points of a node, and the most entries that a leaf has.
SPLITS, LEAF = 6, 6

#: Components saturate here: doubles hold every integer up to it.
LARGEST = 1 << 53

#: Up to this size of components squared distances of a part are exact in 64 bits.
SMALL = 1 << 24

_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class CodeParameters:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


@dataclass
class Node:
    """Split points and, for each child, its entries' range of distances to every split point; or a leaf."""

    points: list[int]
    children: list[Node]
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows; both are int64, or objects where those could overflow."""
    return ((a - b) ** 2).sum(axis=-1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def build(book: np.ndarray, entries: list[int] | None = None) -> Node:
    """A GNAT over the rows of ``book``."""
    entries = list(range(len(book))) if entries is None else entries
    if len(entries) <= LEAF:
        return Node(entries, [])
    # Split points far from each other, from the lowest index on.
    points = [entries[0]]
    nearest = squared(book[entries], book[points[0]])
    for _ in range(SPLITS - 1):
        points.append(entries[max(range(len(entries)), key=lambda i: nearest[i])])
        nearest = np.minimum(nearest, squared(book[entries], book[points[-1]]))
    points = list(dict.fromkeys(points))
    rest = [e for e in entries if e not in set(points)]
    if len(points) == 1 or not rest:
        return Node(entries, [])
    to_points = np.stack([squared(book[rest], book[p]) for p in points])
    owner = to_points.argmin(axis=0) if to_points.dtype != object else np.array([min(range(len(points)), key=lambda k: c[k]) for c in to_points.T])
    roots = _roots(to_points)
    groups = [np.flatnonzero(owner == k) for k in range(len(points))]
    groups = [g for g in groups if len(g)]
    return Node(
        points,
        [build(book, [rest[i] for i in g]) for g in groups],
        np.array([roots[:, g].min(axis=1) for g in groups]),
        np.array([roots[:, g].max(axis=1) for g in groups]),
    )


def search(node: Node, book: np.ndarray, queries: np.ndarray, best: np.ndarray, code: np.ndarray, rows: np.ndarray) -> None:
    """Improve ``best`` (squared distance) and ``code`` of the given rows of ``queries`` by the entries under ``node``."""
    mine, found, where = queries[rows], best[rows], code[rows]
    distances = []
    for p in node.points:
        d = squared(mine, book[p])
        better = (d < found) | ((d == found) & (p < where))
        found, where = np.where(better, d, found), np.where(better, p, where)
        distances.append(d)
    best[rows], code[rows] = found, where
    if not node.children:
        return
    roots = np.stack([_roots(d) for d in distances], axis=1)
    for k, child in enumerate(node.children):
        radius = _roots(best[rows])[:, None]
        # A square root is within a few units in the last place; a part in 2^40 is far more than that.
        slack = (roots + radius + node.high[k]) * 2.0**-40
        outside = (roots - radius > node.high[k] + slack) | (roots + radius < node.low[k] - slack)
        left = rows[~outside.any(axis=1)]
        if len(left):
            search(child, book, queries, best, code, left)


def assign(parts: np.ndarray, books: list[np.ndarray], trees: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every vector's parts; ``parts`` is rows x parts x width."""
    n, m, _ = parts.shape
    code, error = np.zeros((n, m), dtype=np.int64), np.zeros((n, m), dtype=parts.dtype)
    for k in range(m):
        queries, book = parts[:, k], books[k]
        # The search starts from the last row's way in: the first entry of the codebook.
        best, at = squared(queries, book[0]), np.zeros(n, dtype=np.int64)
        search(trees[k], book, queries, best, at, np.arange(n))
        code[:, k], error[:, k] = at, best
    return code, error


def integers(column: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), filled up with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(column), width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = np.clip(flat, -LARGEST, LARGEST).astype(np.int64)
    return out


def _cut(vectors: np.ndarray, parts: int, small: bool) -> np.ndarray:
    cut = vectors.reshape(len(vectors), parts, -1)
    return cut if small else cut.astype(object)


def _finite(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _sums(vectors: DataFrame, books: list[np.ndarray], width: int, small: bool, p: CodeParameters) -> DataFrame:
    """(part, entry, count, sums) over all parts assigned to each used entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        n_entries, part_width = len(books[0]), width // p.parts
        count = np.zeros((p.parts, n_entries), dtype=np.int64)
        total = np.zeros((p.parts, n_entries, part_width), dtype=object)
        for batch in batches:
            parts = _cut(integers(batch.column("v"), width, p.scale), p.parts, small)
            code, _ = assign(parts, books, trees)
            for k in range(p.parts):
                count[k] += np.bincount(code[:, k], minlength=n_entries)
                sums = np.zeros((n_entries, part_width), dtype=parts.dtype)
                np.add.at(sums, code[:, k], parts[:, k])
                total[k] += sums
        part, entry = np.nonzero(count)
        for at in range(0, len(part), 1000):
            k, e = part[at : at + 1000], entry[at : at + 1000]
            texts = [[str(x) for x in total[i, j]] for i, j in zip(k, e, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(count[k, e]), pa.array(texts, pa.list_(pa.string()))],
                ["part", "entry", "n", "sums"],
            )

    found = vectors.select("v").transform(mapped, run, "part int, entry int, n bigint, sums array<string>")
    long = found.select("part", "entry", "n", F.posexplode("sums").alias("pos", "s"))
    # Numbers of vectors and sums add up apart, since a row here is a task's sum at one position.
    return long.groupBy("part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )


def codebooks(vectors: DataFrame, p: CodeParameters = CodeParameters()) -> tuple[list[np.ndarray], int, bool]:
    """Final codebooks, the common vector length, and whether 64-bit distances are exact, of (vec_id, v) rows.

    What reaches the driver is a few numbers for each entry: parts x entries x part length.
    """
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    seen = vectors.agg(F.max(F.size("v")).alias("n"), F.max(largest).alias("x")).first()
    width = -(-(seen["n"] or 0) // p.parts) * p.parts
    small = (seen["x"] or 0.0) * p.scale < SMALL and width < 1 << 10
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(p.entries).toArrow()
    if not first.num_rows or not width:
        return [], width, small
    start = _cut(integers(first.column("v").combine_chunks(), width, p.scale), p.parts, small)
    books = [start[:, k].copy() for k in range(p.parts)]
    for _ in range(p.rounds):
        for row in _sums(vectors, books, width, small, p).toLocalIterator():
            books[row["part"]][row["entry"], row["pos"]] = int(row["s"]) // row["n"]
    return books, width, small


def codes(embeddings: DataFrame, p: CodeParameters = CodeParameters()) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept row, and the codebooks: an array of entries for each part."""
    kept = embeddings.where(_finite("embedding")).select("vec_id", "label", F.col("embedding").alias("v"))
    books, width, small = codebooks(kept, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        for batch in batches:
            n = batch.num_rows
            if books:
                code, error = assign(_cut(integers(batch.column("v"), width, p.scale), p.parts, small), books, trees)
                total = [min(int(e), _LONG) for e in error.sum(axis=1)]
            else:
                code, total = np.zeros((n, p.parts), dtype=np.int64), [0] * n
            names = pa.array(["".join(f"{c:02x}" for c in row) for row in code], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), names, pa.array(total, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    types = {name: kept.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    return kept.transform(mapped, run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint"), books


def coded(embeddings: DataFrame, p: CodeParameters = CodeParameters()) -> DataFrame:
    """Codes with the error summed over equal labels and a digest of the codebooks.

    Labels' sums are made before they are joined back, so a label with most rows costs no task more than another.
    """
    rows, books = codes(embeddings, p)
    listed = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    totals = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("t"))
    most = F.least(F.col("t"), F.lit(_LONG).cast("decimal(38,0)")).cast("bigint")
    by_label = small_side(totals.select(F.col("label").alias("of_label"), most.alias("label_error")))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.sha2(F.lit(listed), 256).alias("codebooks_sha256")
    )
