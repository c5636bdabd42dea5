"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs at line ends, and long paragraphs at sentence ends
or after ``longest`` characters. The digest of a piece is 48 bits of hash and 16
bits of its length; the second, third, ... copy of a piece gets another hash, so
that digests are distinct. A sketch adds each digest to one cell in each of three
parts: cells hold a count, the xor of digests and the xor of their checks.

The sketches of two texts subtract cell by cell; common pieces cancel. Peeling
takes a digest out of a cell that holds one alone, again and again, until the
digests of the differing pieces are known, and with them their lengths. If
cells remain, the sketches of both texts are made four times as large and the
peeling starts over, up to a size that has room for all pieces. The likeness is
the length of the common pieces over that of all pieces (1 for two empty texts).

The fingerprint is the smallest sketch with the number and length of pieces; it
depends on the text alone, so equal texts have equal fingerprints.

Defined cases: a null text is empty; a null id comes after all others; rows of
one id follow each other by a hash of their text; the document after the last is
the first (a lone document follows itself).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import id_order, mapped, mix, stored

_LENGTH_BITS = 16
_PARTS = 3


@dataclass(frozen=True)
class FingerprintParameters:
    #: Cells of the smallest sketch, a multiple of three.
    cells: int = 12
    growth: int = 4
    longest: int = 240
    #: Documents in a range of neighbours, the unit of work, unless that makes more ranges than ``most_ranges``;
    #: then ranges are longer. The driver holds one id for each range; a range is streamed, whatever its length.
    range_rows: int = 500
    most_ranges: int = 20_000


def cutter(longest: int) -> re.Pattern:
    """Matches that cover a text without gaps."""
    return re.compile(rf"[^.!?\n]{{1,{longest}}}[.!?\n]*|[.!?\n]+")


def digests(text: str, cut: re.Pattern) -> np.ndarray:
    """64-bit digests of the pieces, all different; the low 16 bits are the piece's length, 65535 at most."""
    found = cut.findall(text)
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(x) for x in found], dtype=np.uint64)
    size = np.minimum(np.array([len(x) for x in found], dtype=np.uint64), np.uint64(0xFFFF))
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = sorted_h[1:] != sorted_h[:-1]
    begin = np.flatnonzero(first)
    copy = np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))
    mixed = mix(sorted_h + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed & ~np.uint64(0xFFFF)) | size[order]


class Sketches:
    """Sketches of several texts side by side: rows of cells."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.keys = np.zeros(n * cells, dtype=np.uint64)
        self.checks = np.zeros(n * cells, dtype=np.uint64)

    def places(self, row: np.ndarray, key: np.ndarray) -> Iterator[np.ndarray]:
        part = self.cells // _PARTS
        for k in range(_PARTS):
            yield row * self.cells + k * part + (mix(key + np.uint64(k + 1)) % np.uint64(part)).astype(np.int64)

    def add(self, row: np.ndarray, key: np.ndarray, sign: np.ndarray | int = 1) -> None:
        check = check_of(key)
        for at in self.places(row, key):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, key)
            np.bitwise_xor.at(self.checks, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, digest and sign of what could be taken out, and which rows were emptied. Destroys the sketches."""
        rows, keys, signs = [], [], []
        at = np.arange(len(self.count))
        while True:
            at = at[(np.abs(self.count[at]) == 1) & (check_of(self.keys[at]) == self.checks[at])]
            if not len(at):
                break
            row, key, sign = at // self.cells, self.keys[at], self.count[at]
            _, once = np.unique(np.stack([row.astype(np.uint64), key]), axis=1, return_index=True)
            row, key, sign = row[once], key[once], sign[once]
            rows.append(row)
            keys.append(key)
            signs.append(sign)
            self.add(row, key, -sign)
            at = np.unique(np.concatenate(list(self.places(row, key))))
        full = (self.count.reshape(self.n, -1) != 0).any(axis=1) | (self.keys.reshape(self.n, -1) != 0).any(axis=1)
        none = np.zeros(0, dtype=np.int64)
        return (
            np.concatenate([none, *rows]),
            np.concatenate([none.astype(np.uint64), *keys]),
            np.concatenate([none, *signs]),
            ~full,
        )

    def packed(self, row: int) -> bytes:
        cells = slice(row * self.cells, (row + 1) * self.cells)
        check = (self.checks[cells] & np.uint64(0xFFFF)).astype("<u2")
        return self.count[cells].astype("<i4").tobytes() + self.keys[cells].astype("<u8").tobytes() + check.tobytes()


def check_of(key: np.ndarray) -> np.ndarray:
    return mix(key ^ np.uint64(0xA0761D6478BD642F))


def _filled(parts: list[np.ndarray], cells: int) -> Sketches:
    out = Sketches(len(parts), cells)
    if parts:
        out.add(np.repeat(np.arange(len(parts)), [len(x) for x in parts]), np.concatenate(parts))
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], p: FingerprintParameters) -> list[tuple[np.ndarray, np.ndarray]]:
    """Digests that only the first, and only the second, of each pair has."""
    out: list = [None] * len(a)
    todo, cells = list(range(len(a))), p.cells
    while todo:
        # The two sketches' difference: cells of the one less those of the other.
        less = Sketches(len(todo), cells)
        for side, sign in ((a, 1), (b, -1)):
            of = [side[i] for i in todo]
            less.add(np.repeat(np.arange(len(of)), [len(x) for x in of]), np.concatenate(of), sign)
        row, key, sign, done = less.peel()
        order = np.argsort(row, kind="stable")
        row, key, sign = row[order], key[order], sign[order]
        edges = np.searchsorted(row, np.arange(len(todo) + 1))
        again = []
        for j, i in enumerate(todo):
            if done[j]:
                k, s = key[edges[j] : edges[j + 1]], sign[edges[j] : edges[j + 1]]
                out[i] = (k[s > 0], k[s < 0])
            elif cells > 8 * (len(a[i]) + len(b[i])) + 64:
                out[i] = (np.setdiff1d(a[i], b[i]), np.setdiff1d(b[i], a[i]))
            else:
                again.append(i)
        todo, cells = again, cells * p.growth
    return out


def _length(key: np.ndarray) -> int:
    return int((key & np.uint64((1 << _LENGTH_BITS) - 1)).sum(dtype=np.uint64))


def likenesses(a: list[np.ndarray], b: list[np.ndarray], p: FingerprintParameters) -> list[float]:
    out = []
    for x, y, (only_x, only_y) in zip(a, b, differences(a, b, p), strict=True):
        total, apart = _length(x) + _length(y), _length(only_x) + _length(only_y)
        common = (total - apart) // 2
        out.append(common / (common + apart) if total else 1.0)
    return out


def fingerprints(parts: list[np.ndarray], p: FingerprintParameters) -> list[str]:
    sketches = _filled(parts, p.cells)
    return [
        f"{len(x)}:{_length(x)}:{base64.b64encode(sketches.packed(i)).decode()}" for i, x in enumerate(parts)
    ]


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as many first characters of the following text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(documents: DataFrame, p: FingerprintParameters) -> DataFrame:
    """Rows (area, id, th, guest, doc_id, text), where the rows of an area in order are neighbours.

    Areas are ranges of ids between quantiles; rows of null id, which come last, are
    dealt by ranges of their texts' hashes. Every area also gets, as a guest, a
    copy of the first document after it, so that neighbours meet in one task.
    """
    keyed = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        id_order().alias("id"),
        F.xxhash64("text").alias("th"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n, n_null = documents.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    many, many_null = (min(p.most_ranges, max(1, -(-rows // p.range_rows))) for rows in (n - n_null, n_null))
    bounds = keyed.agg(F.percentile_approx("doc_id", [k / many for k in range(1, many)] or [0.5], 10_000)).first()[0]
    edges = np.unique(np.array(bounds if many > 1 else [], dtype=np.int64))
    # A hash as a share of all hashes, in their order.
    share = F.col("th").cast("double") / float(1 << 64) + 0.5
    null_area = F.lit(len(edges) + 1) + F.least(F.floor(share * many_null), F.lit(many_null - 1)).cast("int")

    @F.pandas_udf("int")
    def area_of(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right").astype(np.int32))

    placed = keyed.withColumn("area", F.when(F.col("doc_id").isNull(), null_area).otherwise(area_of("id")))
    firsts = placed.groupBy("area").agg(F.min(F.struct("id", "th")).alias("first"))
    starts = sorted((r["area"], r["first"]["id"], r["first"]["th"]) for r in stored(firsts, "areas").collect())
    guests = [(*starts[(k + 1) % len(starts)][1:], area) for k, (area, _, _) in enumerate(starts)]
    if not guests:
        return placed.withColumn("guest", F.lit(False))
    host = documents.sparkSession.createDataFrame(guests, "id bigint, th bigint, host int")
    copies = keyed.join(F.broadcast(host), ["id", "th"]).dropDuplicates(["id", "th"])
    columns = ["area", "guest", "id", "th", "doc_id", "text"]
    return (
        placed.withColumn("guest", F.lit(False))
        .select(*columns)
        .unionByName(copies.withColumn("guest", F.lit(True)).withColumn("area", F.col("host")).select(*columns))
    )


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprinted(documents: DataFrame, p: FingerprintParameters = FingerprintParameters()) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness to that and to the next document."""
    pattern = rf"[^.!?\n]{{1,{p.longest}}}[.!?\n]*|[.!?\n]+"

    def flush(rows: list[tuple], cut: re.Pattern) -> pa.RecordBatch:
        texts = [r[2] for r in rows]
        changed = [edited(x, y) for x, y in zip(texts, texts[1:], strict=False)]
        own = [digests(x, cut) for x in texts]
        new = [digests(x, cut) for x in changed]
        here = own[:-1]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([r[1] for r in rows[:-1]], pa.int64()),
                "n_chars": pa.array([len(x) for x in texts[:-1]], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                "fingerprint": fingerprints(here, p),
                "edited_fingerprint": fingerprints(new, p),
                "near_edited": pa.array(likenesses(here, new, p), pa.float64()),
                "near_next": pa.array(likenesses(here, own[1:], p), pa.float64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = re.compile(pattern)
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(batch.column(c)[i].as_py() for c in ("area", "doc_id", "text"))
                guest = batch.column("guest")[i].as_py()
                held.append(row)
                chars += len(row[2])
                if guest or chars > 1 << 21:
                    if len(held) > 1:
                        yield flush(held, cut)
                    held = [] if guest else held[-1:]
                    chars = sum(len(r[2]) for r in held)

    areas = with_next(documents, p)
    dealt = areas.repartition("area").sortWithinPartitions("area", "guest", "id", "th")
    return dealt.select("area", "guest", "doc_id", "text").transform(mapped, run, _SCHEMA)
