"""Helpers shared by the text operators: tables, row keys, tokens in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.scratch import scratch_dir

#: Word of the contracts: a run of bytes that are none of space, tab, LF, VT, FF, CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.8

#: Bytes of text that are turned into numpy arrays at a time.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared scratch folder and read it back: a lost executor costs no recomputation."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def mapped(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` in batches of 1,000 rows unless the session asks for another size than Spark's 10,000.

    Texts are long: ten thousand of them, twice over and in two tasks, are a large part of an executor.
    """
    conf = frame.sparkSession.conf
    if conf.get(_BATCH_ROWS) == "10000":
        conf.set(_BATCH_ROWS, "1000")
    return frame.mapInArrow(run, schema)


def id_order(column: str = "doc_id") -> Column:
    """Null ids come after all others."""
    return F.coalesce(F.col(column), F.lit((1 << 63) - 1))


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores after it as keep it apart from the names taken (case does not tell names apart)."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (splitmix64's finisher)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the ordered pair."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b + np.uint64(0x9E3779B97F4A7C15)))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hash to a double in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    up = np.zeros(0, dtype=np.uint64)
    down = np.zeros(0, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return cls.up, cls.down


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and the offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and 64-bit hash of every word. Works in chunks that end between words."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n, a = len(buf), 0
    edges = offs[1:-1]
    while a < n:
        b = min(n, a + CHUNK_BYTES)
        while b < n and not _SPACE[buf[b]]:
            stretch = _SPACE[buf[b : b + CHUNK_BYTES]]
            b += int(stretch.argmax()) if stretch.any() else len(stretch)
        word = ~_SPACE[buf[a:b]]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        cut = edges[(edges > a) & (edges < b)] - a
        first[cut] = word[cut]
        last[cut - 1] = word[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _Powers.upto(b - a)
        prefix = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((buf[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=prefix[1:])
        found.append((s + a, e + a, mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))))
        a = b
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, np.zeros(0, dtype=np.uint64)
    s, e, h = (np.concatenate(x) for x in zip(*found, strict=True))
    return s, e, np.searchsorted(offs, s, side="right") - 1, h


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the words that ``tokens`` found, each made of its bytes as a whole.

    Sums of powers, as in ``tokens``, are equal for some pairs of long words whatever the power; xxh3 is not such a sum.
    """
    data = buf[~_SPACE[buf]]
    edges = np.concatenate([[0], np.cumsum(e - s)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
    distinct = words.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    return hashes[words.indices.to_numpy(zero_copy_only=False)]


def row_bounds(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each row's entries in an array that is sorted by row."""
    return np.searchsorted(row, np.arange(n + 1))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.diff(utf8_buffer(batch.column(column))[1])
        a, total = 0, 0
        for i, size in enumerate(sizes):
            if i > a and total + size > limit:
                yield batch.slice(a, i - a)
                a, total = i, 0
            total += size
        if len(sizes) > a:
            yield batch.slice(a)


def shingles(row: np.ndarray, h: np.ndarray, n: int, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``width`` words; a row with fewer words, but some, has one shingle of them all."""
    bounds = row_bounds(row, n)
    count = np.diff(bounds)
    pad = np.zeros(len(h) + width, dtype=np.uint64)
    pad[: len(h)] = h
    out = np.zeros(len(h), dtype=np.uint64)
    rank = np.arange(len(h)) - bounds[row]
    left = count[row] - rank
    for k in range(width):
        part = combine(out, pad[k : k + len(h)])
        out = np.where(left > k, part, out)
    keep = (left >= width) | (rank == 0)
    return row[keep], out[keep]
