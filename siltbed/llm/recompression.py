"""Long repeats across documents by recompression.

Every document starts as its words. A round gives a name to each short run of
one symbol, then to each pair of a "left" and a "right" symbol, where a hash of
symbol and round decides the side. Names are hashes of what they name, so all
tasks give the same name to the same words without exchanging anything.

Whether a symbol stands at a place depends on some words around it, its context.
A window of ``window`` words picks, of the symbols whose context lies within it,
one of the highest level (then by hash, then the leftmost): equal windows pick
equal symbols at equal places. Neighbouring windows mostly pick the same, so a
document has few picks, each for a range of windows.

1. Picks whose symbol occurs in one document only have no repeated window.
2. Of the others, the hash of all words of the range (the span) is compared: a
   range whose span occurs in a document with a smaller id is a repeat.
3. Ranges with the same symbol but different spans can share some windows. The
   first document of each such span gives the hashes of its windows, and the
   smallest id of every window decides.

No step gathers a symbol's occurrences: each is a minimum, joined back.

Defined cases: null and empty texts have no words; texts under ``window`` words
have no windows; windows of one id (repeated rows too) do not repeat each other;
a null id is larger than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import combine, id_order, mapped, mix, pieces, row_bounds, stored, tokens, utf8_buffer, word_hashes
from siltbed.operators.small_side import small_side


@dataclass(frozen=True)
class RepeatParameters:
    window: int = 50
    rounds: int = 7
    #: No symbol covers more words.
    longest: int = 16


_STEP = 0xC2B2AE3D27D4EB4F
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


class WordHashes:
    """Hashes of runs of words, from sums over all words before a place."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        up = np.full(max(1, n), _STEP, dtype=np.uint64)
        down = np.full(n + 1, _STEP_INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * np.cumprod(up, dtype=np.uint64)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class _Symbols:
    """One level: name, words [start, end), context [left, right) and document of every symbol."""

    def __init__(self, name, start, end, left, right, doc):
        self.all = [name, start, end, left, right, doc]

    def __getattr__(self, key):
        return self.all[("name", "start", "end", "left", "right", "doc").index(key)]


def _merge(s: _Symbols, head: np.ndarray, name: np.ndarray, left: np.ndarray, right: np.ndarray) -> _Symbols:
    """Keep the head of every group of symbols; names and contexts are given for heads."""
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(head)) - 1
    return _Symbols(name[at], s.start[at], s.end[last], left[at], right[at], s.doc[at])


def _neighbours(s: _Symbols, out_of_text: int) -> tuple[np.ndarray, np.ndarray]:
    """Context bounds of the symbols before and after; beyond a document's edge they are out of reach."""
    n = len(s.name)
    same = s.doc[1:] == s.doc[:-1]
    before = np.full(n, -out_of_text)
    before[1:] = np.where(same, s.left[:-1], -out_of_text)
    after = np.full(n, out_of_text)
    after[:-1] = np.where(same, s.right[1:], out_of_text)
    return before, after


def _runs(s: _Symbols, level: int, longest: int, far: int) -> tuple[_Symbols, np.ndarray]:
    n = len(s.name)
    equal = np.zeros(n, dtype=bool)
    equal[1:] = (s.name[1:] == s.name[:-1]) & (s.doc[1:] == s.doc[:-1])
    first = np.flatnonzero(~equal)
    count = np.diff(np.append(first, n))
    words = count * (s.end - s.start)[first]
    run = np.repeat(np.arange(len(first)), count)
    joined = (count > 1) & (words <= longest)
    before, after = _neighbours(s, far)
    # That a symbol stands alone, or where its run ends, depends on what is on both sides.
    left, right, name = np.minimum(s.left, before), np.maximum(s.right, after), s.name.copy()
    heads = first[joined]
    right[heads] = np.maximum(after[heads + count[joined] - 1], s.right[heads + count[joined] - 1])
    name[heads] = combine(s.name[heads] ^ np.uint64(0x5851F42D4C957F2D), count[joined].astype(np.uint64))
    # Symbols of a run that is too long: where it ends is out of a window's sight.
    stuck = ((count > 1) & ~joined)[run]
    left[stuck], right[stuck] = -far, far
    head = ~equal | ~joined[run]
    at = np.flatnonzero(head)
    made = np.zeros(n, dtype=bool)
    made[heads] = True
    return _merge(s, head, name, left, right), made[at]


def _pairs(s: _Symbols, level: int, longest: int, far: int) -> tuple[_Symbols, np.ndarray]:
    n = len(s.name)
    side = (mix(s.name + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(40)) & np.uint64(1)
    joined = np.zeros(n, dtype=bool)
    if n > 1:
        joined[:-1] = (
            (side[:-1] == 0) & (side[1:] == 1) & (s.doc[1:] == s.doc[:-1]) & (s.end[1:] - s.start[:-1] <= longest)
        )
    second = np.zeros(n, dtype=bool)
    second[1:] = joined[:-1]
    before, after = _neighbours(s, far)
    # A left symbol that stays alone depends on what follows it, a right one on what precedes.
    left = np.where((side == 1) & ~second, np.minimum(s.left, before), s.left)
    right = np.where((side == 0) & ~joined, np.maximum(s.right, after), s.right)
    name = s.name.copy()
    at = np.flatnonzero(joined)
    left[at] = np.minimum(s.left[at], s.left[at + 1])
    right[at] = np.maximum(s.right[at], s.right[at + 1])
    name[at] = combine(s.name[at], s.name[at + 1])
    kept = np.flatnonzero(~second)
    return _merge(s, ~second, name, left, right), joined[kept]


def picks(h: np.ndarray, doc: np.ndarray, n_docs: int, p: RepeatParameters) -> tuple[np.ndarray, ...]:
    """name, first and last window (word index) of every pick, in order of windows."""
    n, w = len(h), p.window
    far = 1 << 40
    place = np.arange(n)
    if n < w:
        return h[:0], place[:0], place[:0]
    now = _Symbols(h, place, place + 1, place, place + 1, doc)
    found = [(h, place, place, place + 1, np.zeros(n, dtype=np.int64))]
    for level in range(1, p.rounds + 1):
        for half, rewrite in ((1, _runs), (0, _pairs)):
            now, made = rewrite(now, level, p.longest, far)
            at = np.flatnonzero(made & (now.right - now.left <= w))
            of_level = np.full(len(at), 2 * level - half)
            found.append((now.name[at], now.start[at], now.left[at], now.right[at], of_level))
    name, start, left, right, level = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((level, start))
    name, left, right, level = name[order], left[order], right[order], level[order]

    bounds = row_bounds(doc, n_docs)
    low, high = bounds[:-1], bounds[1:] - w
    of = doc[left]
    a, b = np.maximum(right - w, low[of]), np.minimum(left, high[of])
    ok = np.flatnonzero(b >= a)
    a, b = a[ok], b[ok]
    # Priority: level, hash, leftmost; the lowest bits lead back to the symbol.
    rank = (np.uint64((1 << 26) - 1) - ok.astype(np.uint64)) if len(name) < 1 << 26 else None
    if rank is None:
        raise ValueError("more than 2**26 symbols in one text")
    value = (level[ok].astype(np.uint64) << np.uint64(59)) | (mix(name[ok]) >> np.uint64(37) << np.uint64(26)) | rank
    # Each range of windows is covered by two blocks of a power of two; then blocks pass to their halves.
    size = np.floor(np.log2(b - a + 1)).astype(np.int64)
    top = int(size.max(initial=0))
    block = [np.zeros(n, dtype=np.uint64) for _ in range(top + 1)]
    for k in range(top + 1):
        mine = size == k
        np.maximum.at(block[k], a[mine], value[mine])
        np.maximum.at(block[k], b[mine] - (1 << k) + 1, value[mine])
    for k in range(top, 0, -1):
        half = 1 << (k - 1)
        np.maximum(block[k - 1], block[k], out=block[k - 1])
        np.maximum(block[k - 1][half:], block[k][: n - half], out=block[k - 1][half:])
    best = block[0]
    new = np.ones(n, dtype=bool)
    new[1:] = best[1:] != best[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], n) - 1
    some = best[at] > 0
    at, last = at[some], last[some]
    chosen = ((1 << 26) - 1) - (best[at] & np.uint64((1 << 26) - 1)).astype(np.int64)
    return name[chosen], at, last


def _pack(codec: pa.Codec, text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True)


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


_PICK = "array<struct<name:bigint,span:bigint,lo:int,hi:int>>"


def parsed(documents: DataFrame, p: RepeatParameters) -> DataFrame:
    """id, th, n_words, all_sha256 (of the words joined by spaces), packed words and picks of every row."""
    frame = documents.select(id_order().alias("id"), F.xxhash64("text").alias("th"), "text")
    kind = pa.list_(pa.struct([("name", pa.int64()), ("span", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            buf, offs = utf8_buffer(batch.column("text"))
            first, end, doc, _ = tokens(buf, offs)
            h = word_hashes(buf, first, end)
            bounds = row_bounds(doc, n)
            name, lo, hi = picks(h, doc, n, p)
            span = WordHashes(h).of(lo, hi + p.window)
            of = doc[lo]
            cut = row_bounds(of, n)
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(name.astype(np.int64)),
                    pa.array(span.astype(np.int64)),
                    pa.array((lo - bounds[of]).astype(np.int32)),
                    pa.array((hi - bounds[of]).astype(np.int32)),
                ],
                fields=list(kind.value_type),
            )
            data = buf.tobytes()
            joined = [b" ".join(data[a:b].split()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
            count = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("th"),
                    pa.array(count, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in joined], pa.string()),
                    pa.array([_pack(codec, x) if c >= p.window else None for x, c in zip(joined, count, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), flat).cast(kind),
                ],
                ["id", "th", "n_words", "all_sha256", "packed", "picks"],
            )

    return frame.transform(mapped, run, f"id bigint, th bigint, n_words bigint, all_sha256 string, packed binary, picks {_PICK}"
    )


def _window_hashes(texts: DataFrame, p: RepeatParameters) -> DataFrame:
    """name, window (hash), id, th, lo of every window of the given ranges (id, th, packed, ranges: name, lo, hi)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = np.frombuffer(_unpack(batch.column("packed")[i].as_py()), dtype=np.uint8)
                first, end, _, _ = tokens(text, np.array([0, len(text)]))
                hashes = WordHashes(word_hashes(text, first, end))
                ranges = batch.column("ranges")[i].values
                name, lo, hi = (ranges.field(k).to_numpy() for k in range(3))
                count = hi - lo + 1
                start = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(name, count)),
                        pa.array(hashes.of(start, start + p.window).astype(np.int64)),
                        pa.array(np.full(len(start), batch.column("id")[i].as_py())),
                        pa.array(np.full(len(start), batch.column("th")[i].as_py())),
                        pa.array(start.astype(np.int32)),
                    ],
                    ["name", "window", "id", "th", "lo"],
                )

    return texts.transform(mapped, run, "name bigint, window bigint, id bigint, th bigint, lo int")


def repeated_ranges(texts: DataFrame, p: RepeatParameters) -> DataFrame:
    """id, th, lo, hi: windows lo..hi of the row also start in a document with a smaller id."""
    every = texts.select("id", "th", F.explode("picks").alias("pick")).select("id", "th", "pick.*")
    shared = every.groupBy("name").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("name")
    some = stored(every.join(shared, "name"), "shared-picks")
    spans = stored(some.groupBy("name", "span").agg(F.min("id").alias("first_id")), "spans")
    many = spans.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name", F.lit(True).alias("many"))
    seen = some.join(spans.join(many, "name", "left"), ["name", "span"])
    whole = seen.where(F.col("id") > F.col("first_id"))
    # Every occurrence in the first document: it may hold a span more than once.
    ranges = (
        seen.where((F.col("id") == F.col("first_id")) & F.col("many"))
        .groupBy("id", "th")
        .agg(F.collect_list(F.struct("name", "lo", "hi")).alias("ranges"))
    )
    ranges = stored(ranges, "ranges")
    of_text = _texts_of(texts, ranges).join(ranges, ["id", "th"])
    windows = stored(_window_hashes(of_text, p), "windows")
    least = windows.groupBy("name", "window").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z")
    single = windows.join(least, ["name", "window"]).where(F.col("id") > F.col("a"))
    return whole.select("id", "th", "lo", "hi").unionByName(single.select("id", "th", "lo", F.col("lo").alias("hi")))


def _texts_of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """id, th, packed of the given rows' texts, once each."""
    wanted = small_side(rows.select("id", "th").distinct())
    found = texts.where(F.col("packed").isNotNull()).select("id", "th", "packed").join(wanted, ["id", "th"], "left_semi")
    return found.dropDuplicates(["id", "th"])


def without_repeats(documents: DataFrame, p: RepeatParameters = RepeatParameters()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (null where nothing was removed) of every document."""
    texts = stored(parsed(documents, p), "parsed")
    gone = repeated_ranges(texts, p).groupBy("id", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    gone = stored(gone, "repeats")
    window = p.window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept = [], [], []
            for packed, ranges in zip(batch.column("packed"), batch.column("gone"), strict=True):
                words = _unpack(packed.as_py()).split(b" ")
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                lo, hi = (ranges.values.field(k).to_numpy() for k in (0, 1))
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + window, -1)
                stays = np.cumsum(edge[:-1]) == 0
                text = b" ".join([words[i] for i in np.flatnonzero(stays)])
                removed.append(len(words) - int(stays.sum()))
                digests.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("th"),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["id", "th", "n_removed", "kept_sha256", "kept"],
            )

    changed = _texts_of(texts, gone).join(gone, ["id", "th"]).transform(mapped, cut, "id bigint, th bigint, n_removed bigint, kept_sha256 string, kept string"
    )
    return texts.select("id", "th", "n_words", "all_sha256").join(changed, ["id", "th"], "left").select(
        F.when(F.col("id") != (1 << 63) - 1, F.col("id")).alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
        "kept",
    )
