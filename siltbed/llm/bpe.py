"""Byte-level BPE by a rank file: encoding and decoding as the tiktoken library does, without special tokens.

Encoding cuts a text into pre-tokens and looks each up in two tiers. A minimal
perfect hash over the vocabulary gives the one slot in which a pre-token can be;
if that slot's token is the pre-token, its rank is the id. The others are merged:
a heap holds the ranks of adjacent parts of a linked list over the bytes, and the
lowest rank, the leftmost of equal ones, is joined first. A batch looks each
distinct pre-token up once. Decoding puts the bytes of the ids end to end.

The hash (compress, hash and displace): a key's 64-bit hash names its bucket, and
the bucket's displacement sends its keys to slots of their own. It is built once,
on the driver, and broadcast with the tokens: a megabyte or two for 50,000 tokens,
by the vocabulary and never by the data.

Defined cases: null and empty texts have no ids, and null and empty lists of ids
decode to no bytes, as do ids that the vocabulary lacks. Bytes that are no token
of their own are left out of the ids, so a vocabulary needs all 256 for an exact
round trip. Rows are encoded each on its own, so repeated rows, null and repeated
doc_ids and other columns play no part. Texts of any length are encoded whole, a
few thousand pre-tokens at a time.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import mapped, mix, pieces

#: Mean keys of a bucket of the perfect hash, and displacements tried at a time.
BUCKET_KEYS, TRIES = 4, 256

#: Pre-tokens that are cut and looked up at a time.
LOT = 1 << 17

#: Merged pre-tokens of up to so many bytes that a task remembers, and how many before it starts anew.
SHORT, REMEMBERED = 64, 1 << 19

_PLACE = (1 << 40) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PerfectHash:
    """Slot of every key: a displaced hash of its bucket, or the slot itself where ``shift`` is negative."""

    shift: np.ndarray
    size: int

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        """Over distinct 64-bit hashes."""
        n = len(hashes)
        buckets = max(1, -(-n // BUCKET_KEYS))
        shift = np.zeros(buckets, dtype=np.int64)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        taken = np.zeros(n, dtype=bool)
        alone = []
        for b in np.argsort(-np.diff(edges), kind="stable"):
            keys = hashes[order[edges[b] : edges[b + 1]]]
            if len(keys) < 2:
                alone += [b] * len(keys)
                continue
            first = 0
            while True:
                tries = np.arange(first, first + TRIES, dtype=np.uint64)
                slots = np.sort((mix(keys + _STEP * tries[:, None]) % np.uint64(n)).astype(np.int64), axis=1)
                good = ~taken[slots].any(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                if good.any():
                    at = int(good.argmax())
                    shift[b], taken[slots[at]] = first + at, True
                    break
                first += TRIES
        # A bucket of one key takes any slot that is left.
        shift[alone] = -1 - np.flatnonzero(~taken)[: len(alone)]
        return cls(shift, n)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        moved = mix(hashes + _STEP * np.maximum(shift, 0).astype(np.uint64)) % np.uint64(max(1, self.size))
        return np.where(shift < 0, -1 - shift, moved.astype(np.int64))


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by slot of the perfect hash, and their ranks."""

    pattern: str
    tokens: list[bytes]
    ranks: np.ndarray
    hash: PerfectHash
    seed: int

    def shared(self, rows: DataFrame) -> Broadcast:
        """For tasks, which have no such module to load a class of it from: plain values."""
        plain = (self.pattern, self.tokens, self.ranks, self.hash.shift, self.hash.size, self.seed)
        return rows.sparkSession.sparkContext.broadcast(plain)

    @classmethod
    def of_shared(cls, held: Broadcast) -> Vocabulary:
        pattern, tokens, ranks, shift, size, seed = held.value
        return cls(pattern, tokens, ranks, PerfectHash(shift, size), seed)

    @classmethod
    def of(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        tokens, seed = list(ranks), 0
        while len(set(hashes := [xxhash.xxh3_64_intdigest(t, seed) for t in tokens])) < len(tokens):
            seed += 1
        hashes = np.array(hashes, dtype=np.uint64)
        perfect = PerfectHash.of(hashes)
        placed = np.argsort(perfect.slots(hashes))
        return cls(pattern, [tokens[i] for i in placed], np.array([ranks[tokens[i]] for i in placed], np.int32), perfect, seed)

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a file with a token in base 64 and its rank on every line."""
        with open(path, "rb") as lines:
            return cls.of({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}, pattern)


class Encoder:
    """A task's view of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pattern = regex.compile(vocabulary.pattern)
        self.by_slot = pa.array(vocabulary.tokens, pa.binary())
        self.rank_of = dict(zip(vocabulary.tokens, vocabulary.ranks.tolist(), strict=True))
        self.length = {rank: len(token) for token, rank in self.rank_of.items()}
        # Ranks of two bytes, as the heap has them; merging starts with those.
        self.pairs: list[int | None] = [None] * (1 << 16)
        for token, rank in self.rank_of.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank << 40
        self.merged: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself."""
        n, get, length, pairs = len(piece), self.rank_of.get, self.length, self.pairs
        after, before = range(1, n + 2), range(-1, n)
        after, before = (list(after), list(before)) if n < 1 << 12 else (array("q", after), array("q", before))
        # The rank comes first, then the place, so the leftmost of equal ranks is joined first.
        two = zip(piece, piece[1:], strict=False)
        heap = [r | i for i, (a, b) in enumerate(two) if (r := pairs[a << 8 | b]) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & _PLACE
            middle = after[i]
            # An entry is out of date once its left part was joined to another or the pair ends elsewhere.
            if not 0 < middle < n or after[middle] - i != length[entry >> 40]:
                continue
            end = after[i] = after[middle]
            after[middle] = 0
            before[end] = i
            if end < n and (r := get(piece[i : after[end]])) is not None:
                heapq.heappush(heap, r << 40 | i)
            if (j := before[i]) >= 0 and (r := get(piece[j:end])) is not None:
                heapq.heappush(heap, r << 40 | j)
        out, i = [], 0
        while i < n:
            if (r := get(piece[i : after[i]])) is not None:
                out.append(r)
            i = after[i]
        return out

    def merged_ids(self, piece: bytes) -> Sequence[int]:
        found = self.merged.get(piece)
        if found is None:
            found = self.merge(piece)
            if len(piece) <= SHORT:
                if len(self.merged) == REMEMBERED:
                    self.merged.clear()
                found = self.merged[piece] = tuple(found)
        return found

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens end to end, and the number of each one's."""
        coded = pa.array(words, pa.string()).dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        distinct = coded.dictionary.cast(pa.binary())
        listed = distinct.to_pylist()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, self.v.seed) for w in listed), np.uint64, len(listed))
        if self.v.hash.size:
            slot = self.v.hash.slots(hashes)
            known = pc.equal(self.by_slot.take(pa.array(slot)), distinct).to_numpy(zero_copy_only=False)
            flat, count = self.v.ranks[slot], np.ones(len(listed), dtype=np.int64)
        else:
            known, flat, count = np.zeros(len(listed), bool), np.zeros(len(listed), np.int32), np.ones(len(listed), np.int64)
        start = np.arange(len(listed))
        missing = np.flatnonzero(~known)
        merged = [self.merged_ids(listed[k]) for k in missing.tolist()]
        sizes = np.fromiter(map(len, merged), np.int64, len(merged))
        start[missing], count[missing] = len(listed) + np.cumsum(sizes) - sizes, sizes
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(merged), np.int32, sizes.sum())])
        counts = count[which]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[which] - (ends - counts), counts)
        return flat[at], counts

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """Lists of ids, a lot of pre-tokens at a time, whether from many texts or a part of one."""
        found: list[np.ndarray] = []
        sizes = np.zeros(len(texts) + 1, dtype=np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            ids, counts = self.ids(words)
            rows = np.repeat([r for r, _ in owners], [k for _, k in owners])
            np.add.at(sizes, rows + 1, counts)
            found.append(ids)
            words.clear()
            owners.clear()

        for row, text in enumerate(texts):
            if len(text or "") <= LOT:
                lots = [self.pattern.findall(text or "")]
            else:
                matches = self.pattern.finditer(text)
                lots = iter(lambda: [m.group() for m in islice(matches, LOT)], [])
            for lot in lots:
                words += lot
                owners.append((row, len(lot)))
                if len(words) >= LOT:
                    flush()
        if words:
            flush()
        flat = np.concatenate([np.zeros(0, np.int32), *found])
        return pa.LargeListArray.from_arrays(pa.array(np.cumsum(sizes)), pa.array(flat, pa.int32()))


def encode(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and ids, an array of ints, of every row's text."""
    held = vocabulary.shared(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary.of_shared(held))
        for batch in pieces(batches, "text"):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids.cast(pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = documents.select("doc_id", "text")
    return rows.transform(mapped, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids and their bytes of every row of (doc_id, ids)."""
    held = vocabulary.shared(encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.of_shared(held)
        table = [b""] * (int(v.ranks.max(initial=-1)) + 2)
        for token, rank in zip(v.tokens, v.ranks.tolist(), strict=True):
            table[rank] = token
        table = pa.array(table, pa.large_binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                lists = part.column("ids")
                flat = lists.flatten().fill_null(len(table) - 1).to_numpy(zero_copy_only=False)
                flat = np.where((flat < 0) | (flat >= len(table)), len(table) - 1, flat)
                ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
                # The bytes of the tokens taken follow each other in one buffer, so a row's are a stretch of it.
                taken = table.take(pa.array(flat))
                at_token = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(taken) + 1]
                edges = pa.py_buffer(at_token[np.concatenate([[0], ends]).astype(np.int64)])
                out = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, edges, taken.buffers()[2]])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, out.cast(pa.binary())], ["doc_id", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").transform(mapped, run, f"doc_id {kind}, ids array<int>, bytes binary")


def round_trip(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the bytes they decode to."""
    coded = decode(encode(documents, vocabulary), vocabulary)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
