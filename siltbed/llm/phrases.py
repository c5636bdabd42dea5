"""Collocations: phrases of two to five words that score high, counted in suffix trees that are built apart (ERA).

The counts come from suffixes: at every word of a piece starts one, cut off after
the longest phrase wanted. A trie of them has the phrases as its nodes, and a
node's count is the sum of the leaves below it. After the ERA method (Mansour and
others, 2011) the trie is cut vertically, so that each part fits a budget:

1. Words are counted, then pairs of neighbours by their hashes. What is rarer than
   the least count can be in no phrase sought, so a suffix ends before such a word
   or within such a pair. The others are known to tasks by Bloom filters of bounded
   size: what a filter, or a hash shared by two pairs, lets through by mistake only
   makes suffixes longer.
2. A prefix whose suffixes exceed the budget of a group is extended by a word, and
   the longer prefixes are counted, until all are within it or as long as a
   phrase. Prefixes within the budget are dealt to groups. So a word, or a whole
   passage, that a third of all texts repeat is spread over groups.
3. Tasks add up equal suffixes and send them to their groups, where they arrive in
   order. That is the depth-first order of the group's subtree: the words that two
   neighbours share are the path that stays open, and a node is closed, with the
   total of its leaves, when a leaf without it comes. A group takes no memory but
   its open path. Nodes above a group's prefix are split over groups, and their
   parts are added.

Every scan covers all rows and whole texts, and every count is exact.

Defined cases: A to Z are lower-cased, no other letters. Null and empty texts have
no words; a null lang is ``und``, together with rows of that lang. Repeated rows
count each. No rows, or no phrase that is frequent enough, give no rows. Only
text and lang are read; a frame may have any other columns. Texts of any length
are read whole, a megabyte of their bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltbed.llm.common import combine, mapped, pieces, stored, utf8_buffer

UNDETERMINED = "und"

#: Byte tables of the contract: ends of pieces, and what lies between words.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAP = _ENDS.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes whose masks are held at a time, and words whose suffixes are added up at a time.
CHUNK_BYTES, LOT = 1 << 20, 1 << 18

#: Between the words of a key. Words' own bytes 0 and 1 are written as 1 2 and 1 3, so that it sorts below all others.
_BREAK = "\x00"

#: Salts of a language in its first cut to the phrases reported.
SALTS = 64


@dataclass(frozen=True)
class PhraseParameters:
    longest: int = 5
    least: int = 100
    within_percent: int = 100
    first: int = 2000
    #: Suffixes of a group: a share of all, between these bounds, and so many that heavy prefixes stay few.
    share: int = 256
    budget: tuple[int, int] = (1 << 16, 1 << 24)
    most_heavy: int = 1 << 18
    #: Bits of the filter for each frequent word, and at most.
    bits: int = 16
    most_bits: int = 1 << 29


@dataclass
class Plan:
    """What every task knows: filters of frequent words and pairs, and sorted hashes of the heavy prefixes of each length."""

    words: np.ndarray
    pairs: np.ndarray | None
    heavy: list[np.ndarray]
    groups: int

    def shared(self, documents: DataFrame) -> Broadcast:
        """For tasks, which have no such module to load a class of it from: plain arrays."""
        return documents.sparkSession.sparkContext.broadcast((self.words, self.pairs, list(self.heavy), self.groups))


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Lower-cased words, and row and piece of each."""
    n, a, ends = len(buf), 0, 0
    starts_of_rows = offs[1:-1]
    found: list[tuple[np.ndarray, ...]] = []
    while a < n:
        b = min(n, a + CHUNK_BYTES)
        while b < n and not _GAP[buf[b]]:
            stretch = _GAP[buf[b : b + CHUNK_BYTES]]
            b += int(stretch.argmax()) if stretch.any() else len(stretch)
        chunk = buf[a:b]
        word = ~_GAP[chunk]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        cut = starts_of_rows[(starts_of_rows > a) & (starts_of_rows < b)] - a
        first[cut] = word[cut]
        last[cut - 1] = word[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        piece = np.cumsum(_ENDS[chunk], dtype=np.int32)
        found.append((s + a, e - s, piece[s].astype(np.int64) + ends, _LOWER[chunk[word]]))
        ends += int(piece[-1])
        a = b
    if not found:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, length, piece, data = (np.concatenate(x) for x in zip(*found, strict=True))
    edges = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(s), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    row = np.searchsorted(offs, s, side="right") - 1
    # Pieces end with their row.
    return words, row, piece + row


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """Per language its words: the distinct ones, and code and piece of each occurrence."""
    langs = batch.column("lang").fill_null(UNDETERMINED).dictionary_encode()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        mine = batch.column("text").filter(pc.equal(langs.indices, k))
        words, _, piece = _words(*utf8_buffer(mine))
        coded = words.dictionary_encode()
        yield lang, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), piece


def word_counts(documents: DataFrame) -> DataFrame:
    """(lang, word, n) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            for lang, distinct, code, _ in _by_lang(batch):
                n = np.bincount(code, minlength=len(distinct))
                columns = [pa.array([lang] * len(n), pa.string()), distinct.cast(pa.string()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    rows = documents.select("text", "lang").transform(mapped, run, "lang string, word string, n bigint")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hashes(lang: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _bits(hashes: np.ndarray, n: int) -> Iterator[np.ndarray]:
    for k in range(3):
        yield (combine(hashes, np.full(1, k, np.uint64)) % np.uint64(n)).astype(np.int64)


def _filter(hashes: DataFrame, p: PhraseParameters) -> np.ndarray:
    """Bits of a Bloom filter of the frame's only column, packed, and their number; tasks make it up in parts."""
    n = min(p.most_bits, max(1 << 10, hashes.count() * p.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(_bits(batch.column(0).to_numpy().view(np.uint64), n)))
            yield pa.RecordBatch.from_arrays([pa.array(at // 64), pa.array(np.left_shift(1, at % 64))], ["at", "word"])

    parts = hashes.transform(mapped, run, "at bigint, word bigint")
    out = np.zeros(-(-n // 64), dtype=np.int64)
    # At most one row for each word of the filter, which has a bounded size.
    for batch in parts.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow().to_batches():
        out[batch.column("at").to_numpy()] = batch.column("word").to_numpy()
    return np.concatenate([out, np.array([n])])


def _hashed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                hashes = _hashes(lang, batch.column("word").filter(pc.equal(langs.indices, k)).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["h"])

    return words.select("lang", "word").transform(mapped, run, "h bigint")


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    n, out = int(bits[-1]), np.ones(len(hashes), dtype=bool)
    for at in _bits(hashes, n):
        out &= (bits[at // 64] >> (at % 64)) & 1 == 1
    return out


@dataclass
class Suffixes:
    """Distinct suffixes of a lot: codes of their words (-1 after the end), numbers, and hashes of their prefixes."""

    lang: str
    words: pa.Array
    code: np.ndarray
    n: np.ndarray
    prefix: np.ndarray

    @property
    def length(self) -> np.ndarray:
        return (self.code >= 0).sum(axis=1)


def _suffixes(batches: Iterator[pa.RecordBatch], plan: Plan, longest: int) -> Iterator[Suffixes]:
    """Suffixes of frequent words only, of two words or more, added up within lots."""
    for batch in pieces(batches, "text"):
        for lang, distinct, code, piece in _by_lang(batch):
            if not len(code):
                continue
            hashes = _hashes(lang, distinct.to_pylist())
            fine = _has(plan.words, hashes)
            of_lang = np.full(1, xxhash.xxh3_64_intdigest(lang), np.uint64)
            first_words = combine(of_lang, hashes)
            for a in range(0, len(code), LOT):
                b = min(len(code), a + LOT)
                # Words of the lot, with those that its last suffixes reach into.
                c, at = code[a : b + longest - 1], piece[a : b + longest - 1]
                ok = fine[c]
                joined = ok[1:] & ok[:-1] & (at[1:] == at[:-1])
                if plan.pairs is not None:
                    some = np.flatnonzero(joined)
                    joined[some] = _has(plan.pairs, combine(first_words[c[some]], hashes[c[some + 1]]))
                n = b - a
                columns, goes_on = np.full((n, longest), -1, dtype=np.int64), np.ones(n, dtype=bool)
                for k in range(longest):
                    have = max(0, min(n, len(c) - k))
                    goes_on[have:] = False
                    goes_on[:have] &= joined[k - 1 : k - 1 + have] if k else ok[:have]
                    live = np.flatnonzero(goes_on)
                    columns[live, k] = c[live + k]
                columns = columns[columns[:, 1] >= 0]
                if not len(columns):
                    continue
                # Words of a lot are fewer than 2^20, so three codes fit a 64-bit number.
                used, small = np.unique(columns, return_inverse=True)
                small = small.reshape(columns.shape).astype(np.int64)
                high = np.zeros(len(columns), dtype=np.int64)
                low = np.zeros(len(columns), dtype=np.int64)
                for k in range(longest):
                    part = low if k >= 3 else high
                    part *= 1 << 21
                    part += small[:, k]
                order = np.lexsort((low, high))
                high, low = high[order], low[order]
                first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
                columns = columns[order[first]]
                prefix = np.zeros((len(columns), longest), dtype=np.uint64)
                so_far = np.repeat(of_lang, len(columns))
                for k in range(longest):
                    some = columns[:, k] >= 0
                    so_far = np.where(some, combine(so_far, hashes[columns[:, k]]), so_far)
                    prefix[:, k] = so_far
                yield Suffixes(lang, distinct, columns, np.diff(np.append(first, len(order))), prefix)


def _is_heavy(plan: Plan, s: Suffixes, length: int) -> np.ndarray:
    known = plan.heavy[length - 1]
    if not len(known):
        return np.zeros(len(s.n), dtype=bool)
    mine = s.prefix[:, length - 1]
    return known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine


def _pair_counts(documents: DataFrame, held: Broadcast) -> DataFrame:
    """(prefix, n) of the hashes of neighbouring frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _suffixes(batches, Plan(*held.value), 2):
            columns = [pa.array(s.prefix[:, 1].view(np.int64)), pa.array(s.n)]
            yield pa.RecordBatch.from_arrays(columns, ["prefix", "n"])

    found = documents.select("text", "lang").transform(mapped, run, "prefix bigint, n bigint")
    return found.groupBy("prefix").agg(F.sum("n").alias("n"))


def _heavier(documents: DataFrame, held: Broadcast, length: int, budget: int, p: PhraseParameters) -> np.ndarray:
    """Hashes of the prefixes of ``length`` words that extend heavy ones and have more suffixes than the budget."""
    longest = p.longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(*held.value)
        for s in _suffixes(batches, plan, longest):
            mine = _is_heavy(plan, s, length - 1) & (s.code[:, length - 1] >= 0)
            keys, which = np.unique(s.prefix[mine, length - 1], return_inverse=True)
            n = np.bincount(which, s.n[mine], len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["prefix", "n"])

    found = documents.select("text", "lang").transform(mapped, run, "prefix bigint, n bigint")
    return _over(found.groupBy("prefix").agg(F.sum("n").alias("n")), budget)


def _over(prefixes: DataFrame, budget: int) -> np.ndarray:
    """Sorted hashes of the prefixes with more suffixes than the budget: no more than all words over the budget."""
    heavy = prefixes.where(F.col("n") > budget).select("prefix")
    return np.sort(heavy.toArrow().column("prefix").to_numpy().astype(np.int64).view(np.uint64))


def _escaped(words: pa.Array) -> pa.Array:
    data = words.buffers()[2]
    if data is None or not (np.frombuffer(data, np.uint8) < 2).any():
        return words
    return pc.replace_substring(pc.replace_substring(words, "\x01", "\x01\x03"), "\x00", "\x01\x02")


def _leaves(documents: DataFrame, held: Broadcast, p: PhraseParameters) -> DataFrame:
    """(grp, whole, lang, phrase, n): suffixes, their groups, and the depth from which the group has all of a node."""
    longest = p.longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(*held.value)
        for s in _suffixes(batches, plan, longest):
            length = s.length
            whole = np.ones(len(s.n), dtype=np.int64)
            for k in range(1, longest + 1):
                whole += (whole == k) & (length >= k) & _is_heavy(plan, s, k)
            key = s.prefix[np.arange(len(s.n)), np.minimum(whole, length) - 1]
            words = _escaped(s.words)
            parts = [words.take(pa.array(c, mask=c < 0)) for c in s.code.T]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(_BREAK, words.type), null_handling="skip")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((key % np.uint64(plan.groups)).astype(np.int64)),
                    pa.array(whole.astype(np.int32)),
                    pa.array([s.lang] * len(s.n), pa.string()),
                    phrase.cast(pa.string()),
                    pa.array(s.n),
                ],
                ["grp", "whole", "lang", "phrase", "n"],
            )

    return documents.select("text", "lang").transform(
        mapped, run, "grp bigint, whole int, lang string, phrase string, n bigint"
    )


def _nodes(leaves: DataFrame, p: PhraseParameters) -> DataFrame:
    """(lang, phrase, n) of the nodes of every group's subtree from leaves in order; rare ones only where split."""
    longest, least = p.longest, p.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The open path: for each depth the node's group, language, phrase, number and whether the group has all of it.
        path: list[tuple | None] = [None] * (longest + 1)

        def rows(closed: list[tuple]) -> pa.RecordBatch:
            told = [x for x in closed if x[3] >= least or not x[4]]
            columns = [pa.array([x[i] for x in told], t) for i, t in ((1, pa.string()), (2, pa.string()), (3, pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            group, whole, n = (batch.column(c).to_numpy() for c in ("grp", "whole", "n"))
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy()
            buf, offs = utf8_buffer(batch.column("phrase"))
            ends = np.concatenate([np.flatnonzero(buf == 0), offs[1:]])
            row = np.concatenate([np.searchsorted(offs, np.flatnonzero(buf == 0), side="right") - 1, np.arange(m)])
            order = np.lexsort((ends, row))
            ends, row = ends[order], row[order]
            depth = np.arange(len(row)) - np.searchsorted(row, row) + 1
            data = buf.tobytes()
            names = langs.dictionary.to_pylist()
            closed: list[tuple] = []
            for k in range(2, longest + 1):
                at = np.flatnonzero(depth == k)
                r, e = row[at], ends[at]
                if not len(r):
                    continue
                # Prefixes of k words end to end, so that neighbours are compared as whole strings.
                size = e - offs[r]
                edges = np.concatenate([[0], np.cumsum(size)])
                take = np.arange(edges[-1]) + np.repeat(offs[r] - edges[:-1], size)
                prefix = pa.Array.from_buffers(
                    pa.large_binary(), len(r), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(buf[take])]
                )
                same = pc.equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
                same &= (group[r[1:]] == group[r[:-1]]) & (lang[r[1:]] == lang[r[:-1]])
                first = np.concatenate([[0], np.flatnonzero(~same) + 1])
                total = np.add.reduceat(n[r], first)
                split = np.maximum.reduceat(whole[r], first) > k
                # Only nodes that can be told are spelled out, and the first and last, which may go on in other batches.
                tell = (total >= least) | split
                tell[[0, -1]] = True
                for i in np.flatnonzero(tell):
                    j = first[i]
                    name = data[offs[r[j]] : e[j]].decode()
                    node = (int(group[r[j]]), names[lang[r[j]]], name, int(total[i]), not split[i])
                    before = path[k]
                    if i == 0 and before is not None:
                        if before[:3] == node[:3]:
                            node = (*node[:3], node[3] + before[3], node[4] and before[4])
                        else:
                            closed.append(before)
                    path[k] = node
                    if i < len(first) - 1:
                        closed.append(node)
            yield rows(closed)
        yield rows([x for x in path if x is not None])

    return leaves.transform(mapped, run, "lang string, phrase string, n bigint")


def phrase_counts(documents: DataFrame, p: PhraseParameters = PhraseParameters()) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of every phrase of one to ``longest`` words with n >= ``least``, and (lang, n) of all words."""
    words = stored(word_counts(documents), "words")
    frequent = words.where(F.col("n") >= p.least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    n_words = words.agg(F.sum("n")).first()[0] or 0
    low, high = p.budget
    budget = max(min(high, max(low, n_words // p.share)), n_words // p.most_heavy)
    plan = Plan(_filter(_hashed(frequent), p), None, [np.zeros(0, np.uint64)] * p.longest, max(1, 2 * n_words // budget))
    # Words over the budget are few: no more than all words over the budget.
    heavy = frequent.where(F.col("n") > budget).select("lang", "word").toArrow().to_pylist()
    first = [combine(np.array([xxhash.xxh3_64_intdigest(w["lang"])], np.uint64), _hashes(w["lang"], [w["word"]])) for w in heavy]
    plan.heavy[0] = np.sort(np.concatenate([np.zeros(0, np.uint64), *first]))
    pairs = stored(_pair_counts(documents, plan.shared(documents)).where(F.col("n") >= p.least), "pairs")
    plan.pairs, plan.heavy[1] = _filter(pairs.select("prefix"), p), _over(pairs, budget)
    for length in range(3, p.longest + 1):
        if not len(plan.heavy[length - 2]):
            break
        plan.heavy[length - 1] = _heavier(documents, plan.shared(documents), length, budget, p)
    # As many partitions as the input asks for, by a fixed number of suffixes each up to a large number of partitions.
    n_parts = max(1, min(plan.groups, -(-n_words // max(1 << 21, n_words // 50_000))))
    leaves = _leaves(documents, plan.shared(documents), p).repartition(n_parts, "grp")
    summed = leaves.groupBy("grp", "lang", "phrase").agg(F.max("whole").alias("whole"), F.sum("n").alias("n"))
    ordered = summed.sortWithinPartitions("grp", "lang", "phrase")
    nodes = _nodes(ordered, p).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least)
    spelled = F.replace(F.replace(F.replace("phrase", F.lit("\x00"), F.lit(" ")), F.lit("\x01\x02"), F.lit("\x00")), F.lit("\x01\x03"), F.lit("\x01"))
    longer = nodes.select("lang", spelled.alias("phrase"), "n")
    counts = longer.unionByName(frequent.select("lang", F.col("word").alias("phrase"), "n"))
    return stored(counts, "phrases"), stored(totals, "totals")


def collocations(documents: DataFrame, p: PhraseParameters = PhraseParameters()) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n, score.

    Scores are whole numbers computed in decimals of 38 digits.
    """
    counts, totals = phrase_counts(documents, p)
    split = counts.withColumn("w", F.split("phrase", " "))
    candidates = split.where(F.size("w") >= 2).withColumnRenamed("n", "a")
    # A candidate goes if it lies in a longer one that is as frequent.
    spans = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))"
    )
    inside = (
        candidates.where(F.size("w") > 2)
        .select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = (
        candidates.join(inside, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < p.within_percent * F.col("a")))
        .select("lang", "phrase", "w", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
        .withColumns({"left": F.expr("array_join(slice(w, 1, k), ' ')"), "right": F.expr("array_join(slice(w, k + 1, size(w)), ' ')")})
    )
    exact = "cast({} as decimal({}, 0))"
    score = F.expr(f"({exact.format('1000', 4)} * {exact.format('a', 16)} * {exact.format('n', 16)}) div ({exact.format('l', 16)} * {exact.format('r', 16)})")
    scored = (
        kept.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
        .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
        .join(F.broadcast(totals) if totals.limit(10_001).count() <= 10_000 else totals, "lang")
        .withColumn("score", score)
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A salt first, so that no task sorts a language's phrases but the first of each salt.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    few = best.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= p.first).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= p.first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
