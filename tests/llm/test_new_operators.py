"""Byte-level BPE, collocations and vector codes against brute force, hard cases included."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from siltbed.llm import bpe, codes, phrases
from siltbed.llm.queries import QUERIES
from tests.conftest import DATA

DOCUMENTS = "doc_id bigint, text string, lang string, ids string, bytes int, n_tokens int, word string, n int"


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def exact(vocabulary):
    ranks = dict(zip(vocabulary.tokens, vocabulary.ranks.tolist(), strict=True))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(texts, lang="en"):
    return [(i, t, lang, "x", 1, 2, "y", 3) for i, t in enumerate(texts)]


# -- byte-level BPE --------------------------------------------------------------


def test_perfect_hash_is_minimal(vocabulary):
    hashes = np.array([bpe.xxhash.xxh3_64_intdigest(t, vocabulary.seed) for t in vocabulary.tokens], np.uint64)
    assert vocabulary.hash.slots(hashes).tolist() == list(range(len(vocabulary.tokens)))


def test_perfect_hash_of_few_keys():
    for n in (0, 1, 2, 7):
        hashes = np.array([bpe.xxhash.xxh3_64_intdigest(str(i)) for i in range(n)], np.uint64)
        assert sorted(bpe.PerfectHash.of(hashes).slots(hashes).tolist()) == list(range(n))


def test_encoder_agrees_with_the_library_on_odd_texts(vocabulary, exact):
    encoder, rng = bpe.Encoder(vocabulary), random.Random(5)
    texts = ["".join(rng.choices("ab  \n\t'sdé😀漢,.!12\x00\x1c\x85\xa0", k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 30_000, "ab" * 20_000, " " * 5_000, "é" * 999, "<|endoftext|>", "x " * 200_000]
    assert encoder.encode(texts).to_pylist() == [exact.encode_ordinary(t) for t in texts]


def test_small_vocabulary_merges_leftmost_first():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258}
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(bpe.Vocabulary.of(ranks, r"\S+|\s+"))
    texts = ["a" * k + "b" * j for k in range(9) for j in range(4)]
    assert encoder.encode(texts).to_pylist() == [own.encode_ordinary(t) for t in texts]


def test_bpe_query_agrees_with_the_library(spark, exact):
    path = str(DATA / "sf0.001")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = QUERIES["op11_bpe"](spark, path).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = exact.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_hard_rows(spark, vocabulary, exact):
    texts = [None, "", " ", "same", "same", "word " * 100_000, "z" * 50_000]
    rows = [*rows_of(texts), (None, "no id", *rows_of([""])[0][2:])]
    got = bpe.decode(bpe.encode(spark.createDataFrame(rows, DOCUMENTS), vocabulary), vocabulary).collect()
    assert got[0].__fields__ == ["doc_id", "ids", "bytes"]
    assert sorted((r.ids, bytes(r.bytes)) for r in got) == sorted(
        (exact.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows
    )
    assert bpe.round_trip(spark.createDataFrame([], DOCUMENTS), vocabulary).collect() == []


def test_unknown_ids_decode_to_nothing(spark, vocabulary):
    rows = [(1, [72, None, -4, 10**9]), (2, None), (3, [])]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id int, ids array<int>"), vocabulary).collect()
    token = dict(zip(vocabulary.ranks.tolist(), vocabulary.tokens, strict=True))[72]
    assert sorted((r.doc_id, bytes(r.bytes)) for r in got) == [(1, token), (2, b""), (3, b"")]


# -- collocations ----------------------------------------------------------------


def brute_collocations(rows, p):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(p.longest, len(words) - i) + 1):
                    at = counts.setdefault(lang, Counter())
                    at[tuple(words[i : i + k])] += 1
    out = set()
    for lang, f in counts.items():
        frequent = {w: a for w, a in f.items() if len(w) > 1 and a >= p.least}
        best = []
        for w, a in frequent.items():
            spans = [v for v in frequent if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
            if any(100 * frequent[v] >= p.within_percent * a for v in spans):
                continue
            cuts = [(1000 * a * totals[lang] // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[: p.first], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def phrase_rows(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "OF", "of", "Ä", "ä", "x\x01y", "x\x00", "x", "a\x1c", "b"]
    hot = "one passage that all repeat"
    rows = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(words), hot, rng.choice(words)]) + rng.choice([" ", "\t ", " ", ". ", ",", "\n"]) for _ in range(rng.randint(0, 40))]
        rows.append(("".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "de"), (" \t ", "fr"), rows[0], rows[0], (prose(rng, 5_000, "ab"), "en")]


@pytest.mark.parametrize(
    "budget", [(1 << 16, 1 << 24), (50, 50), (5, 5)], ids=["one word prefixes", "longer prefixes", "whole phrases"]
)
def test_collocations_agree_with_brute_force(spark, budget):
    rows = phrase_rows(3, 150)
    p = phrases.PhraseParameters(least=10, first=300, budget=budget, share=10**9)
    frame = spark.createDataFrame([(i, t, lang, "x", 1, 2, "y", 3) for i, (t, lang) in enumerate(rows)], DOCUMENTS)
    got = {tuple(r) for r in phrases.collocations(frame.repartition(5), p).collect()}
    assert got and got == brute_collocations(rows, p)


def test_collocations_with_a_filter_that_lets_all_words_through(spark):
    rows = phrase_rows(4, 60)
    p = phrases.PhraseParameters(least=8, first=50, most_bits=1)
    frame = spark.createDataFrame([(i, t, lang, "x", 1, 2, "y", 3) for i, (t, lang) in enumerate(rows)], DOCUMENTS)
    assert {tuple(r) for r in phrases.collocations(frame, p).collect()} == brute_collocations(rows, p)


def test_collocations_drop_what_a_longer_phrase_mostly_covers(spark):
    rows = [("a b c. " * 30 + "a b. " * 10, "en")]
    p = phrases.PhraseParameters(least=5, within_percent=70)
    got = {r.phrase for r in phrases.collocations(spark.createDataFrame([(1, *r, "x", 1, 2, "y", 3) for r in rows], DOCUMENTS), p).collect()}
    assert got == {r[2] for r in brute_collocations(rows, p)} and "a b" not in got


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCUMENTS)).collect() == []
    assert phrases.collocations(spark.createDataFrame(rows_of([None, "", "one two"]), DOCUMENTS)).collect() == []


# -- vector codes ----------------------------------------------------------------


def brute_codes(rows, p):
    """Plain Python over (vec_id, vector, label) rows."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // p.parts) * p.parts
    size = width // p.parts
    vectors = [[int(np.floor(float(x) * p.scale)) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = [[v[k * size : (k + 1) * size] for k in range(p.parts)] for v in vectors]
    books = [[list(cut[i][k]) for i in order[: p.entries]] for k in range(p.parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(p.rounds):
        for k, book in enumerate(books):
            members = {}
            for v in cut:
                members.setdefault(nearest(v[k], book)[1], []).append(v[k])
            for e, parts in members.items():
                book[e] = [sum(x) // len(parts) for x in zip(*parts, strict=True)]
    found = [[nearest(v[k], books[k]) for k in range(p.parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{e:02x}" for _, e in f), err, by_label[r[2]], digest) for r, f, err in zip(kept, found, errors, strict=True)),
        key=repr,
    )


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, v int, error double"


def coded(spark, rows, p=codes.CodeParameters()):
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], VECTORS)
    return sorted((tuple(r) for r in codes.coded(frame, p).collect()), key=repr)


def float32(rng, n, low=-0.5, high=0.5):
    return [float(np.float32(rng.uniform(low, high))) for _ in range(n)]


def test_codes_agree_with_brute_force(spark):
    rng = random.Random(7)
    # Coarse values bring many ties; copies, null ids and labels, and vectors to be dropped come with them.
    rows = [(i, [rng.randint(-3, 3) / 256 for _ in range(32)], rng.choice([0, 1, None])) for i in range(300)]
    rows += [(i, float32(rng, 32), 2) for i in range(300, 500)] + [rows[0], rows[0], (None, rows[5][1], 1)]
    rows += [(900, None, 1), (901, [None] + [0.0] * 31, 1), (902, [float("nan")] * 32, 1), (903, [float("-inf")] * 32, None)]
    for p in (codes.CodeParameters(), codes.CodeParameters(parts=4, entries=40, rounds=1)):
        assert coded(spark, rows, p) == brute_codes(rows, p)


def test_codes_of_large_components_and_unlike_lengths(spark):
    rng = random.Random(8)
    rows = [(i, float32(rng, rng.choice([0, 5, 16, 20]), -1e5, 1e5), i % 2) for i in range(80)]
    p = codes.CodeParameters(entries=8)
    assert coded(spark, rows, p) == brute_codes(rows, p)
    huge = [(i, [3e38] * 16 if i else [-3e38] * 16, 1) for i in range(3)]
    assert [r[2] for r in coded(spark, huge)] == [0, 0, 0]


def test_codes_of_few_or_no_vectors(spark):
    p = codes.CodeParameters()
    assert coded(spark, [(1, None, 1)]) == []
    one = [(1, [0.25] * 16, None)]
    assert coded(spark, one) == brute_codes(one, p)
    assert [r[:3] for r in coded(spark, [(1, [], 1), (2, [], 1)])] == [(1, "00" * 16, 0), (2, "00" * 16, 0)]


def test_search_visits_fewer_entries_than_there_are():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (8, 4))
    book = (centres[:, None] + rng.integers(-40, 40, (8, 8, 4))).reshape(64, 4)
    queries = book[rng.integers(0, 64, 500)] + rng.integers(-5, 5, (500, 4))
    seen = 0
    plain = codes.squared

    def counted(a, b):
        nonlocal seen
        seen += max(len(a) if a.ndim > 1 else 1, 1)
        return plain(a, b)

    tree = codes.build(book)
    codes.squared = counted
    try:
        code, error = codes.assign(queries[:, None], [book], [tree])
    finally:
        codes.squared = plain
    all_d = ((queries[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code[:, 0] == all_d.argmin(axis=1)).all() and (error[:, 0] == all_d.min(axis=1)).all()
    assert seen < 500 * 32
