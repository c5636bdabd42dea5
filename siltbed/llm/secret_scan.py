"""Secret scan with a trigram inverted index; DataFrame functions only.

Each rule is a regular expression. From its literals follows a Boolean query: an
alternative needs all trigrams of its literal runs, a rule one of its
alternatives. The index holds postings (trigram, row) for the trigrams that the
rules ask for; the postings of a row meet in one small mask, on which the queries
are evaluated, and only candidate rows are matched. A rule with an alternative
without trigrams scans every text.

Defined cases: null and empty texts have no spans; repeated rows are judged
alike; a null id is kept. Spans count code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import id_order, stored
from siltbed.operators.settle import settle
from siltbed.operators.small_side import small_side


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: A match counts if this group has at least so many characters.
    group: int = 0
    least: int = 1


#: Fixed by the contract. A run of hexadecimal digits is always matched whole, so
#: its length can stand in the pattern; likewise that of an access key.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Rules beyond the base.
MORE_RULES = (Rule("private", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"),)
RULES = BASE_RULES + MORE_RULES


def literal_runs(pattern: str) -> list[list[str]]:
    """Alternatives of a pattern, each a list of strings that every match of it contains, in lower case."""
    from re import _constants as c
    from re import _parser

    def walk(nodes, alternatives: list[list[str]]) -> list[list[str]]:
        for op, value in nodes:
            if op is c.LITERAL:
                alternatives = [[*a[:-1], a[-1] + chr(value).lower()] for a in alternatives]
            elif op is c.SUBPATTERN:
                alternatives = walk(value[3], alternatives)
            elif op is c.BRANCH:
                alternatives = [x for branch in value[1] for x in walk(branch, alternatives)]
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and value[:2] == (0, 1) and all(o is c.LITERAL for o, _ in value[2]):
                alternatives = alternatives + walk(value[2], alternatives)
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and value[0] >= 1:
                alternatives = [[*a, ""] for a in walk(value[2], alternatives)]
            else:
                alternatives = [[*a, ""] for a in alternatives]
        return alternatives

    return walk(_parser.parse(pattern), [[""]])


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each the set of trigrams it needs; None if some alternative needs none."""
    needs = [
        frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)) for runs in literal_runs(pattern)
    ]
    return None if not all(needs) else sorted(set(needs), key=sorted)


def postings(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(trigram, id, th) for the trigrams of the vocabulary; ``trigram`` is its place there."""
    low = settle(texts.select("id", "th", "text"), low=F.lower("text"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for k, t in enumerate(vocabulary)]))
    return low.select("id", "th", F.explode(found).alias("trigram"))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id, th and a Boolean for each indexed rule, of the rows that some indexed rule may match."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    vocabulary = sorted({t for q in queries.values() for need in q for t in need})
    width = 62
    masks = [
        F.expr(f"bit_or(if(trigram div {width} = {k}, shiftleft(1L, trigram % {width}), 0L))").alias(f"mask{k}")
        for k in range(-(-len(vocabulary) // width))
    ]

    def has(need: frozenset[str]) -> Column:
        out = F.lit(True)
        for k in range(len(masks)):
            bits = sum(1 << (i % width) for i, t in enumerate(vocabulary) if t in need and i // width == k)
            out = out & (F.col(f"mask{k}").bitwiseAND(F.lit(bits)) == F.lit(bits))
        return out

    met = postings(texts, vocabulary).groupBy("id", "th").agg(*masks)
    verdicts = {kind: F.greatest(F.lit(False), F.lit(False), *map(has, q)) for kind, q in queries.items()}
    return met.select("id", "th", *(v.alias(f"may_{k}") for k, v in verdicts.items())).where(
        " or ".join(f"may_{k}" for k in verdicts)
    )


def _spans(order: int) -> str:
    """Spans of the matches, from the texts between them: a running length over both.

    A fold copies its array for every element, so the matches are folded in blocks
    of the square root of their number, from the lengths before each block: n matches
    cost n x sqrt(n), also in a text that is one long dump of keys.
    """
    span = "struct<start:bigint,ord:int,end:bigint,ok:boolean>"
    return f"""
      case when size(hits) = 0 then cast(array() as array<{span}>)
      else flatten(transform(
        aggregate(
          transform(sequence(0, size(hits) - 1, block), b -> named_struct('low', b, 'len', aggregate(
            slice(lengths, b + 1, block), 0L, (s, x) -> s + x.gap + x.hit))),
          named_struct('at', 0L, 'out', cast(array() as array<struct<low:int,at:bigint>>)),
          (s, x) -> named_struct('at', s.at + x.len, 'out', array_append(s.out, named_struct('low', x.low, 'at', s.at))),
          s -> s.out),
        b -> aggregate(
          slice(lengths, b.low + 1, block),
          named_struct('at', b.at, 'out', cast(array() as array<{span}>)),
          (s, x) -> named_struct(
            'at', s.at + x.gap + x.hit,
            'out', if(x.ok, array_append(s.out, named_struct(
              'start', s.at + x.gap, 'ord', {order}, 'end', s.at + x.gap + x.hit, 'ok', true)), s.out)),
          s -> s.out))) end"""


def matched(frame: DataFrame, rule: Rule, order: int, wanted: Column) -> DataFrame:
    """Adds ``spans_<kind>``: the rule's valid matches in ``text`` where ``wanted`` holds."""
    none = F.array().cast("array<string>")
    pattern = F.lit(rule.pattern)
    now = settle(frame, go=wanted & F.col("text").rlike(rule.pattern))
    now = settle(
        now,
        hits=F.when(F.col("go"), F.regexp_extract_all("text", pattern, 0)).otherwise(none),
        between=F.when(F.col("go"), F.split("text", rule.pattern, -1)).otherwise(none),
        checked=F.when(F.col("go"), F.regexp_extract_all("text", pattern, rule.group)).otherwise(none),
    )
    now = settle(
        now,
        block=F.expr("cast(ceil(sqrt(greatest(size(hits), 1))) as int)"),
        lengths=F.expr(f"""transform(hits, (hit, i) -> named_struct(
          'gap', cast(length(between[i]) as bigint), 'hit', cast(length(hit) as bigint), 'ok', length(checked[i]) >= {rule.least}))"""),
    )
    spans = F.expr(_spans(order))
    return settle(now, **{f"spans_{rule.kind}": spans}).drop("go", "hits", "between", "checked", "block", "lengths")


def secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base rules' spans, base_sha256, spans (all rules') and n_added of every document."""
    texts = documents.select(
        "doc_id", id_order().alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text")
    )
    may = stored(candidates(texts, rules), "secret-candidates")
    now = texts.join(small_side(may), ["id", "th"], "left")
    indexed = {c.removeprefix("may_") for c in may.columns if c.startswith("may_")}
    for order, rule in enumerate(rules):
        wanted = F.coalesce(F.col(f"may_{rule.kind}"), F.lit(False)) if rule.kind in indexed else F.lit(True)
        now = matched(now, rule, order, wanted)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base = [r for r in rules if r in BASE_RULES]

    def joined(of: list[Rule]) -> Column:
        every = F.array_sort(F.concat(*[F.col(f"spans_{r.kind}") for r in of]))
        return F.array_join(F.transform(every, lambda x: F.concat_ws(":", F.get(kinds, x["ord"]), x["start"], x["end"])), ",")

    counts = [F.size(f"spans_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in base]
    added = [F.size(f"spans_{r.kind}") for r in rules if r not in base]
    n_added = sum(added[1:], added[0]) if added else F.lit(0)
    return now.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(list(rules)).alias("spans"),
        n_added.cast("long").alias("n_added"),
    )
