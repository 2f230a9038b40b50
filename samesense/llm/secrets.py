"""Secret scans over a trigram inverted index.

From each rule's pattern follows a Boolean query over trigrams that every matching text
must satisfy. Texts post the trigrams that some query asks for; postings are intersected
by text, and the patterns run on the texts whose postings satisfy a query. Rules without
mandatory trigrams run on every text. Texts are known by a 128-bit hash, so copies of a
text are indexed and searched once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from samesense.llm import bloom
from samesense.llm.batches import append
from samesense.llm.words import fresh, let, whole
from samesense.skew import lookup
from samesense.storage import store


@dataclass(frozen=True)
class Rule:
    """A pattern; ``group`` must have ``least`` characters or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds of the contract, in their order.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
# Well-known formats of keys, found beside the base kinds.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
RULES = BASE + MORE
MAX_STRINGS = 64
CANDIDATE_BYTES = 32 << 20
SPANS = ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()))

# A query is a set of alternatives, each a set of trigrams that must all occur.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _absorb(query) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(left: Query, right: Query) -> Query:
    made = _absorb({a | b for a in left for b in right})
    return made if len(made) <= MAX_STRINGS else left


def _of_strings(strings: set[str]) -> Query:
    return _absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _read(items) -> tuple[set[str] | None, Query]:
    """Of a sequence: the strings it stands for if they are few, and its trigram query."""
    query, strings, exact = ANY, {""}, True
    for kind, value in items:
        some, needs = _read_one(kind, value)
        joined = None if some is None else {a + b for a in strings for b in some}
        if joined is not None and len(joined) <= MAX_STRINGS:
            strings = joined
            continue
        query = _both(query, _of_strings(strings))
        exact = False
        if some is None:
            query, strings = _both(query, needs), {""}
        else:
            strings = some
    return (strings, _of_strings(strings)) if exact else (None, _both(query, _of_strings(strings)))


def _read_one(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is op.IN:
        chars: set[str] = set()
        for what, arg in value:
            if what is op.LITERAL:
                chars.add(chr(arg).lower())
            else:
                return None, ANY
        return (chars, ANY) if len(chars) <= 8 else (None, ANY)
    if kind is op.SUBPATTERN:
        return _read(value[-1])
    if kind is op.BRANCH:
        parts = [_read(part) for part in value[1]]
        if all(some is not None for some, _ in parts):
            strings = set().union(*[some for some, _ in parts])
            if len(strings) <= MAX_STRINGS:
                return strings, ANY
        return None, _absorb(set().union(*[needs for _, needs in parts]))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        some, needs = _read(inner)
        if (low, high) == (0, 1) and some is not None:
            return some | {""}, ANY
        return None, (needs if low else ANY)
    if kind is op.AT:
        return {""}, ANY
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """What a text with a match must contain, over its lower-cased trigrams.

    Letters are taken in lower case whatever the pattern's flags; that only admits more.
    ``{frozenset()}`` means that nothing is mandatory.
    """
    return _read(parser.parse(pattern))[1]


def _spans(rule: Rule, text: str, compiled: re.Pattern) -> list[tuple[str, int, int]]:
    return [
        (rule.kind, *m.span()) for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def _verify(docs: DataFrame, text: str, name: str, rules: list[Rule]) -> DataFrame:
    """``docs`` with the spans of ``rules``."""

    def start():
        compiled = [(rule, re.compile(rule.pattern, re.ASCII)) for rule in rules]

        def work(texts):
            rows = [[s for rule, c in compiled for s in _spans(rule, t, c)] for t in texts]
            return pa.array(
                [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows],
                pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
            )

        return work

    return append(docs, text, name, SPANS, start)


def _satisfied(posted: Column, query: Query, number: dict[str, int]) -> Column:
    """The Boolean query over a text's posted trigrams, held as one bit each in 62-bit words."""
    met = F.lit(False)
    for alternative in sorted(query, key=sorted):
        all_of = F.lit(True)
        by_word: dict[int, int] = {}
        for trigram in alternative:
            word, bit = divmod(number[trigram], 62)
            by_word[word] = by_word.get(word, 0) | 1 << bit
        for word, bits in sorted(by_word.items()):
            all_of = all_of & (posted[f"b{word}"].bitwiseAND(F.lit(bits)) == bits)
        met = met | all_of
    return met


def postings(texts: DataFrame, text: Column, trigrams: list[str]) -> DataFrame:
    """The inverted index: one row ``trigram`` (its number) per text that holds it."""
    present = let(
        F.lower(text),
        lambda lowered: F.filter(
            F.array(*[F.when(F.contains(lowered, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]),
            lambda x: x.isNotNull(),
        ),
    )
    return texts.withColumn("trigram", F.explode(present))


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """``docs`` without its text, with an array of spans ``kind, start, end``, and that column's name.

    Spans are code points, leftmost and non-overlapping per kind, ordered by start and then
    by the order of the rules. A null or empty text has none; repeated rows get the same
    spans each; an empty table gives an empty table. Whole texts are searched.
    """
    name = fresh(docs, "spans")
    one, two = fresh(docs, "_text1"), fresh(docs, "_text2")
    body = whole(text)
    keyed = docs.withColumn(one, F.xxhash64(body)).withColumn(two, F.xxhash64(F.lit(7), body))
    queries = {rule: trigram_query(rule.pattern) for rule in rules}
    full = [rule for rule in rules if queries[rule] == ANY]
    indexed = [rule for rule in rules if queries[rule] != ANY]
    everywhere = _verify(keyed, text, name, full).drop(text) if full else keyed.drop(text).withColumn(name, F.array().cast(SPANS))
    found = None
    if indexed:
        found = _indexed(keyed.select(F.col(one).alias("k1"), F.col(two).alias("k2"), body.alias("text")), indexed)
    if found is not None:
        extra = fresh(docs, "_more")
        found = found.select(F.col("k1").alias(one), F.col("k2").alias(two), F.col("spans").alias(extra))
        # stored, so that counting hot keys does not search the texts again
        everywhere = lookup(store(everywhere, "spans"), found, [one, two], everywhere.columns).withColumn(
            name, F.concat(F.col(name), F.coalesce(F.col(extra), F.array().cast(SPANS)))
        ).drop(extra)
    order = F.lit([rule.kind for rule in rules])
    ranked = F.transform(
        F.array_sort(
            F.transform(
                name,
                lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return everywhere.withColumn(name, ranked).drop(one, two), name


def _indexed(texts: DataFrame, rules: list[Rule]) -> DataFrame | None:
    """Spans of the rules with mandatory trigrams: ``k1, k2, spans`` per text with any."""
    queries = {rule: trigram_query(rule.pattern) for rule in rules}
    trigrams = sorted({t for query in queries.values() for alternative in query for t in alternative})
    number = {t: i for i, t in enumerate(trigrams)}
    index = store(postings(texts.select("k1", "k2", "text"), F.col("text"), trigrams).select("trigram", "k1", "k2"), "postings")
    words = range(-(-len(trigrams) // 62))
    bit = lambda w: F.when(F.expr(f"trigram div 62 = {w}"), F.expr("shiftleft(1L, cast(trigram % 62 as int))")).otherwise(0)
    posted = index.groupBy("k1", "k2").agg(*[F.bit_or(bit(w)).alias(f"b{w}") for w in words])
    columns = {f"b{w}": F.col(f"b{w}") for w in words}
    any_rule = F.lit(False)
    for rule in rules:
        any_rule = any_rule | _satisfied(columns, queries[rule], number)
    hits = store(posted.where(any_rule).select("k1", "k2"), "candidates")
    n = hits.count()
    if not n:
        return None
    # a filter of bounded size keeps other texts out of the shuffle; the join decides
    level = bloom.build(hits.select(F.xxhash64("k1", "k2").alias("key")), n, 0.01, 1, CANDIDATE_BYTES, shrink=True)
    likely = texts.where(bloom.admits(F.xxhash64("k1", "k2"), level))
    wanted = likely.groupBy("k1", "k2").agg(F.first("text").alias("text")).join(hits, ["k1", "k2"], "left_semi")
    return _verify(wanted, "text", "spans", rules).where("size(spans) > 0").select("k1", "k2", "spans")
