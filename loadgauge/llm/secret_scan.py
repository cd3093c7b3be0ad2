"""Secret scans through a trigram index.

Each rule's regular expression is turned into a Boolean query: an OR over its ways to match of the AND of the trigrams that way
cannot do without. The index holds postings (trigram, document id) of the trigrams the queries name; postings are intersected by
their ids, and only candidates are searched with the expression itself. A rule without mandatory trigrams is looked
for in every text. Everything runs as DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import IGNORECASE, _constants as K, _parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage
from .common import lower_ascii, or_empty

#: Ways to match that a query tells apart, and characters of a class that are tried one by one; beyond, the part is left open.
WAYS, CLASS = 64, 8
#: Trigrams of a way that one mask holds.
MASK = 63


@dataclass(frozen=True)
class Rule:
    """An expression all of whose leftmost matches count in which ``group`` has ``least`` code points; ASCII letters only fold."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


# The three base kinds; then well-known token formats.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("maps", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("payment", r"(sk|rk)_live_[A-Za-z0-9]+", 0, 24),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The ways ``pattern`` can match, each with the lower-case trigrams it needs; ways that need more than another are left out."""
    needs = set()
    for way in _ways(_parser.parse(pattern, IGNORECASE)):
        runs = "".join("\0" if c is None else c for c in way).lower().split("\0")
        needs.add(frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2)))
    return sorted((n for n in needs if not any(m < n for m in needs)), key=sorted)


def _ways(nodes) -> list[tuple]:
    """Sequences of characters, and None for what is left open."""
    ways: list[tuple] = [()]
    for op, value in nodes:
        more = _ways_of(op, value)
        ways = [a + b for a in ways for b in more] if len(ways) * len(more) <= WAYS else [a + (None,) for a in ways]
    return ways


def _ways_of(op, value) -> list[tuple]:
    open_ = [(None,)]
    if op is K.LITERAL:
        return [(chr(value),)] if value < 128 else open_
    if op is K.IN:
        chars = [chr(v) for kind, v in value if kind is K.LITERAL and v < 128]
        return [(c,) for c in chars] if len(chars) == len(value) <= CLASS else open_
    if op is K.BRANCH:
        found = [w for branch in value[1] for w in _ways(branch)]
        return found if len(found) <= WAYS else open_
    if op is K.SUBPATTERN:
        return _ways(value[3])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        low, high, inner = value
        if (low, high) == (0, 1):
            return [(), *_ways(inner)]
        if not low:
            return open_
        once = _ways(inner)
        return once if (low, high) == (1, 1) else [w + (None,) for w in once]
    return open_


def _masks(queries: dict[str, list[frozenset[str]]]) -> int:
    """How many masks the way with the most trigrams needs."""
    return max([1, *(-(-len(way) // MASK) for ways in queries.values() for way in ways)])


def _query_table(spark: SparkSession, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(kind, way, trigram, bit0, full0, bit1, ...): one bit for each trigram of a way, in as many masks as the longest way needs; a row count fixed by the rules."""
    masks = range(_masks(queries))

    def bits(value: int) -> list[Column]:
        return [F.lit(value >> (MASK * m) & ((1 << MASK) - 1)).cast("long") for m in masks]

    rows = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(i).alias("way"), F.lit(t).alias("trigram"),
            *[c.alias(f"bit{m}") for m, c in enumerate(bits(1 << b))],
            *[c.alias(f"full{m}") for m, c in enumerate(bits((1 << len(way)) - 1))],
        )
        for kind, ways in queries.items() for i, way in enumerate(ways) for b, t in enumerate(sorted(way))
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def trigram_index(docs: DataFrame, trigrams: list[str], text: str, doc_id: str) -> DataFrame:
    """Postings (id, trigram), stored: the given trigrams that the text has, letters in lower case."""
    lowered = docs.select(F.col(f"`{doc_id}`").alias("id"), lower_ascii(or_empty(F.col(f"`{text}`"))).alias("low"))
    has = [F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]
    return stage(lowered.select("id", F.explode(F.array_compact(F.array(*has))).alias("trigram")), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, kinds): the rules whose query the document's postings satisfy."""
    wanted = index.join(F.broadcast(_query_table(index.sparkSession, queries)), "trigram")
    masks = range(_masks(queries))
    seen = [a for m in masks for a in (F.bit_or(f"bit{m}").alias(f"bits{m}"), F.first(f"full{m}").alias(f"full{m}"))]
    met = wanted.groupBy("id", "kind", "way").agg(*seen).where(" AND ".join(f"bits{m} = full{m}" for m in masks))
    return met.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def _matches(text: Column, rule: Rule) -> Column:
    """The rule's spans in code points, from the lengths of its matches and of what stands before each."""
    inner = f"(?i:{rule.pattern})" if rule.any_case else f"(?:{rule.pattern})"
    # The end of the text counts as a last, empty match: else what follows the last real one is searched from each of its characters.
    whole = F.lit(f"(?s)(.*?)({inner}|\\z)")
    before, match, part = (F.transform(F.regexp_extract_all(text, whole, F.lit(g)), F.char_length) for g in (1, 2, rule.group + 2))
    zipped = F.arrays_zip(before.alias("b"), match.alias("m"), part.alias("p"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["b"]
        span = F.array(F.struct(start.alias("start"), (start + x["m"]).alias("end")))
        return F.struct((start + x["m"]).alias("at"), F.when(x["p"] >= rule.least, F.concat(done["out"], span)).otherwise(done["out"]).alias("out"))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda done: done["out"])


def _named(spans: Column, order: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _may_match(rule: Rule) -> str:
    """An expression that any counted match satisfies: for a single class it asks for the least length, which rules out most texts at once."""
    single = rule.group == 0 and rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if single else ("(?i)" if rule.any_case else "") + rule.pattern


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as (row, spans): spans (start, order, kind, end) by start, then by the rules' order.

    Starts and ends are code points, ends exclusive. A kind's matches don't overlap, different kinds' can. Null and
    empty texts have no spans. Rows with the same id share their candidates and are searched each by itself; null ids are one id.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: ways for k, ways in queries.items() if all(ways)}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    data = docs.select(row, F.col(f"`{doc_id}`").alias("id"), or_empty(F.col(f"`{text}`")).alias("text"))
    if indexed:
        index = trigram_index(docs, sorted({t for ways in indexed.values() for w in ways for t in w}), text, doc_id)
        found = candidates(index, indexed).withColumnRenamed("id", "with_id")
        data = data.join(found, F.col("id").eqNullSafe(F.col("with_id")), "left")
    else:
        data = data.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = []
    for order, r in enumerate(rules):
        tried = F.array_contains("kinds", r.kind) if r.kind in indexed else F.col("text").rlike(_may_match(r))
        found = F.when(F.coalesce(tried, F.lit(False)), _matches(F.col("text"), r)).otherwise(none)
        spans.append(_named(found, order, r.kind))
    return data.select("row", F.sort_array(F.concat(*spans)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
