"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean query of trigrams that a matching text must
hold. An inverted index has the postings of those trigrams; intersecting them by document
leaves the candidates of each rule, which the full expression then verifies. Rules without a
mandatory trigram scan every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.session import unused
from peerscope.llm.trigrams import trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` with at least ``least`` characters in
    ``group``. ``scan`` may name an expression with the same surviving matches."""

    kind: str
    pattern: str
    group: int
    least: int


# The base kinds. Runs of hex digits and of an access key are maximal, so asking
# for their length inside the expression drops just the matches that are too short.
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
                   "([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
)
# Public formats of further credentials.
MORE = (
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 20),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 26),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("cloud", "AIza[0-9A-Za-z_-]{35}", 0, 39),
    Rule("bearer", "(?i:bearer) +[A-Za-z0-9+/_.=-]{20,}", 0, 27),
    Rule("login", "[a-z]{2,10}://[^/\\x20:@\"']+:[^/\\x20:@\"']+@", 0, 10),
)
ALL = BASE + MORE
#: Matches whose ends are added up at a time.
BLOCK = 256


def _condition(query, held: Column) -> Column:
    if query[0] == "tri":
        return F.array_contains(held, query[1])
    parts = [_condition(q, held) for q in sorted(query[1], key=repr)]
    return reduce(and_ if query[0] == "and" else or_, parts)


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by id and text; rows that share it have the same candidates, and a chance
    collision only adds candidates, which are verified."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(trigram, key): the inverted index over ``key`` and ``text``, for these trigrams."""
    low = docs.select("key", F.lower("text").alias("low"))
    hits = F.array_compact(F.array(*(
        F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary)))
    return low.select("key", F.explode(hits).alias("trigram"))


def candidates(docs: DataFrame, rules=ALL) -> DataFrame:
    """(key, kinds): the rules whose trigram query a text satisfies, for texts with any."""
    asked = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not True}
    vocabulary = sorted(set().union(*map(trigrams_of, asked.values())))
    held = postings(docs, vocabulary).groupBy("key").agg(F.collect_set("trigram").alias("held"))
    kinds = F.array_compact(F.array(*(
        F.when(_condition(q, F.col("held")), F.lit(k)) for k, q in asked.items())))
    return held.select("key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def matches(text: str, rule: Rule, order: int) -> Column:
    """array<struct<start, rank, kind, stop, own>> of a rule in a text column; offsets in code
    points, end exclusive. The text between matches comes from splitting at them. Where a match
    ends is a running sum, taken in blocks of ``BLOCK`` matches and over these blocks, so that
    no long array is copied at every match."""
    # as SQL literals: raw strings, so that no backslash is taken away
    pattern = rule.pattern.replace("\\x20", " ")
    raw = "r'" + pattern.replace("'", "\\x27") + "'"
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    hits = f"regexp_extract_all({text}, {raw}, 0)"
    owns = f"regexp_extract_all({text}, {raw}, {rule.group})" if rule.group else "v.hits"
    steps = ("zip_with(slice(v.gaps, 1, size(v.hits)), v.hits, "
             "(gap, hit) -> length(gap) + length(hit))")
    none = "cast(array() AS array<int>)"
    blocks = (f"transform(sequence(0, cast((greatest(size(s), 1) - 1) div {BLOCK} AS int)), "
              f"i -> aggregate(slice(s, i * {BLOCK} + 1, {BLOCK}), "
              f"named_struct('at', 0, 'ends', {none}), (acc, x) -> named_struct("
              "'at', acc.at + x, 'ends', concat(acc.ends, array(acc.at + x)))))")
    starts = (f"aggregate(b, named_struct('at', 0, 'starts', {none}), (acc, x) -> named_struct("
              "'at', acc.at + x.at, 'starts', concat(acc.starts, array(acc.at))), "
              "acc -> acc.starts)")
    ends = f"flatten(zip_with(b, {starts}, (x, from) -> transform(x.ends, e -> e + from)))"
    spans = (f"filter(zip_with(zip_with({ends}, v.hits, (e, hit) -> named_struct("
             "'stop', e, 'hit', length(hit))), o, (x, own) -> named_struct("
             f"'start', x.stop - x.hit, 'rank', {order}, 'kind', '{rule.kind}', "
             f"'stop', x.stop, 'own', length(own))), x -> x.own >= {rule.least})")
    return F.expr(let(
        "v", f"named_struct('hits', {hits}, 'gaps', split({text}, {raw}, -1))",
        let("o", owns, let("s", steps, let("b", blocks, spans)))))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def with_secrets(df: DataFrame, rules=ALL, id_col: str = "doc_id", text_col: str = "text",
                 out_col: str = "secrets") -> DataFrame:
    """``df`` with a struct of each kind's span array, by kind, and ``spans`` with all of them
    in order of start, then rule. A column named ``out_col`` is replaced, others pass through,
    whatever their names. An empty table gives an empty one.

    A null text is an empty one: no spans. Null and repeated ids, and repeated rows, are
    scanned row by row. Whole texts are scanned, whatever their length.
    """
    docs = df.drop(out_col)
    key, kinds, text = unused(docs, "__key", "__kinds", "__text")
    docs = docs.withColumn(key, row_key(id_col, text_col))
    index = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    found = candidates(index.filter("text IS NOT NULL"), rules).toDF(key, kinds)
    rows = docs.join(found, key, "left").withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    none = F.expr("cast(array() AS array<struct<start:int,rank:int,kind:string,stop:int,own:int>>)")
    spans = []
    for order, rule in enumerate(rules):
        if trigram_query(rule.pattern) is True:
            try_it = F.col(text).rlike(rule.pattern.replace("\\x20", " "))
        else:
            try_it = F.array_contains(kinds, rule.kind)
        spans.append(F.when(try_it, matches(f"`{text}`", rule, order)).otherwise(none)
                     .alias(rule.kind))
    rows = rows.withColumn(out_col, F.struct(*spans))
    every = F.concat(*(F.col(f"{out_col}.{r.kind}") for r in rules))
    rows = rows.withColumn(out_col, F.col(out_col).withField("spans", F.array_sort(every)))
    return rows.drop(key, kinds, text)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every run of overlapping spans (sorted by start) replaced by ``mark``."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(
            fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, zero, cut, lambda acc: F.concat(acc["out"], F.substring(
            text, acc["at"] + 1, F.length(text)))))
