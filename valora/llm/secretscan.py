"""Secrets in texts by regular expressions, with a trigram inverted index in front.

From each rule's pattern a Boolean query over trigrams is derived: an OR of sets of trigrams, one of which every match contains. The
index holds postings (trigram, text) for the trigrams that some query names; a text is a candidate for a rule when the postings of one
whole set meet on it. Only candidates are searched, by the pattern itself, so the index never changes a result. Rules without a mandatory
trigram search every text.

Rows: null and empty texts have no secrets. Letters are compared in lower case in the index, which only widens it. Equal texts share
their postings; every row, also one that repeats another, gets its own result. Other columns are ignored by ``secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as kind, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from valora.llm.common import broadcast_if_small, text_key, text_of
from valora.session import materialize

#: Most candidate texts (about 60 bytes each) that are broadcast.
MOST_CANDIDATES = 1_000_000
#: Strings of an exact part, and sets of a query, beyond which a query is weakened.
MOST_STRINGS, MOST_SETS = 64, 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int
    group: int = 0


#: The contract's rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
#: Public token formats.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", 39),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}", 24),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", 30),
)

Query = frozenset  # of frozensets of trigrams; {frozenset()} demands nothing
ANY = Query([frozenset()])


def smallest(sets) -> Query:
    """Without sets that contain another one."""
    return Query(s for s in sets if not any(t < s for t in sets))


def both(a: Query, b: Query) -> Query:
    joined = smallest({x | y for x in a for y in b})
    return joined if len(joined) <= MOST_SETS else min(a, b, key=lambda q: (q == ANY, len(q)))


def of_strings(strings: set[str]) -> Query:
    return smallest({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def trigram_query(pattern: str) -> Query:
    """Sets of lower-case trigrams; each match contains all of one set. ``{frozenset()}`` if no trigram is mandatory."""
    def exact(item) -> set[str] | None:
        """All strings that an item can match, if they are few."""
        op, arg = item
        if op is kind.LITERAL:
            return {chr(arg).lower()}
        if op is kind.IN and all(o is kind.LITERAL or o is kind.RANGE and a[1] - a[0] < MOST_STRINGS for o, a in arg):
            found = {chr(c).lower() for o, a in arg for c in ([a] if o is kind.LITERAL else range(a[0], a[1] + 1))}
            return found if len(found) <= 8 else None
        if op is kind.AT:
            return {""}
        if op is kind.SUBPATTERN:
            return sequence(arg[3])[0]
        if op is kind.BRANCH:
            parts = [sequence(branch)[0] for branch in arg[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if op is kind.MAX_REPEAT and arg[1] != kind.MAXREPEAT and arg[1] <= 4:
            one = sequence(arg[2])[0]
            found = one and {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
            return found if found and len(found) <= MOST_STRINGS else None
        return None

    def query(item) -> Query:
        """What an item without few strings demands."""
        op, arg = item
        if op is kind.SUBPATTERN:
            return sequence(arg[3])[1]
        if op is kind.BRANCH:
            return smallest(set().union(*(sequence(branch)[1] for branch in arg[1])))
        return sequence(arg[2])[1] if op is kind.MAX_REPEAT and arg[0] else ANY

    def sequence(items) -> tuple[set[str] | None, Query]:
        whole, run, found = True, {""}, ANY
        for item in items:
            strings = exact(item)
            if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
                run = {a + b for a in run for b in strings}
                continue
            whole, found = False, both(found, of_strings(run))
            run = strings if strings is not None else {""}
            if strings is None:
                found = both(found, query(item))
        return (run if whole else None), both(found, of_strings(run))

    return sequence(parser.parse(pattern))[1]


def spans_of(text: Column, rule: Rule) -> Column:
    """(start, end, kind) of a rule's matches in code points: the texts between matches tell where they stand."""
    pattern = F.lit(rule.pattern)
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    rows = F.zip_with(F.slice(between, 1, F.size(found)), F.arrays_zip(found.alias("found"), value.alias("value")), lambda gap, x: F.struct(
        F.length(gap).alias("gap"), F.length(x["found"]).alias("size"), (F.length(x["value"]) >= rule.least).alias("good")))
    span = "struct<start:int,end:int,kind:string>"
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["size"]).alias("at"),
        F.when(x["good"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"), F.lit(rule.kind).alias("kind")))))
        .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(rows, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans")), step)["spans"]


def secrets(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans): for each row the (start, end, kind) of its secrets, in order of start and then of the rules."""
    spark = documents.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if queries[r.kind] != ANY]
    trigrams = sorted({t for r in indexed for s in queries[r.kind] for t in s})
    docs = documents.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    listed = "array<struct<start:int,end:int,kind:string>>"
    nothing = F.array().cast(listed)
    always = F.concat(nothing, *[F.when(F.col("text").rlike(r.pattern), spans_of(F.col("text"), r)).otherwise(nothing) for r in rules if r not in indexed])
    if not indexed:
        return docs.select(F.col("id").alias(id_col), always.alias("spans"))
    fewest = min(len(s) for r in indexed for s in queries[r.kind])
    lower = docs.select("text", F.lower("text").alias("lower"))
    held = lower.select("text", F.array_compact(F.array(*[F.when(F.contains("lower", F.lit(t)), t) for t in trigrams])).alias("held"))
    postings = held.filter(F.size("held") >= fewest).select(*text_key(F.col("text")), F.explode("held").alias("trigram"))
    # The rules' sets of trigrams: as many rows as the rules give, whatever the documents.
    sets = spark.createDataFrame([(r.kind, f"{r.kind}/{i}", t, len(s)) for r in indexed for i, s in enumerate(sorted(queries[r.kind], key=sorted)) for t in sorted(s)],
                                 "kind string, demand string, trigram string, needs int")
    met = postings.join(F.broadcast(sets), "trigram").groupBy("h1", "h2", "kind", "demand").agg(F.countDistinct("trigram").alias("met"), F.first("needs").alias("needs")).filter("met = needs")
    candidates = materialize(met.groupBy("h1", "h2").agg(F.collect_set("kind").alias("kinds")), "candidates")
    hashed = docs.select("id", "text", *text_key(F.col("text")))
    joined = hashed.join(broadcast_if_small(candidates, MOST_CANDIDATES), ["h1", "h2"], "left")
    sought = F.concat(always, *[F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r)).otherwise(nothing) for r in indexed])
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    ranked = F.transform(sought, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return joined.select(F.col("id").alias(id_col), F.transform(F.array_sort(ranked), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
