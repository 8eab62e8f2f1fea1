"""Quality rules with risk-controlled cutoffs.

Statistics of each text are measured once. A rule rejects texts whose metric lies beyond a cutoff of a fixed grid; the labelled rows are a holdout on
which every cutoff is tested: it is certified for a stratum if the exact binomial (Clopper-Pearson) bound on its share of rejected good texts is below
the allowed share, at a level divided by the number of strata, rules and cutoffs (Bonferroni). So with probability ``1 - level`` no stratum loses more than
``risk`` of its good texts, over all its rules together. Of the certified cutoffs the strictest is used, if it rejects a larger share of
the bad texts than of the good ones. Strata with too few labels get no cutoff and lose nothing.

Rows: null and empty texts have no words and fail the base rule. A null stratum is one of its own. Repeated labels count once, as the worst;
labels of unknown ids are ignored. Rows that repeat an id are judged each by its own text. Texts are measured whole. Only SQL functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from valora.llm.common import SPACED_WORD, broadcast_if_small, text_of, words_of
from valora.session import materialize

RISK, LEVEL = 0.02, 0.05
#: Steps of a rule's grid.
STEPS = 50
#: Repeated windows for which a plain search is quicker than a sort.
FEW = 32
MOST_LABELS, MOST_STRATA = 4_000_000, 100_000


@dataclass(frozen=True)
class Rule:
    """Rejects texts whose ``metric``, from 0 to 1 and higher for worse, reaches the cutoff."""

    name: str
    metric: str


RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1) / 2"),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)"),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)"),
    Rule("long_words", "word_chars / greatest(n_words, 1) / 40"),
    Rule("short_words", "1 - word_chars / greatest(n_words, 1) / 10"),
    Rule("few_words", "1 - n_words / 1000"),
)


def measured(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long)."""
    kept = [c for c in documents.columns if c not in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    df = documents.select(*kept, text_of(text_col).alias("_text"))
    df = df.withColumn("_words", words_of(F.col("_text"), SPACED_WORD)) \
        .withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(SPACED_WORD[:-1]))) \
        .withColumn("_n", F.size("_words"))
    # Every column that a lambda reads is also read outside of it, else Spark would compute it anew for each element.
    df = df.withColumn("_windows", F.when(F.col("_n") >= 3, F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(
        *[F.get("_words", i + j) for j in range(3)]))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort("_windows")).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_again", F.array_distinct(F.filter("_sorted", lambda x, i: (i > 0) & (x == F.get("_sorted", i - 1)))))
    few = F.filter(F.sequence(F.lit(0), F.size("_windows") - 1), lambda i: F.array_contains("_again", F.get("_windows", i)))
    df = df.withColumn("_pairs", F.when(F.size("_again") > FEW, F.array_sort(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    many = F.array_sort(F.transform(F.filter("_pairs", lambda s, i: (s["x"] == F.get("_pairs", i - 1)["x"]) | (s["x"] == F.get("_pairs", i + 1)["x"])), lambda s: s["i"]))
    places = F.when(F.size("_again") == 0, F.array().cast("array<int>")).when(F.size("_again") <= FEW, few).otherwise(many)
    covered = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")), lambda acc, i: F.struct(
        (acc["n"] + i + 3 - F.greatest(i, acc["upto"])).alias("n"), (i + 3).alias("upto")))["n"]
    number = lambda c, name: c.cast("long").alias(name)
    return df.select(*kept, number(F.col("_n"), "n_words"), number(F.length(F.array_join("_words", "")), "word_chars"),
                     number(F.regexp_count("_text", F.lit(r"[#*$%&|<>]")), "n_symbols"), number(F.size("_lines"), "n_lines"),
                     number(F.size("_lines") - F.size(F.array_distinct("_lines")), "n_dup_lines"), number(covered, "n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def step_of(rule: Rule) -> Column:
    """The rule's metric as a step of the grid, 0 to STEPS."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.expr(rule.metric))) * STEPS).cast("int")


def is_certified(rejected: Column, good: Column, risk: float, level: float) -> Column:
    """Whether ``rejected`` of ``good`` rows bound the share below ``risk``: P(Binomial(good, risk) <= rejected) <= level, summed in logarithms."""
    odds = log(risk / (1 - risk))
    step = lambda acc, i: F.struct(
        (acc["term"] + F.log((good - i + 1) / i) + odds).alias("term"),
        (F.greatest(acc["sum"], acc["term"] + F.log((good - i + 1) / i) + odds)
         + F.log1p(F.exp(-F.abs(acc["sum"] - (acc["term"] + F.log((good - i + 1) / i) + odds))))).alias("sum"))
    none = good * log(1 - risk)
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(rejected, F.lit(1))), F.struct(none.alias("term"), none.alias("sum")), step)["sum"]
    return F.when(rejected >= good * risk, False).otherwise(F.when(rejected == 0, none).otherwise(total) <= log(level))


def cutoffs(statistics: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", stratum_col: str = "lang", label_col: str = "quality",
            risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, step, good, good_rejected, bad, bad_rejected): the strictest certified cutoff of each stratum and rule that has one."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.min(label_col).alias("label"))
    rows = statistics.filter(~base_failed()).join(broadcast_if_small(known, MOST_LABELS), F.col(id_col) == F.col("labelled"))
    steps = rows.select(F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), (F.col("label") > 0).alias("is_good"), F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), step_of(r).alias("step")) for r in RULES])).alias("x")).select("stratum", "is_good", "x.*")
    counts = materialize(steps.groupBy("stratum", "rule", "step").agg(
        F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad")), "steps")
    strata = counts.select("stratum").distinct().count()
    # One row per stratum, rule and step: a cutoff rejects what is at its step or beyond.
    beyond = Window.partitionBy("stratum", "rule").orderBy(F.desc("step"))
    every = Window.partitionBy("stratum", "rule")
    tested = counts.select("stratum", "rule", "step", F.sum("good").over(every).alias("good"), F.sum("bad").over(every).alias("bad"),
                           F.sum("good").over(beyond).alias("good_rejected"), F.sum("bad").over(beyond).alias("bad_rejected"))
    passed = tested.filter("step > 0").filter(is_certified(F.col("good_rejected"), F.col("good"), risk / len(RULES), level / max(1, strata) / len(RULES) / STEPS)) \
        .filter("bad_rejected * good > good_rejected * bad")
    return passed.groupBy("stratum", "rule").agg(F.min_by(F.struct("step", "good", "good_rejected", "bad", "bad_rejected"), "step").alias("x")).select("stratum", "rule", "x.*")


def judged(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality",
           risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(id_col, stratum, the statistics, base_failed, kept) of every document."""
    statistics = materialize(measured(documents.select(F.col(id_col), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                                                       F.col(text_col).alias("_given")), "_given").drop("_given"), "statistics")
    found = cutoffs(statistics, labels, id_col=id_col, stratum_col="stratum", label_col=label_col, risk=risk, level=level)
    limits = found.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r.name, F.col("step"))).alias(f"limit_{r.name}") for r in RULES])
    limits = broadcast_if_small(materialize(limits, "limits"), MOST_STRATA)
    beyond = F.lit(False)
    for r in RULES:
        beyond = beyond | F.coalesce(step_of(r) >= F.col(f"limit_{r.name}"), F.lit(False))
    return statistics.join(limits, "stratum", "left").withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & ~beyond).drop(*[f"limit_{r.name}" for r in RULES])
