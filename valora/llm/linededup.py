"""Repeated runs of lines, by a suffix array over line numbers, and the texts without the later copies.

Every text is a sequence of line ids. Lines that occur once can be in no repeated run and cut a text into segments;
prefix doubling orders the suffixes of all segments: rank ``k`` orders them by their first ``2 ** k`` lines, from pairs of
ranks ``k - 1``, with one aggregation over pairs, one range sort of the distinct pairs and one join per round. Suffixes of equal
rank ``k`` are an interval of the suffix array with a longest common prefix of ``2 ** k`` lines or more; the interval of any length ``m``
is named by two ranks, the suffix's own and that of the last ``2 ** k`` of the ``m`` lines. A maximal repeated run of ``min_words``
words or more is the union of its shortest stretches of ``min_words`` words, reckoned from each of its lines forwards and backwards. So doubling
stops at the longest such stretch, at most ``min_words`` lines, and the runs are read off the intervals of just those lengths:
every place in an interval but its first is a later copy.

Rows: null and empty texts have no lines and stay as they are. Lines of white space are passed over, and go where they lie inside a
deleted stretch. Words are what white space parts. The order of copies is by id, text hash and line; a null id comes last. Rows that repeat both id
and text count as one document and are treated alike. A run may repeat within a text. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from valora.llm.common import SPACED_WORD, text_of
from valora.session import materialize, scratch_tables

MIN_WORDS = 10


def lines_of(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, nth, line, n_words, h1, h2) of every line with a word; ``nth`` numbers them, ``line`` counts all lines."""
    rows = F.transform(F.split(text_of(text_col), "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("content")))
    wordy = F.filter(rows, lambda x: x["content"].rlike(r"[^\x20\x09-\x0D]"))
    return documents.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.posexplode(wordy).alias("nth", "x")) \
        .select("id", "key", "nth", "x.line", F.regexp_count("x.content", F.lit(SPACED_WORD)).alias("n_words"),
                F.xxhash64(F.lit(1), "x.content").alias("h1"), F.xxhash64(F.lit(2), "x.content").alias("h2"))


def ranked(pairs: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct pairs with their number in sorted order, from 1: a range sort, then a sum over the ranges' sizes."""
    spread = materialize(pairs.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = spread.groupBy("part").count()
    # One row per partition: small enough for one task.
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*by))
    return spread.withColumn("inside", inside).join(before, "part").withColumn(name, F.col("before") + F.col("inside")).drop("part", "before", "inside")


def suffix_ranks(lines: DataFrame, min_words: int) -> tuple[DataFrame, int]:
    """Lines that occur more than once with their ``segment``, ``at`` (place in it), ``size`` (of it), the ranks ``r0, r1, ...`` of their
    suffixes, and the number of ranks. A rank is null where no other suffix shares that long a prefix."""
    ids = lines.groupBy("h1", "h2").agg(F.count("*").alias("times")).filter("times > 1").select("h1", "h2")
    doc, whole = Window.partitionBy("id", "key").orderBy("nth"), Window.partitionBy("id", "key", "segment")
    lines = lines.join(ranked(ids, ["h1", "h2"], "r0"), ["h1", "h2"]).drop("h1", "h2").dropDuplicates(["id", "key", "nth"]) \
        .withColumn("segment", F.col("nth") - F.row_number().over(doc)) \
        .withColumn("at", F.row_number().over(whole.orderBy("nth")) - 1).withColumn("size", F.count("*").over(whole))
    lines = materialize(lines.drop("nth"), "ranks")
    level, reach = 0, min(min_words, lines.agg(F.max("size")).first()[0] or 0)
    while 2 ** (level + 1) <= reach:
        a, n = f"r{level}", 2 ** level
        paired = lines.withColumn("next", F.lead(a, n).over(whole.orderBy("at")))
        pairs = paired.filter(f"{a} IS NOT NULL AND next IS NOT NULL").groupBy(a, "next").agg(F.count("*").alias("times")).filter("times > 1").select(a, "next")
        lines = materialize(paired.join(ranked(pairs, [a, "next"], f"r{level + 1}"), [a, "next"], "left").drop("next"), "ranks")
        level += 1
    return lines, level + 1


def stretches(ranks: DataFrame, levels: int, min_words: int) -> DataFrame:
    """(id, key, first, last, length, low, high): for each line the shortest stretches of ``min_words`` words that begin and that
    end there, ``first`` to ``last``, with the two ranks that name the interval of their ``length`` lines; only repeated ones."""
    segments = ranks.groupBy("id", "key", "segment").agg(F.array_sort(F.collect_list(F.struct(
        "at", "line", "n_words", F.array(*[f"r{k}" for k in range(levels)]).alias("r")))).alias("lines")).withColumn("size", F.size("lines"))
    words = lambda part: F.aggregate(part, F.array(F.lit(0)), lambda acc, x: F.when(
        F.element_at(acc, -1) < min_words, F.concat(acc, F.array(F.element_at(acc, -1) + x["n_words"]))).otherwise(acc))
    taken = lambda part: F.when(F.element_at(words(part), -1) >= min_words, F.size(words(part)) - 1)
    forth = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.struct(
        i.alias("from"), taken(F.slice("lines", i + 1, F.lit(min_words))).alias("length")))
    back = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.struct(
        i.alias("upto"), taken(F.reverse(F.slice("lines", F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words))))).alias("length")))
    both = F.array_distinct(F.concat(forth, F.transform(back, lambda x: F.struct((x["upto"] - x["length"] + 1).alias("from"), x["length"].alias("length")))))
    found = segments.select("id", "key", "lines", F.explode(F.filter(both, lambda x: x["length"].isNotNull())).alias("x")) \
        .withColumn("level", F.floor(F.log2("x.length") + 1e-9).cast("int"))
    tail = F.get("lines", F.col("x.from") + F.col("x.length") - F.pow(F.lit(2), F.col("level")).cast("int"))
    return found.select(
        "id", "key", F.get("lines", F.col("x.from"))["line"].alias("first"), F.get("lines", F.col("x.from") + F.col("x.length") - 1)["line"].alias("last"),
        "x.length", F.get(F.get("lines", F.col("x.from"))["r"], F.col("level")).alias("low"), F.get(tail["r"], F.col("level")).alias("high")) \
        .filter("low IS NOT NULL AND high IS NOT NULL")


def place() -> Column:
    """The order of lines over all documents."""
    return F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("key"), F.col("first"))


def later_copies(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, key, first, last): lines ``first`` to ``last`` of the text have stood before; ``key`` is the text's hash. Stretches overlap;
    together they are the maximal repeated runs of ``min_words`` words or more, without their first places."""
    ranks, levels = suffix_ranks(lines_of(documents, id_col, text_col), min_words)
    found = materialize(stretches(ranks, levels, min_words), "stretches")
    interval = ["length", "low", "high"]
    first = found.groupBy(*interval).agg(F.min(place()).alias("origin"), F.count("*").alias("times")).filter("times > 1").drop("times")
    return found.join(first, interval).filter(place() > F.col("origin")).select("id", "key", "first", "last").distinct()


def without_later_copies(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, each text without the lines that are later copies."""
    with scratch_tables(documents.sparkSession):
        copies = later_copies(documents, id_col=id_col, text_col=text_col, min_words=min_words)
        gone = copies.groupBy("id", "key").agg(F.flatten(F.collect_set(F.sequence("first", "last"))).alias("__gone"))
        gone = materialize(gone.select(F.col("id").alias("__gone_id"), F.col("key").alias("__gone_key"), "__gone"), "gone", kept=True)
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    joined = documents.join(gone.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("__gone_id")) & (F.xxhash64(text_col) == F.col("__gone_key")), "left")
    return joined.withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))).drop("__gone_id", "__gone_key", "__gone")
