"""Benchmark decontamination by winnowing.

Of every run of ``window - gram + 1`` consecutive word grams the one with the least hash is a fingerprint, on both
sides, so two texts that share ``window`` consecutive words share a fingerprint there: no shared window is lost.
Fingerprints of the documents meet those of the items; each meeting point is extended to the windows around it, and
these are compared word by word. Nothing is compared pair by pair: a common passage costs one row per occurrence.

Rows: null and empty texts have no words. Items with fewer words than a window are one window of their own length; they
are below the reach of fingerprints and are looked up by a hash of that length, only if there are such items. Rows that repeat
id and text give one result row each; a null id is an id like any other. Empty tables give empty results (no document) or no hits
(no item). Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from valora.llm.common import ascii_lower, broadcast_if_small, text_key, text_of, words_of
from valora.session import materialize, scratch_tables

WINDOW, GRAM = 13, 5
#: Most rows of the benchmark's fingerprints (8 bytes each) or windows (about 100 bytes each) that are broadcast.
MOST_FINGERPRINTS, MOST_WINDOWS = 500_000, 50_000


def with_winnowed(df: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Add ``n``, ``grams`` (hash by position) and ``picked``: the positions that are least in some run of grams.

    A gram's last four bits are its position modulo 16, so that the least of a run tells where it stands; a run has 16 grams at most.
    Equal grams may then be picked at different places on the two sides, but always inside the shared window.
    """
    run = window - gram + 1
    if not 1 <= run <= 16:
        raise ValueError("window - gram + 1 must be from 1 to 16")
    words, n = F.col("words"), F.col("n")
    marked = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(gram)]).bitwiseOR(F.lit(15)).bitwiseXOR((i % 16).cast("long"))
    df = df.withColumn("n", F.size("words")).withColumn("grams", F.when(n >= gram, F.transform(F.sequence(F.lit(0), n - gram), marked))
                                                        .otherwise(F.array().cast("array<bigint>")))
    least = lambda i: i + F.pmod(15 - F.array_min(F.slice("grams", i + 1, F.lit(run))).bitwiseAND(F.lit(15)).cast("int") - i, F.lit(16))
    # Every column that a lambda reads is also read outside of it, else Spark would compute it anew for each element.
    return df.withColumn("picked", F.when(F.size("grams") >= run, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("grams") - run), least)))
                         .otherwise(F.array().cast("array<int>")))


def print_at(p: Column) -> Column:
    return F.shiftright(F.get("grams", p), 4)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item, window_text, length) of every window of every item, each once."""
    return items.filter("n > 0").withColumn("length", F.least("n", F.lit(window))).select(
        "item", "length", F.explode(F.transform(
            F.sequence(F.lit(1), F.col("n") - F.col("length") + 1),
            lambda i: F.array_join(F.slice("words", i, F.col("length")), " "))).alias("window_text")).distinct()


def covered(spans: Column) -> Column:
    """Number of positions inside any of the (start, length) spans."""
    step = lambda acc, x: F.struct(
        (acc["count"] + F.greatest(x["start"] + x["length"] - F.greatest(x["start"], acc["upto"]), F.lit(0))).alias("count"),
        F.greatest(acc["upto"], x["start"] + x["length"]).alias("upto"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("count"), F.lit(0).alias("upto")), step)["count"]


def windows_of(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """One ``head`` row per document, and one for each place (start, length, window_text) of a
    document that may be a window of an item: all those that hold a fingerprint shared with an item."""
    sought = broadcast_if_small(
        items.filter(F.col("n") >= window).select(F.explode(F.transform("picked", print_at)).alias("sought")).distinct(),
        MOST_FINGERPRINTS)
    reach = window - gram
    around = lambda p: F.greatest(p - reach, F.lit(0))
    head = F.struct(F.col("h1").alias("print"), F.lit(-1).alias("place"), F.lit(0).alias("from"),
                    F.array().cast("array<string>").alias("near"))
    places = F.transform("picked", lambda p: F.struct(
        print_at(p).alias("print"), p.alias("place"), around(p).alias("from"),
        F.slice("words", around(p) + 1, F.lit(window + reach)).alias("near")))
    met = docs.select("doc", "h1", "h2", "n", F.explode(F.concat(F.array(head), places)).alias("x")).select("doc", "h1", "h2", "n", "x.*") \
        .join(sought, F.col("print") == F.col("sought"), "left").filter("sought IS NOT NULL OR place < 0").drop("sought", "print")
    last = F.least(F.col("place"), F.col("n") - window) - F.col("from")
    found = F.when(F.col("place") >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(
        (F.col("from") + i).alias("start"), F.lit(window).alias("length"),
        F.array_join(F.slice("near", i + 1, F.lit(window)), " ").alias("window_text")))) \
        .otherwise(F.array(F.struct(F.lit(-1).alias("start"), F.lit(0).alias("length"), F.col("h1").cast("string").alias("window_text"))))
    return met.select("doc", "h1", "h2", "n", (F.col("place") < 0).alias("head"), F.explode(found).alias("x")) \
        .select("doc", "h1", "h2", "n", "head", "x.*")


def short_windows_of(docs: DataFrame, items: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """The same rows for items below a window's length; ``lengths`` are theirs, fewer than ``window`` numbers."""
    sought = broadcast_if_small(items.filter(F.col("n").between(1, window - 1)).select(
        F.xxhash64(F.array_join("words", " ")).alias("sought"), F.col("n").alias("length")).distinct(), MOST_FINGERPRINTS)
    stretch = lambda k: lambda i: F.struct(
        (i - 1).alias("start"), F.lit(k).alias("length"), F.array_join(F.slice("words", i, F.lit(k)), " ").alias("window_text"))
    each = F.concat(*[F.when(F.col("n") >= k, F.transform(F.sequence(F.lit(1), F.col("n") - k + 1), stretch(k)))
                      .otherwise(F.array().cast("array<struct<start:int,length:int,window_text:string>>")) for k in lengths])
    places = docs.select("doc", "h1", "h2", "n", F.lit(False).alias("head"), F.explode(each).alias("x")).select("doc", "h1", "h2", "n", "head", "x.*")
    return places.withColumn("sought", F.xxhash64("window_text")).join(sought, ["sought", "length"], "left_semi").drop("sought") \
        .select("doc", "h1", "h2", "n", "head", "start", "length", "window_text")


def contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id_col, h1, h2, n_words, n_hit, items) of every document: words inside any occurrence of an item's window, and the
    sorted ids of the items with such windows. ``h1, h2`` is the hash of the text."""
    docs = documents.select(F.col(id_col).alias("doc"), *text_key(text_of(text_col)), words_of(ascii_lower(text_of(text_col))).alias("words"))
    docs = with_winnowed(docs, window, gram)
    items = with_winnowed(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                                           words_of(ascii_lower(text_of(item_text_col))).alias("words")), window, gram)
    lengths = [r[0] for r in items.filter(F.col("n").between(1, window - 1)).select("n").distinct().collect()]
    places = windows_of(docs, items, window, gram)
    if lengths:
        places = places.unionByName(short_windows_of(docs, items, sorted(lengths), window))
    owned = item_windows(items, window)
    texts = broadcast_if_small(owned.select(F.col("window_text").alias("known")).distinct(), MOST_WINDOWS)
    kept = places.join(texts, F.col("window_text") == F.col("known"), "left").filter("head OR known IS NOT NULL")
    kept = materialize(kept.select("doc", "h1", "h2", "n", "head", "start", "length", "window_text"), "windows")
    spans = kept.groupBy("doc", "h1", "h2").agg(
        F.max("n").alias("n_words"), F.sum(F.col("head").cast("long")).alias("rows"),
        F.collect_set(F.when(~F.col("head"), F.struct("start", "length"))).alias("spans"))
    in_items = kept.filter("NOT head").select("doc", "h1", "h2", "window_text").distinct().join(owned.select("window_text", "item"), "window_text") \
        .groupBy("doc", "h1", "h2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = [spans[c].eqNullSafe(in_items[c]) for c in ("doc", "h1", "h2")]
    joined = spans.join(in_items, same, "left").select(
        spans["doc"].alias(id_col), spans["h1"], spans["h2"], F.col("n_words").cast("long"), "rows",
        covered(F.col("spans")).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return joined.select(id_col, "h1", "h2", "n_words", "n_hit", "items", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy")).drop("copy")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminated(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    with scratch_tables(documents.sparkSession):
        found = contamination(documents, benchmark, id_col=id_col, text_col=text_col, **options)
        bad = materialize(found.filter(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col(id_col).alias("__bad_id"), F.col("h1").alias("__bad_h1"), F.col("h2").alias("__bad_h2")).distinct(), "contaminated", kept=True)
    h1, h2 = text_key(text_of(text_col))
    return documents.join(broadcast_if_small(bad, MOST_FINGERPRINTS), F.col(id_col).eqNullSafe(F.col("__bad_id")) & (h1 == F.col("__bad_h1")) & (h2 == F.col("__bad_h2")), "left_anti")
