"""Ranked lexical search: the documents that score highest for each item, by branch and bound over a prefix tree of documents.

Only the terms of the items matter, so each document is restricted to them: a vector of (term, occurrences), the terms numbered by how many documents
hold them, rarest first. A range sort brings documents of like vectors together. Each task reads its range in portions and
sees every portion as a prefix tree (documents as transactions, terms as path): a node is a run of neighbours that share a prefix, its children are
runs by the next term. For each child, the largest number of occurrences of every term below it and the smallest length factor ``m`` below it bound
every score there, for each item. The search goes depth first, to the most promising child first, with those items alone whose bound reaches their
``top``-th best score so far; where few documents are left, they are scored exactly. What remains of each task is at most ``top`` rows an
item, which are ranked over all tasks, first in parts.

A score is a sum over the item's distinct terms of ``weight * ((SCALE * tf) div (1000 * tf + 20 * m))``, in whole numbers. Bounds are sums of the same
terms with larger tf and smaller m, so no document of the answer is cut off, and equal scores are kept until their ids decide.

Items are taken in blocks of bounded size, each a pass over the documents: the items' terms travel with the tasks, documents never do.
Rows: null and empty texts have no terms; items without terms, or with none that a document holds, have no answer. Items equal in id and text are one, items that share
an id only are ranked each for itself. Documents that repeat an id are ranked each; a null id comes after all others among equal scores.
Texts are read whole. Other columns are ignored. Without documents the answer is empty.
"""

from __future__ import annotations

from collections import Counter
from heapq import nsmallest
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from valora.llm.common import slices
from valora.session import materialize, scratch_tables

#: Characters of item text per block.
BLOCK_CHARS = 200_000
#: (document, term) entries of one portion of a task, documents at or below which a node is scored, (run, term) cells that are bounded at once.
PORTION, LEAF, CELLS = 400_000, 48, 500_000
#: Terms by which ranges are told apart: the sample that finds the ranges holds no more of a vector.
HEAD = 6
#: Parts in which the tasks' answers for an item are ranked before they meet.
PARTS = 64
# The score's whole-number scale, saturation and length factor in percent.
SCALE, TF_FACTOR, M_FACTOR, M_LEAST, M_SHARE = 1_000_000_000, 1000, 20, 50, 50
#: ASCII letters to lower case and all else that is neither digit nor letter to a space; bytes of other characters stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``m`` of documents of ``n`` terms."""
    return M_LEAST + np.array([M_SHARE * int(x) * documents // terms for x in n], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one occurrence count is worth, before its weight; rises with ``tf`` and falls with ``m``."""
    return SCALE * tf // (TF_FACTOR * tf + M_FACTOR * m)


def restricted(vocabulary: dict[bytes, int]):
    """(id, text) batches to (id, n, terms, tfs): the number of all terms, and the ones of the vocabulary with their occurrences."""
    def run(batches):
        for batch in slices(batches):
            numbers, terms, tfs, offsets = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                numbers.append(len(words))
                for word, tf in Counter(words).items():
                    if (term := vocabulary.get(word)) is not None:
                        terms.append(term)
                        tfs.append(tf)
                offsets.append(len(terms))
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                                              pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["id", "n", "terms", "tfs"])
    return run


class Best:
    """The ``top`` best (score, id) of each item seen so far, and the score that a document must reach to count."""

    def __init__(self, items: int, top: int):
        self.top, self.kept, self.least = top, [[] for _ in range(items)], np.ones(items, np.int64)

    def offer(self, item: int, scores: np.ndarray, ids: list) -> None:
        kept = nsmallest(self.top, self.kept[item] + [(-s, i is None, i) for s, i in zip(scores.tolist(), ids)], key=lambda x: x[:2] if x[1] else x)
        self.kept[item] = kept
        if len(kept) == self.top:
            self.least[item] = -kept[-1][0]


class DocumentTree:
    """The prefix tree of one portion: documents with their restricted vectors, in the vectors' order.

    ``wanted`` says which item (column) asks for which term (row). Sums are of whole numbers, held in doubles where these are exact.
    """

    def __init__(self, ids: list, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, wanted: np.ndarray):
        self.ids, self.m, self.offsets, self.terms, self.tfs, self.weights, self.wanted = ids, m, offsets, terms, tfs, weights, wanted
        highest = int(wanted.sum(axis=0).max(initial=0)) * int(weights.max(initial=0)) * (SCALE // TF_FACTOR)
        self.exact = np.float64 if highest < 2**53 else np.int64

    def scores(self, starts: np.ndarray, high: int, items: np.ndarray) -> np.ndarray:
        """For each run of documents that begins at ``starts``, the last one ending at ``high``, and each item: the sum of the item's weighted
        impacts, of the run's largest tf of every term and smallest m. For runs of one document that is its score."""
        ends = np.append(starts[1:], high)
        many = int(np.diff(self.offsets[[starts[0], high]])[0])
        step = max(1, CELLS // max(1, min(many, len(self.weights))))
        return np.concatenate([self.summed(starts[i:i + step], ends[i:i + step], items) for i in range(0, len(starts), step)])

    def summed(self, starts: np.ndarray, ends: np.ndarray, items: np.ndarray) -> np.ndarray:
        low, high = starts[0], ends[-1]
        begin, end = self.offsets[low], self.offsets[high]
        present, column = np.unique(self.terms[begin:end], return_inverse=True)
        run = np.repeat(np.arange(len(starts)), self.offsets[ends] - self.offsets[starts])
        most = np.zeros((len(starts), len(present)), np.int64)
        np.maximum.at(most, (run, column), self.tfs[begin:end])
        least = np.minimum.reduceat(self.m[low:high], starts - low)
        worth = self.weights[present] * impact(most, least[:, None])
        return (worth.astype(self.exact) @ self.wanted[np.ix_(present, items)].astype(self.exact)).astype(np.int64)

    def search(self, best: Best) -> None:
        """Depth first, from the root, which is the whole portion."""
        if len(self.ids):
            self.visit(0, len(self.ids), 0, np.arange(self.wanted.shape[1]), best)

    def visit(self, low: int, high: int, depth: int, items: np.ndarray, best: Best) -> None:
        todo = [(low, high, depth, items, None)]
        while todo:
            low, high, depth, items, bounds = todo.pop()
            if bounds is not None:  # items may have got better answers meanwhile
                items = items[bounds >= best.least[items]]
            if not len(items):
                continue
            if high - low <= LEAF or self.alike(low, high, depth):
                self.score(low, high, items, best)
                continue
            starts, depth = self.children(low, high, depth)
            bounds = self.scores(starts, high, items)
            # The child with the highest bound is visited first, so it is put on the stack last.
            for child in np.argsort(bounds.max(axis=1), kind="stable"):
                end = starts[child + 1] if child + 1 < len(starts) else high
                todo.append((starts[child], end, depth + 1, items, bounds[child]))

    def alike(self, low: int, high: int, depth: int) -> bool:
        """Whether no term follows the shared prefix in any of the documents: they are sorted, so the last one tells."""
        return self.offsets[high] - self.offsets[high - 1] <= depth

    def children(self, low: int, high: int, depth: int) -> tuple[np.ndarray, int]:
        """(where the runs by the next term begin, the depth at which they part): single children are passed over."""
        while True:
            at = self.offsets[low:high] + depth
            following = np.where(at < self.offsets[low + 1:high + 1], self.terms[np.minimum(at, len(self.terms) - 1)], -1)
            starts = low + np.concatenate([[0], np.flatnonzero(np.diff(following)) + 1])
            if len(starts) > 1 or following[0] < 0:
                return starts, depth
            depth += 1

    def score(self, low: int, high: int, items: np.ndarray, best: Best) -> None:
        """Score documents, a few at a time."""
        for begin in range(low, high, LEAF):
            end = min(begin + LEAF, high)
            found = self.scores(np.arange(begin, end), end, items)
            for column in np.flatnonzero((found >= best.least[items]).any(axis=0)):
                item = items[column]
                reach = np.flatnonzero(found[:, column] >= best.least[item])
                best.offer(item, found[reach, column], [self.ids[begin + i] for i in reach])


def searched(weights: np.ndarray, wanted: np.ndarray, documents: int, terms: int, top: int):
    """(id, n, terms, tfs) batches, in the vectors' order, to (item, id, score): the best of the task's documents for each item."""
    def run(batches):
        best, held, entries, kind = Best(wanted.shape[1], top), [], 0, None

        def portion():
            lengths = np.concatenate([b.column("terms").value_lengths().to_numpy(zero_copy_only=False) for b in held])
            flat = lambda name: np.concatenate([b.column(name).flatten().to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
            ids = [i for b in held for i in b.column("id").to_pylist()]
            m = length_factor(np.concatenate([b.column("n").to_numpy() for b in held]), documents, terms)
            DocumentTree(ids, m, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), flat("terms"), flat("tfs"), weights, wanted).search(best)

        for batch in slices(batches):
            kind = batch.schema.field("id").type
            held.append(batch)
            entries += len(batch.column("terms").flatten())
            if entries >= PORTION:
                portion()
                held, entries = [], 0
        if held:
            portion()
        for item, kept in enumerate(best.kept):
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(kept), pa.int32()), pa.array([i for _, _, i in kept], kind),
                                                  pa.array([-s for s, _, _ in kept], pa.int64())], names=["item", "id", "score"])
    return run


def ranked_block(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """(item, id, score, rank) for a block of (id, text) items; ``item`` is their number."""
    asked = [sorted(set(terms_of(text))) for _, text in items]
    vocabulary = {word: k for k, word in enumerate(sorted(set().union(*asked)))}
    kind = dict(docs.dtypes)["id"]
    vectors = materialize(docs.mapInArrow(restricted(vocabulary), f"id {kind}, n bigint, terms array<int>, tfs array<int>"), "vectors")
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # at most the block's vocabulary
    order = sorted(vocabulary.values(), key=lambda term: (holding.get(term, 0), term))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    weights = np.array([weight(total.documents, holding.get(term, 0)) for term in order], np.int64)
    wanted = np.zeros((len(order), len(items)), bool)
    for k, words in enumerate(asked):
        wanted[place[[vocabulary[w] for w in words]], k] = True

    def sort_terms(batches):
        for batch in slices(batches):
            lengths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            numbers = place[batch.column("terms").flatten().to_numpy(zero_copy_only=False)]
            by = np.lexsort((numbers, np.repeat(np.arange(len(lengths)), lengths)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.ListArray.from_arrays(offsets, pa.array(numbers[by], pa.int32())),
                                              pa.ListArray.from_arrays(offsets, pa.array(tfs[by], pa.int32()))], names=["id", "n", "terms", "tfs"])

    named = vectors.filter(F.size("terms") > 0)
    # Documents of one vector are spread by length and id, so no group of copies has to stay in one range.
    like = named.mapInArrow(sort_terms, named.schema).withColumn("tie", F.monotonically_increasing_id())
    rest = ["n", "id", "tie"]
    found = like.repartitionByRange(F.slice("terms", 1, HEAD), *rest).sortWithinPartitions("terms", *rest).drop("tie") \
        .mapInArrow(searched(weights, wanted, total.documents or 0, total.terms or 1, top), f"item int, id {kind}, score bigint")
    found = materialize(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))).withColumn("tie", F.monotonically_increasing_id()), "found")
    best = [F.col("score").desc(), F.col("id").asc_nulls_last(), "tie"]
    parts = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).filter(F.col("rank") <= top)
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= top).drop("part", "tie")


def ranked(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = 50) -> DataFrame:
    """(item_col, rank, id_col, score): for every item its ``top`` documents, highest score first, equal scores by id."""
    if item_col == id_col:
        raise ValueError(f"items and documents are both named by {id_col}")
    spark = documents.sparkSession
    with scratch_tables(spark):
        docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        asked = materialize(items.select(F.col(item_col).alias("name"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct(), "items")
        chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
        blocks, answer = chars // BLOCK_CHARS + 1, None
        for k in range(blocks):
            block = asked.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k).collect()
            names = spark.createDataFrame([(i, r.name) for i, r in enumerate(block)], f"item int, name {dict(asked.dtypes)['name']}")
            found = ranked_block(docs, [(r.name, r.text) for r in block], top)
            found = materialize(found.join(F.broadcast(names), "item").select(
                F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"), "ranked", kept=True)
            answer = found if answer is None else answer.union(found)
        return answer
