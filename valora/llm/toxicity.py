"""Toxicity of texts: restore disguised words by a noisy channel, then score the restored text.

A character trigram model is counted over all documents. A word that mixes letters with digits or signs, repeats a letter
or stands with spaces between its letters is a noisy image of plain words: each sign may stand for a letter, separate or be
noise, a repeated letter may be kept or dropped. Viterbi finds the most probable reading of this lattice under the trigram model. Any other word has
one path through its lattice and is its own reading. Features are the read words and their beginnings, told apart by 64-bit hashes. How often each is in
toxic and in other documents is counted over all labelled rows that may be learned from; a feature's weight is its shrunken log-odds, the score that of
the strongest few. Only features with weight are kept, and those without that are known and longer than one with weight, which they override.

Rows: null and empty texts have no features and score the share of toxic rows. Repeated labels count as toxic if any is; labels of
unknown or null ids are ignored, and without any labels every score is 0. Repeated words in a text count once. Texts are scored whole. Other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from valora.llm.common import broadcast_if_small, Memo, text_key, text_slices
from valora.session import materialize

#: Letters of the character model besides the boundary, and what signs may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœ"
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
         "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "µ": "u"}
#: Marks at a word's edges.
MARKS = ".,;:!?*%&#$\"'()[]{}<>-_/\\=+~^`|"
OPENING = "".join(c for c in MARKS if c not in SIGNS)
#: Costs in nats: a sign as a letter, as noise or as a boundary; a separator as noise or as a boundary; a third equal letter kept, a repeated one dropped.
SIGN_LETTER, SIGN_LOST, SIGN_BREAK, MARK_LOST, MARK_BREAK, THIRD_KEPT, REPEAT_LOST = 1.0, 9.0, 2.0, 0.5, 1.0, 3.0, 0.7
N = len(LETTERS) + 2  # with the boundary, 0, and any other letter, N - 1
BEGINNINGS = (6, 5, 4)
#: A feature's counts are shrunk by so many rows of the overall share; the score adds so many of the strongest weights.
SHRINK, STRONGEST = 3.0, 2
#: A word is judged by its longest feature that is in so many labelled rows.
EVIDENCE = 4
#: Toxic rows that must be credited to a feature.
CREDIT = 3
#: A feature's shrunken share of toxic rows, at least.
LEAST_RATE = 0.75
MOST_LABELS = 4_000_000
#: Kept features that are sent to all executors, 16 bytes each; more are joined.
MOST_WEIGHTS = 2_000_000
#: Odd multipliers of the hashes; fixed values.
MIX_A, MIX_B, PLACE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def letter_numbers() -> np.ndarray:
    """By code point: the letter's number in the character model."""
    number = {c: i + 1 for i, c in enumerate(LETTERS)}
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if c < 0x250 or unicodedata.category(x)[0] == "L":
            low = x.lower()
            kinds[c] = number.get(low, N - 1 if low.isalpha() else 0)
    return kinds


def counted(kinds) -> callable:
    """(text) batches to (code, n): trigrams of letters and boundaries, summed by task."""
    def run(batches):
        table, total = np.frombuffer(kinds.value, np.uint8), np.zeros(N ** 3, np.int64)
        for batch in text_slices(batches, 0):
            whole = "  ".join(["", *filter(None, batch.column(0).to_pylist()), ""])
            x = table[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
            if len(x) > 2:
                total += np.bincount((x[:-2] * N + x[1:-1]) * N + x[2:], minlength=N ** 3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["code", "n"])
    return run


def character_model(documents: DataFrame, text_col: str, kinds) -> np.ndarray:
    """Log-probabilities of each letter after two others, from all texts; N ** 3 numbers whatever the input's size."""
    rows = documents.select(text_col).mapInArrow(counted(kinds), "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    counts = np.full(N ** 3, 0.0)
    for r in rows:
        counts[r["code"]] = r["n"]
    cube = counts.reshape(N, N, N)
    pair = cube.sum(axis=0) + 0.05
    back = pair / pair.sum(axis=1, keepdims=True)
    smooth = (cube + 20 * back[None]) / (cube.sum(axis=2, keepdims=True) + 20)
    return np.log(smooth).astype(np.float32).reshape(-1)


def bare(token: str) -> str:
    """A token without the marks at its edges; signs that may stand for a letter stay at its beginning."""
    return token.rstrip(MARKS).lstrip(OPENING)


class Channel:
    """Reads disguised words."""

    DOUBLED, THRICE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")

    def __init__(self, model: np.ndarray):
        self.model, self.number = model.tolist(), {c: i + 1 for i, c in enumerate(LETTERS)}

    def arcs(self, c: str, before: str, twice: bool) -> list[tuple[str, float]]:
        """What a character may be read as; an empty string is noise."""
        if c.isalpha():
            if c != before:
                return [(c, 0.0)]
            return [(c, THIRD_KEPT if twice else 0.0), ("", REPEAT_LOST)]
        if c in SIGNS:
            return [*((x, SIGN_LETTER) for x in SIGNS[c]), ("", SIGN_LOST), (" ", SIGN_BREAK)]
        return [("", MARK_LOST), (" ", MARK_BREAK)]

    def read(self, seen: str) -> str:
        """The most probable words behind ``seen``: states are the last two letters, a word's edges included."""
        states = {(0, 0): (0.0, None, "")}
        before, twice = "", False
        model, number = self.model, self.number
        for c in seen:
            arcs = self.arcs(c, before, twice)
            twice, before = (c == before), c
            after = {}
            for (a, b), (cost, _, _) in states.items():
                origin = states[a, b]
                for x, price in arcs:
                    if x == "":
                        key, total = (a, b), cost + price
                    else:
                        k = 0 if x == " " else number.get(x, N - 1)
                        if k == 0 and b == 0:
                            continue
                        key, total = (b, k), cost + price - model[(a * N + b) * N + k]
                    if key not in after or total < after[key][0]:
                        after[key] = (total, origin, x)
            states = after or states
        end = min(states.items(), key=lambda s: s[1][0] - model[(s[0][0] * N + s[0][1]) * N])[1]
        out = []
        while end is not None:
            out.append(end[2])
            end = end[1]
        return "".join(reversed(out))

    def undoubled(self, word: str) -> str:
        """``read`` for letters of which none stands three times in a row. A second letter of a pair is dropped where that is cheaper: the
        paths meet again at the next letter, with the same two last letters, so each pair is decided by itself."""
        model, out, begin = self.model, [], 0
        numbers = [0, 0, *(self.number.get(c, N - 1) for c in word), 0]
        for pair in self.DOUBLED.finditer(word):
            i = pair.start()
            before, letter, after = numbers[i + 1], numbers[i + 2], numbers[i + 4]
            kept = -model[(before * N + letter) * N + letter] - model[(letter * N + letter) * N + after]
            if REPEAT_LOST - model[(before * N + letter) * N + after] < kept:
                out.append(word[begin:i + 1])
                begin = i + 2
        return "".join([*out, word[begin:]])

    def words(self, token: str) -> list[str]:
        """The plain words of a lower-cased token; quick where there is one reading."""
        core = bare(token)
        if core.isalpha() and not self.THRICE.search(core):
            read = self.undoubled(core) if self.DOUBLED.search(core) else core
            return [core] if read == core else [core, read]
        if not core:
            return []
        plain = re.findall(r"[^\W\d_]+", core)
        if not plain and not any(x in SIGNS for x in core):
            return []
        return [*plain, *(w for w in self.read(core).split() if w not in plain)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def features_of(words: list[str]) -> np.ndarray:
    """64-bit hashes of words and of their beginnings, a row each, the longest first; 0 where there is none.

    Every character at its place in the word has a 64-bit value, and a stretch of characters the sum of theirs: all beginnings come from one running sum.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), 1 + len(BEGINNINGS)), np.uint64)
    if len(words):
        starts = np.cumsum(lengths) - lengths
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        places = (np.arange(len(letters)) - np.repeat(starts, lengths)).astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(letters + (places + np.uint64(1)) * PLACE))])
        for i, n in enumerate((0, *BEGINNINGS)):
            there = lengths > (n or 2)
            ends = starts[there] + (n or lengths[there])
            out[there, i] = np.maximum(mixed(sums[ends] - sums[starts[there]] + np.uint64(0 if n else 1)), np.uint64(1))
    return out.view(np.int64)


class Reader:
    """Words of texts and their features."""

    def __init__(self, model: np.ndarray):
        channel = Channel(model)
        self.memo = Memo(lambda token: tuple(channel.words(token)))

    def pieces(self, text: str | None) -> list[str]:
        """What is read of a text, each once: its tokens, then those that are spaced out."""
        tokens = (text or "").lower().split()
        parts = dict.fromkeys(tokens)
        # Three or more single characters in a row, marks aside, may be one word that is spaced out.
        tokens = [t if len(t) == 1 or t.isalpha() else bare(t) for t in tokens]
        single = np.concatenate([[0], np.fromiter(map(len, tokens), np.int64, len(tokens)) == 1, [0]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(single))
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a >= 3:
                parts[" ".join(tokens[a:b])] = None
        return list(parts)

    def words(self, text: str | None) -> list[str]:
        """The words read of a text, each once."""
        return list(dict.fromkeys(chain.from_iterable(map(self.memo.__getitem__, self.pieces(text)))))

    def features(self, text: str | None) -> np.ndarray:
        return features_of(self.words(text))

    def found(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Each feature once and where it stands first in the flattened ``features``."""
        each, first = np.unique(self.features(text), return_index=True)
        return each[each != 0], first[each != 0]


def strongest(features: np.ndarray, texts: np.ndarray, kept: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` texts the sum of the strongest different weights of its words: ``features`` has a row for each word, ``texts`` its text.

    A word has the weight of its longest feature among the ``kept`` ones, which are sorted. All words are looked up at once.
    """
    total = np.zeros(n)
    if not len(kept):
        return total
    at = np.minimum(np.searchsorted(kept, features), len(kept) - 1)
    known = kept[at] == features
    judged = known.any(axis=1)
    column = known.argmax(axis=1)
    weight = np.where(judged, weights[at[np.arange(len(at)), column]], 0.0)
    pairs = np.unique(np.column_stack([texts[weight > 0], -weight[weight > 0]]), axis=0)
    if len(pairs):
        text = pairs[:, 0].astype(np.int64)
        first = np.concatenate([[True], text[1:] != text[:-1]])
        rank = np.arange(len(text)) - np.maximum.accumulate(np.where(first, np.arange(len(text)), 0))
        total += np.bincount(text[rank < STRONGEST], -pairs[rank < STRONGEST, 1], minlength=n)
    return total


@dataclass
class Model:
    characters: object  # broadcast log-probabilities
    weights: object  # broadcast features, sorted, and their weights; or a table (feature, weight)
    share: float


def fit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn: Column | None = None) -> Model:
    """Learn from the rows of ``labels`` where ``learn``, a condition on the documents, holds. All such rows are used; what reaches the driver are the
    character counts, the number of features and at most MOST_WEIGHTS weights, whatever the input's size."""
    sc = documents.sparkSession.sparkContext
    kinds = sc.broadcast(letter_numbers().tobytes())
    characters = sc.broadcast(character_model(documents, text_col, kinds))
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.max(label_col).alias("label"))
    rows = documents.filter(learn) if learn is not None else documents
    rows = rows.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    # Copies of a text are one observation, else the words of a much copied text would look significant.
    single = rows.join(broadcast_if_small(known, MOST_LABELS), F.col("id") == F.col("labelled")).groupBy("key") \
        .agg(F.min("id").alias("labelled"), F.max("label").cast("int").alias("label")).withColumnRenamed("key", "own")
    single = broadcast_if_small(materialize(single, "labelled"), MOST_LABELS)
    rows = rows.join(single, (F.col("id") == F.col("labelled")) & (F.col("key") == F.col("own"))).select("text", "label")

    def count(batches):
        reader, n = Reader(characters.value), 1 + len(BEGINNINGS)
        for batch in text_slices(batches, 0):
            labels = np.array(batch.column(1).to_pylist()) > 0
            each, shorter, toxic = [np.zeros(1, np.int64)], [np.zeros((1, n - 1), np.int64)], [np.zeros(1, np.int64)]
            for text, label in zip(batch.column(0).to_pylist(), labels):
                words = reader.features(text)
                found, first = np.unique(words, return_index=True)
                each.append(found)
                shorter.append(np.where(np.arange(1, n) > first[:, None] % n, words[first // n, 1:], 0))
                toxic.append(np.full(len(found), label, np.int64))
            found, first, which = np.unique(np.concatenate(each), return_index=True, return_inverse=True)
            rows, bad = np.bincount(which), np.bincount(which, np.concatenate(toxic)).astype(np.int64)
            # 0 is no feature; it stands for all rows.
            rows[found == 0], bad[found == 0] = len(labels), labels.sum()
            shorter = np.concatenate(shorter)[first]
            shorter[found == 0] = 0
            yield pa.RecordBatch.from_arrays([pa.array(found), *(pa.array(shorter[:, i]) for i in range(n - 1)), pa.array(bad), pa.array(rows - bad)],
                                             names=["feature", *parents, "toxic", "other"])

    parents = [f"p{n}" for n in BEGINNINGS]
    types = ", ".join(f"{c} bigint" for c in ["feature", *parents, "toxic", "other"])
    counts = materialize(rows.mapInArrow(count, types).groupBy("feature", *parents).agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "features")
    total = counts.filter("feature = 0").first()
    toxics, others = (total["toxic"], total["other"]) if total else (0, 0)
    share = float(toxics / max(1.0, toxics + others))
    if not 0 < share < 1:
        return Model(characters, sc.broadcast((np.zeros(0, np.int64), np.zeros(0))), share)
    counts = counts.filter("feature <> 0")
    # Odds in excess of the overall odds, with SHRINK rows of the overall share added. A feature counts if its excess is significant
    # among as many features as were seen: the likelihood ratio of its own share exceeds their number.
    toxic, other = F.col("toxic"), F.col("other")
    rate = (toxic + SHRINK * share) / (toxic + other + SHRINK)
    own = toxic / (toxic + other)
    ratio = F.when(toxic > 0, toxic * F.log(own / share)).otherwise(0.0) + F.when(other > 0, other * F.log((1 - own) / (1 - share))).otherwise(0.0)
    excess = F.log(rate / (1 - rate)) - float(np.log(share / (1 - share)))
    telling = counts.filter((own > share) & (ratio > float(np.log(max(2, counts.count())))) & (rate > LEAST_RATE) & (excess > 0))
    telling = materialize(telling.select("feature", "toxic", "other", excess.alias("weight")), "telling")
    # Words that stand in the same few toxic rows as a well-known one are its company: each toxic row is credited to the feature that is in most
    # of them, and features with little credit are unknown.

    def company(batches):
        reader = Reader(characters.value)
        for batch in text_slices(batches, 1):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, first = reader.found(text)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key)), pa.array(found), pa.array(first)], names=["key", "feature", "at"])

    toxic_rows = rows.filter("label > 0").select(F.xxhash64("text").alias("key"), "text").mapInArrow(company, "key bigint, feature bigint, at bigint")
    credits = toxic_rows.join(broadcast_if_small(telling.select("feature", "toxic"), MOST_WEIGHTS), "feature") \
        .groupBy("key").agg(F.max_by("feature", F.struct("toxic", -F.col("at"))).alias("feature")).groupBy("feature").agg(F.count("*").alias("credit"))
    weighty = telling.filter(toxic + other >= EVIDENCE).join(credits.filter(F.col("credit") >= CREDIT), "feature").select("feature", "weight")
    weighty = materialize(weighty, "weighty")
    few = broadcast_if_small(weighty.select(F.col("feature").alias("shorter")), MOST_WEIGHTS)
    plain = counts.filter(toxic + other >= EVIDENCE).join(broadcast_if_small(telling.select("feature"), MOST_WEIGHTS), "feature", "left_anti") \
        .select("feature", F.explode(F.array(*parents)).alias("shorter")).join(few, "shorter", "left_semi").select("feature").distinct()
    weights = materialize(weighty.unionByName(plain.withColumn("weight", F.lit(0.0))), "weights")
    if weights.count() > MOST_WEIGHTS:
        return Model(characters, weights, share)
    held = weights.orderBy("feature").toArrow()
    return Model(characters, sc.broadcast((held.column("feature").to_numpy(), held.column("weight").to_numpy())), share)


def strength(documents: DataFrame, model: Model, text_col: str) -> DataFrame:
    """(h1, h2, strong): the weights of the strongest words by the text's hashes, where a text has any; for more weights than are sent to all executors."""
    characters = model.characters

    def words(batches):
        reader = Reader(characters.value)
        for batch in text_slices(batches, 0):
            for text, h1, h2 in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.unique(reader.features(text), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), h1)), pa.array(np.full(len(found), h2)), pa.array(range(len(found)), pa.int32()),
                                                  pa.array(found.tolist(), pa.list_(pa.int64()))], names=["h1", "h2", "word", "features"])

    rows = documents.select(F.col(text_col).alias("text"), *text_key(F.col(text_col))).filter("text IS NOT NULL").dropDuplicates(["h1", "h2"])
    each = rows.mapInArrow(words, "h1 bigint, h2 bigint, word int, features array<bigint>").select("h1", "h2", "word", F.posexplode("features").alias("at", "feature"))
    judged = each.filter("feature <> 0").join(model.weights, "feature").groupBy("h1", "h2", "word").agg(F.min_by("weight", "at").alias("weight"))
    top = F.slice(F.sort_array(F.collect_set("weight"), asc=False), 1, STRONGEST)
    return judged.filter("weight > 0").groupBy("h1", "h2").agg(F.aggregate(top, F.lit(0.0), lambda a, b: a + b).alias("strong"))


def score(documents: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1."""
    kept = [c for c in documents.columns if c != score_col]
    characters, shared, share = model.characters, model.weights, model.share
    base = float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0)
    if isinstance(shared, DataFrame):
        strong = strength(documents, model, text_col).select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("strong").alias("__strong"))
        h1, h2 = text_key(F.col(text_col))
        joined = documents.select(*kept, h1.alias("__k1"), h2.alias("__k2")).join(strong, (F.col("__k1") == F.col("__h1")) & (F.col("__k2") == F.col("__h2")), "left")
        return joined.select(*kept, (1 / (1 + F.exp(-(base + F.coalesce("__strong", F.lit(0.0)))))).alias(score_col))

    def run(batches):
        reader, (kept_features, weights) = Reader(characters.value), shared.value
        for batch in text_slices(batches, text_col):
            words = [reader.words(text) for text in batch.column(text_col).to_pylist()]
            texts = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
            strong = strongest(features_of(list(chain.from_iterable(words))), texts, kept_features, weights, len(words))
            scores = 1.0 / (1.0 + np.exp(-(base + strong))) if share else np.zeros(len(words))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, score_col])

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(score_col, T.DoubleType())])
    return documents.select(*kept).mapInArrow(run, schema)


def restore(documents: DataFrame, model: Model, *, text_col: str = "text", restored_col: str = "restored") -> DataFrame:
    """The documents with the restored text: read words, one space between them."""
    kept = [c for c in documents.columns if c != restored_col]
    characters = model.characters

    def run(batches):
        channel = Channel(characters.value)
        words = Memo(lambda token: " ".join(channel.words(token)))
        for batch in text_slices(batches, text_col):
            texts = [" ".join(filter(None, map(words.__getitem__, (t or "").lower().split()))) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, restored_col])

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(restored_col, T.StringType())])
    return documents.select(*kept).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))
