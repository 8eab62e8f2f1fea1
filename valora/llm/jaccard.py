"""Join of word-shingle sets by Jaccard similarity: universe partition, segment signatures, exact verification.

The shingle universe is hashed into segments. Two sets of similarity ``t`` differ in at most ``H`` shingles, so they agree
on at least one of any ``H + 1`` segments, and one of ``(H + 1) / 2`` segments differs by one shingle at most (pigeonhole).
Sizes are cut into bands no wider than ``1 / t``; sets meet under the scheme of the smaller one's band, so each set is
indexed by the schemes of its own band and the band below. A scheme takes whichever costs less: whole segments, half as many again as needed,
so that each set may leave out its most crowded ones, or fewer segments with one-deletion neighbourhoods.

Exact copies are one node. Signatures held by one node alone are dropped at once. Each other node is first compared with one that is typical
of its groups; what is linked through it needs no further comparison. Only pairs across the components found so far remain: they
meet on signatures that are among the rarest of both, as many as the pigeonhole needs, and where sketches of fixed size do not
already tell them apart they are compared in full. So a large group of near copies costs a comparison each, and no link between different
components is lost. What remains quadratic, in sketches only, are the members of one group that are linked with nothing.

Rows: null and empty texts, and texts of white space, have no shingles and are linked with nothing. Texts of fewer words
than a shingle are one shingle. Rows that repeat an id stay separate rows; a null id is never the smallest. Other columns are ignored
by ``similarity_components`` and kept by ``one_of_each_group``. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from valora.llm.common import broadcast_if_small, components, digest64, Memo, text_slices
from valora.session import materialize, scratch_tables

#: Most nodes (8 bytes each) that are broadcast to pick the texts to be verified.
MOST_NODES = 1_000_000
#: Number of sets for which the cost of a scheme's crowded signatures is weighed against its number of signatures.
COST_SETS = 1_000_000
#: Segments beyond those that the pigeonhole needs, as a share of them.
SPARE = 0.25
#: Signatures that one task groups: each takes some 400 bytes there, many times what Spark's estimate of the shuffle sees. Smaller blocks are packed worse.
TASK_SIGNATURES = 600_000
#: Bits of a sketch.
SKETCH = 1024
#: Odd multipliers; fixed values.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PARITY = np.uint64(0x2545F4914F6CDD1D)
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int, memo: Memo) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; bytes.lower() and bytes.split() know ASCII only, as wanted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    if len(words) < size:
        size = len(words)
        h = h + np.uint64(size)
    total = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        total = mixed(total + h[i: len(h) - size + 1 + i] * np.uint64(PLACES[i % len(PLACES)]))
    return np.unique(total)


class Bands:
    """Size bands and their schemes for a threshold of ``percent`` / 100; ``spare`` segments more for each that is needed."""

    def __init__(self, percent: int, spare: float):
        self.percent, self.spare, self.lows, self.highs, self.schemes = percent, spare, [1], [], {}

    def band(self, n: int) -> int:
        while not self.highs or self.highs[-1] < n:
            self.highs.append(max(self.lows[-1], self.lows[-1] * 100 // self.percent))
            self.lows.append(self.highs[-1] + 1)
        return int(np.searchsorted(self.highs, n))

    def scheme(self, band: int) -> tuple[int, int, bool]:
        if band not in self.schemes:
            self.schemes[band] = self.cheapest(band)
        return self.schemes[band]

    def cheapest(self, band: int) -> tuple[int, int, bool]:
        """(segments, segments that may be left out, whether one-deletion neighbourhoods are indexed); no segments: only equal sets can meet."""
        small = self.highs[band]
        apart = (100 - self.percent) * (small + small * 100 // self.percent) // (100 + self.percent)
        if not apart:
            return 0, 0, False
        spare = int((apart + 1) * self.spare)
        whole = apart + 1 + spare
        empty = -self.lows[band] / whole  # logarithm of the share of sets for which a segment is empty
        chance = lambda k: exp(lgamma(whole + 1) - lgamma(k + 1) - lgamma(whole - k + 1) + k * empty + (whole - k) * log(1 - exp(empty)))
        crowded = exp(empty) * sum(chance(k) for k in range(spare + 1, min(whole, spare + 6) + 1))
        if whole + COST_SETS * crowded > small + apart:
            return (apart + 2) // 2, 0, True
        return whole, spare, False

    def keys(self, s: np.ndarray, band: int) -> np.ndarray:
        if band < 0:
            return np.empty(0, np.uint64)
        segments, _, neighbours = self.scheme(band)
        if not segments:
            return np.empty(0, np.uint64)
        base = np.uint64(digest64(b"%d/%d/%d" % (self.percent, band, segments)))
        place = (mixed(s + base) % np.uint64(segments)).astype(np.int64)
        value = mixed(s ^ base)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, place, value)
        salt = mixed(base + np.arange(1, segments + 1, dtype=np.uint64))
        full = mixed(sums + salt)
        return np.concatenate([full, mixed(sums[place] - value + salt[place])]) if neighbours else full


def signed(arrays: list[np.ndarray]) -> pa.Array:
    lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat))


def node_of(s: np.ndarray) -> int | None:
    return int(mixed(np.add.reduce(mixed(s + np.uint64(7)), keepdims=True) + np.uint64(len(s))).view(np.int64)[0]) if len(s) else None


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Parities of a set's shingles over hash buckets: two sets' sketches differ in no more bits than the sets in shingles."""
    return np.packbits(np.bincount((mixed(s + PARITY) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.uint8) & 1).view(np.uint64)


def signer(size: int, percent: int, spare: float):
    """(id, text) batches to (id, n, node, band, own, below). A task signs equal sets once."""
    def run(batches):
        memo, bands, seen = Memo(digest64), Bands(percent, spare), set()
        for batch in text_slices(batches, 1):
            sets = [shingles(t, size, memo) for t in batch.column(1).to_pylist()]
            nodes, numbers, own, below, none = [node_of(s) for s in sets], [], [], [], np.empty(0, np.uint64)
            for s, node in zip(sets, nodes):
                band = bands.band(len(s)) if len(s) else -1
                numbers.append(band)
                fresh = node is not None and node not in seen
                if fresh:
                    seen.add(node)
                own.append(bands.keys(s, band) if fresh else none)
                below.append(bands.keys(s, band - 1) if fresh else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(numbers, pa.int32()), signed(own), signed(below)],
                names=["id", "n", "node", "band", "own", "below"])
    return run


def lister(size: int, value=lambda s: s, name: str = "shingles"):
    """(text) batches to (node, value of its set), by default the shingles themselves; a task lists equal sets once."""
    def run(batches):
        memo, seen = Memo(digest64), set()
        for batch in text_slices(batches, 0):
            sets = {}
            for text in batch.column(0).to_pylist():
                s = shingles(text, size, memo)
                if len(s) and (node := node_of(s)) not in seen:
                    sets[node] = value(s)
            seen.update(sets)
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), signed(list(sets.values()))], names=["node", name])
    return run


def texts_of(nodes: DataFrame, documents: DataFrame, text_col: str, members: DataFrame) -> DataFrame:
    """(key, text) of one text for each node; other texts of equal hash come along."""
    one = members.join(broadcast_if_small(nodes, MOST_NODES), "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
    return documents.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")) \
        .join(broadcast_if_small(one.select("key").distinct(), MOST_NODES), "key", "left_semi")


def linked(pairs: DataFrame, documents: DataFrame, text_col: str, members: DataFrame, size: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough, by the sets themselves."""
    nodes = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "nodes")
    sets = texts_of(nodes, documents, text_col, members).select("text").mapInArrow(lister(size), "node bigint, shingles array<bigint>")
    sets = materialize(sets.dropDuplicates(["node"]), "sets")
    return pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b") \
        .withColumn("common", F.size(F.array_intersect("x", "y"))) \
        .filter(F.col("common").cast("long") * 100 >= (F.size("x") + F.size("y") - F.col("common")).cast("long") * percent).select("a", "b")


def signature_tasks(signed_docs: DataFrame) -> int:
    """Number of tasks for the signatures, by their count; at most four times Spark's number, so that large inputs do not end in many tiny blocks."""
    held = signed_docs.agg(F.sum(F.size("own") + F.size("below"))).first()[0] or 0
    most = 4 * int(signed_docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(held // TASK_SIGNATURES + 1, most)


def shared_signatures(signed_docs: DataFrame, bands: Bands, longest: int) -> DataFrame:
    """(signature, node, n, cost, asks) of the signatures that several nodes hold. ``asks``: the signature is among the rarest of its node's
    scheme, of which two similar sets must have one in common."""
    # By scheme: how many signatures may be left out.
    spare = F.array(*[F.lit(scheme[1]) for scheme in map(bands.scheme, range(bands.band(max(longest, 1)) + 1))])
    entries = signed_docs.select("node", F.explode(F.array(
        F.struct(F.col("band").alias("scheme"), F.col("n"), F.col("own").alias("signatures")),
        F.struct((F.col("band") - 1).alias("scheme"), F.col("n"), F.col("below").alias("signatures")))).alias("x")) \
        .select("node", (F.col("x.scheme").cast("long") * 2**40 + F.col("x.n")).alias("tag"), F.explode("x.signatures").alias("signature")) \
        .repartition(signature_tasks(signed_docs), "signature")
    # The tag is read here too, although every one is positive: both readers of the entries must have the same columns to share one exchange.
    crowd = entries.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min("tag").alias("tag"), F.count("*").alias("size")) \
        .filter("low <> high AND tag >= 0")
    shared = entries.join(crowd.select("signature", "size"), "signature").dropDuplicates(["signature", "node"])
    shared = shared.withColumn("scheme", F.floor(F.col("tag") / F.lit(2**40)).cast("int")).withColumn("n", F.col("tag") % F.lit(2**40)).drop("tag")
    # Segments that a node shares with none count among its rarest.
    own = Window.partitionBy("node", "scheme")
    return shared.withColumn("cost", F.sum("size").over(own)).withColumn("held", F.count("*").over(own)) \
        .withColumn("rank", F.row_number().over(own.orderBy("size", "signature"))) \
        .select("signature", "node", "n", "cost", (F.col("rank") <= F.col("held") - F.get(spare, F.col("scheme"))).alias("asks"))


def undecided(shared: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``shared``, with ``component``, whose signature's group spans several components."""
    placed = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return placed.join(several.select("signature"), "signature", "left_semi")


def similarity_components(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90) -> DataFrame:
    """(id_col, key, group, n_shingles, component): ``component`` is the smallest id reachable over links of similarity ``percent`` / 100
    or more, the document's own included; ``key`` is a hash of the text, ``group`` a number of the component, null for empty sets."""
    with scratch_tables(documents.sparkSession):
        return materialize(found_components(documents, id_col, text_col, shingle, percent), "similarity", kept=True)


def found_components(documents: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, signs = dict(docs.dtypes)["id"], "n bigint, node bigint, band int, own array<bigint>, below array<bigint>"
    with scratch_tables(documents.sparkSession):
        signed_docs = materialize(docs.select(F.struct("id", F.xxhash64("text").alias("key")).alias("id"), "text").mapInArrow(
            signer(shingle, percent, SPARE), f"id struct<id: {kind}, key: bigint>, {signs}"), "signatures")
        members = materialize(signed_docs.select("id.id", "id.key", "n", "node"), "members", kept=True)
        longest = members.agg(F.max("n")).first()[0] or 0
        shared = materialize(shared_signatures(signed_docs, Bands(percent, SPARE), longest), "shared", kept=True)
    near = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    # What two sketches differ in is a lower bound of what the sets differ in.
    differ = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)
    may_link = lambda p, n, q, m: near(n, m) & (differ(p, q) * (100 + percent) <= (n + m) * (100 - percent))
    nodes = materialize(shared.select("node", "n").distinct(), "nodes")
    sketches = texts_of(nodes.select("node"), documents, text_col, members).select("text").mapInArrow(lister(shingle, sketch_of, "sketch"), "node bigint, sketch array<bigint>")
    sketches = materialize(sketches.dropDuplicates(["node"]).join(nodes, "node"), "sketches")
    # First each node against one other: of the most typical members of its signatures' groups, the one with which it shares most signatures.
    heads = shared.groupBy("signature").agg(F.max(F.struct("cost", "node")).alias("head")).select("signature", F.col("head.node").alias("head"))
    votes = shared.join(heads, "signature").filter(F.col("node") != F.col("head")).groupBy("node", "head").agg(F.count("*").alias("votes"))
    pairs = votes.groupBy("node").agg(F.max(F.struct("votes", "head")).alias("best")).select(F.col("node").alias("a"), F.col("best.head").alias("b"))
    a, b = (sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"{side}_sketch"), F.col("n").alias(f"{side}_n")) for side in ("a", "b"))
    pairs = pairs.join(a, "a").join(b, "b").filter(may_link(F.col("a_sketch"), F.col("a_n"), F.col("b_sketch"), F.col("b_n"))).select("a", "b")
    with scratch_tables(documents.sparkSession):
        links = materialize(linked(materialize(pairs, "pairs"), documents, text_col, members, shingle, percent), "links", kept=True)
    found = components(links)
    # Then all pairs across components: all but a group's largest component meet the group, on signatures that both ask for.
    asking = materialize(undecided(shared, found).filter("asks").select("signature", "node", "component").join(sketches, "node"), "undecided")
    largest = asking.groupBy("signature", "component").count().groupBy("signature").agg(F.max(F.struct("count", "component")).alias("largest"))
    rest = asking.join(largest.select("signature", F.col("largest.component").alias("main")), "signature").filter("component <> main")
    x, y = rest.alias("x"), asking.alias("y")
    across = x.join(y, (F.col("x.signature") == F.col("y.signature")) & (F.col("x.component") != F.col("y.component"))
                    & may_link(F.col("x.sketch"), F.col("x.n"), F.col("y.sketch"), F.col("y.n"))) \
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = linked(materialize(across, "pairs"), documents, text_col, members, shingle, percent)
    found = components(links.union(more))
    whole = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = whole.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("smallest"))
    return whole.withColumnRenamed("component", "group").join(smallest.withColumnRenamed("component", "group"), "group", "left").select(
        F.col("id").alias(id_col), "key", "group", F.col("n").alias("n_shingles"), F.coalesce("smallest", "id").alias("component"))


def one_of_each_group(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without those that are linked to others, but for the one of each group that has the smallest id
    (and of those with that id, the rows of one text); with all columns."""
    with scratch_tables(documents.sparkSession):
        found = similarity_components(documents, id_col=id_col, text_col=text_col, **options).filter("group IS NOT NULL") \
            .select(F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), "key").alias("row"), "group")
        first = found.groupBy("group").agg(F.min("row").alias("first"))
        lost = found.join(first, "group").filter("row <> first").select(F.col("row.id").alias("__lost_id"), F.col("row.key").alias("__lost_key")).distinct()
        lost = broadcast_if_small(materialize(lost, "lost", kept=True), MOST_NODES)
    return documents.join(lost, F.col(id_col).eqNullSafe(F.col("__lost_id")) & (F.xxhash64(text_col) == F.col("__lost_key")), "left_anti")
