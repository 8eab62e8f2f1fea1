"""Merkle manifest of a data set: the root of each group of rows and of all, and for every row a witness that it belongs to that root.

Rows are leaves in the order of their id; every two neighbours become one node, a last lone one too, until one is left. A task reads
an aligned block of ``2 ** BLOCK_LEVELS`` leaves as a stream and appends them one by one to a row of open subtrees, of which no two have one
height. A leaf that is appended holds an empty witness. When a second subtree of a height is complete, the two close to one: the root
of each is added to the witnesses of the other's leaves. So a witness grows with the siblings that complete later, and no block is ever read twice
or held beyond its leaves. What the blocks close to is appended in the same way, a tier above, and so on to the group's root; the
groups' roots are the leaves of the last tree. Last, the witnesses of a block are added to those of its leaves, tier by tier, by joins on
the block's number. Leaves are numbered over a range sort, so a group of any size is many blocks of many tasks.

Rows: a null field counts as ``-`` and any other as its number of UTF-8 bytes, a colon and its text. Null ids come first, and null groups
are one group, which comes first. Rows of equal id are ordered by leaf; equal rows are leaves of their own, and trade places freely. A group of
one row has that row's leaf as its root. An empty table has no root and no rows. Other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from valora.llm.common import numbered
from valora.session import materialize, scratch_tables

#: Height of the subtree that a task builds from one block.
BLOCK_LEVELS = 10
#: One step of a witness per level: the sibling's digest, before or after the node itself, or neither where the node stood alone.
STEP = "struct<before: binary, after: binary>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: str | Column) -> Column:
    """Lower-case hex digest of the fields, in order."""
    return F.sha2(F.concat(*[field(F.col(f) if isinstance(f, str) else f) for f in fields]), 256)


def node(*parts: bytes) -> bytes:
    """Digest over the hex texts of digests."""
    return sha256("".join(p.hex() for p in parts).encode()).digest()


class OpenSubtrees:
    """Subtrees that wait for their sibling, the highest first, each as (height, root, witnesses of its leaves)."""

    def __init__(self):
        self.open: list[tuple[int, bytes, list[list]]] = []

    def append(self, leaf: bytes) -> list:
        """Add a leaf; its witness is extended in place as siblings complete."""
        witness: list = []
        self.open.append((0, leaf, [witness]))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self.close()
        return witness

    def close(self) -> None:
        height, right, late = self.open.pop()
        _, left, early = self.open.pop()
        for witness in early:
            witness.append({"before": None, "after": right})
        for witness in late:
            witness.append({"before": left, "after": None})
        self.open.append((height + 1, node(left, right), early + late))

    def lift(self) -> None:
        """A lone node becomes its own parent's only part."""
        height, root, witnesses = self.open.pop()
        for witness in witnesses:
            witness.append({"before": None, "after": None})
        self.open.append((height + 1, node(root), witnesses))

    def finish(self, height: int) -> bytes:
        """No leaf follows: the root at ``height``. The lowest open subtree is lifted until it meets the next one."""
        while len(self.open) > 1 or self.open[-1][0] < height:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self.close()
            else:
                self.lift()
        return self.open[-1][1]


def witnessed(batches):
    """Rows with (tree, at, size, node), in order: the same rows with their ``witness`` within their block and ``top``, the block's root."""
    pieces, block = [], None
    for batch in batches:
        places = list(zip(batch.column("tree").to_pylist(), (at >> BLOCK_LEVELS for at in batch.column("at").to_pylist())))
        begin = 0
        for end in [*(i for i in range(1, len(places)) if places[i] != places[i - 1]), len(places)]:
            if end > begin and places[begin] != block and pieces:
                yield closed(pieces)
                pieces = []
            if end > begin:
                pieces.append(batch.slice(begin, end - begin))
                block, begin = places[begin], end
    if pieces:
        yield closed(pieces)


def closed(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One block's leaves appended in order."""
    rows = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
    subtrees, size = OpenSubtrees(), rows.column("size")[0].as_py()
    witnesses = [subtrees.append(leaf) for leaf in rows.column("node").to_pylist()]
    top = subtrees.finish(min(BLOCK_LEVELS, (size - 1).bit_length()))
    steps = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(witnesses, steps), pa.array([top] * len(witnesses), pa.binary())],
                                      names=[*rows.schema.names, "witness", "top"])


def tier(nodes: DataFrame) -> DataFrame:
    """Nodes numbered in their trees, with ``size`` of the tree, ``witness`` and ``top``: each block of neighbours goes to one task, which streams them."""
    sizes = materialize(nodes.groupBy(F.col("tree").alias("__tree")).agg((F.max("at") + 1).alias("size")), "sizes")
    sized = nodes.join(sizes, F.col("tree").eqNullSafe(F.col("__tree"))).drop("__tree")
    block = F.shiftright("at", BLOCK_LEVELS)
    ordered = sized.repartition("tree", block).sortWithinPartitions("tree", "at")
    schema = T.StructType([*ordered.schema.fields, *T._parse_datatype_string(f"witness array<{STEP}>, top binary").fields])
    return materialize(ordered.mapInArrow(witnessed, schema), "tier")


def trees(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the nodes with their ``witness``, (tree, root)) of nodes with (tree, at, node), ``at`` numbering each tree's nodes from 0."""
    tiers, wanted = [], [*nodes.columns, "witness"]
    while True:
        tiers.append(tier(nodes))
        tops = tiers[-1].filter(F.col("at") % 2**BLOCK_LEVELS == 0).select("tree", F.shiftright("at", BLOCK_LEVELS).alias("at"), F.col("top").alias("node"))
        if tops.filter("at > 0").isEmpty():
            break
        nodes = tops
    whole = tiers.pop()
    while tiers:
        above = whole.select(F.col("tree").alias("__tree"), F.col("at").alias("__at"), F.col("witness").alias("__above"))
        whole = tiers.pop().join(above, F.col("tree").eqNullSafe(F.col("__tree")) & (F.shiftright("at", BLOCK_LEVELS) == F.col("__at"))) \
            .withColumn("witness", F.concat("witness", "__above"))
    return whole.select(wanted), tops.select("tree", F.col("node").alias("root"))


def hexed(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def folded(leaf: Column, witness: str | Column) -> Column:
    """The root that a leaf (hex) and a witness lead to."""
    side = lambda x: F.coalesce(hexed(x), F.lit(""))
    return F.aggregate(witness, leaf, lambda held, step: F.sha2(F.concat(side(step["before"]), held, side(step["after"])), 256))


def siblings(witness: str | Column) -> Column:
    """The hex digests of a witness's siblings, from the leaf up."""
    return F.filter(F.transform(witness, lambda step: hexed(F.coalesce(step["before"], step["after"]))), lambda x: x.isNotNull())


def manifest(rows: DataFrame, *, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, group, leaf, subroot, root, witness) of every row, hex digests; ``fields`` in order make up the leaf, and the columns of ``carry`` come along.

    ``folded(leaf, witness)`` equals ``root``; a changed leaf or a leaf of another place does not.
    """
    carry = carry or {}
    with scratch_tables(rows.sparkSession):
        leaves = rows.select(F.col(group_col).cast("string").alias("tree"), F.col(id_col).alias("id"), F.unhex(leaf_of(*fields)).alias("node"),
                             *[c.alias(f"carry_{n}") for n, c in carry.items()])
        inner, subroots = trees(numbered(leaves, "tree", ["id", "node"], "at"))
        # The last tree's leaves are the groups, in order of their names' bytes.
        groups, root = trees(numbered(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node")), "tree", ["name"], "at"))
        above = groups.join(F.broadcast(root), "tree").select("name", F.col("node").alias("subroot"), "root", F.col("witness").alias("outer"))
        placed = inner.join(materialize(above, "groups"), F.col("tree").eqNullSafe(F.col("name")))
        return materialize(placed.select(
            F.col("id").alias(id_col), F.col("tree").alias(group_col), hexed("node").alias("leaf"), hexed("subroot").alias("subroot"), hexed("root").alias("root"),
            F.concat("witness", "outer").alias("witness"), *[F.col(f"carry_{n}").alias(n) for n in carry]), "manifest", kept=True)


def verified(leaf: Column, witness: str | Column, root: str | Column) -> Column:
    """Whether the leaf stands where the witness says below that root."""
    return folded(leaf, witness) == root
