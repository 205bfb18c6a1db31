"""Merkle trees over a dataset: one tree per value of a column, and a tree over their roots.

Leaves are numbered within their tree by a range sort and counted parts. A superblock is a run of
``2**bits`` consecutive nodes that starts at a multiple of it; its subtree is reduced in one group,
and the superblocks' roots are the next table of nodes, until each tree has one node. The way back
exchanges subtrees: the nodes of each table and the outer nodes that their superblock needs (the
siblings from its root up to the root of all) are cogrouped by superblock; the group reduces its
subtree again, joins local and outer siblings to proofs, and folds what is to be verified. Each
group holds one superblock and one row of outer nodes, whatever the tables hold.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import Staged

#: Levels of a superblock, by default: it has 4,096 nodes.
BITS = 12

#: Hexadecimal digits of a node.
DIGITS = 64


def digest(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def leaf(columns: list[Column | str]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and its text, or ``-`` for null."""
    texts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [c.cast("string") for c in texts]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def layers(nodes: list[str], steps: int) -> list[list[str]]:
    """``nodes`` and the ``steps`` layers above them; a last node without a partner is hashed alone."""
    found = [nodes]
    for _ in range(steps):
        below = found[-1]
        found.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return found


def path(found: list[list[str]], at: int) -> tuple[str, str]:
    """Siblings of node ``at`` on its way through the layers, joined, and the side each is on.

    A side is ``l`` or ``r``, or ``-`` where the node has no sibling.
    """
    siblings, sides = [], []
    for layer in found[:-1]:
        other = at ^ 1
        if other < len(layer):
            siblings.append(layer[other])
            sides.append("l" if other < at else "r")
        else:
            sides.append("-")
        at >>= 1
    return "".join(siblings), "".join(sides)


def fold(node: str, siblings: str, sides: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        sibling = siblings[at : at + DIGITS]
        at += DIGITS
        node = digest(sibling + node if side == "l" else node + sibling)
    return node


def _steps(total: int, bits: int) -> int:
    """Layers that one superblock of a tree with ``total`` nodes adds."""
    return min(bits, (total - 1).bit_length())


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, Staged]:
    """``rows`` with ``pos`` within their ``tree`` by ``order``, and the ``total`` of the tree.

    Equal rows are told apart by where they come from, so that many of them fill several parts.
    """
    told = rows.withColumn("told", F.monotonically_increasing_id())
    keys = ["tree", *order, "told"]
    parts = told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("told")
    # numbers that grow through each part and from part to part
    parts = parts.withColumn("at", F.monotonically_increasing_id())
    held = Staged(parts.withColumn("part", F.shiftright("at", 33)), "merkle-numbered", "zstd")
    counts = held.df.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    within = Window.partitionBy("tree")
    before = F.sum("n").over(within.orderBy("part")) - F.col("n")
    counts = counts.select("tree", "part", "first", before.alias("before"), F.sum("n").over(within).alias("total"))
    found = held.df.join(counts, ["tree", "part"])
    pos = (F.col("at") - F.col("first") + F.col("before")).alias("pos")
    kept = [c for c in held.df.columns if c not in ("tree", "part", "at")]
    return found.select("tree", pos, "total", *kept), held


def _by_block(nodes: DataFrame, bits: int, *carried: str):
    columns = [F.shiftright("pos", bits).alias("block"), "pos", "total", "node", *carried]
    return nodes.select("tree", *columns).groupBy("tree", "block")


def _climb(nodes: DataFrame, bits: int) -> list[Staged]:
    """Tables of nodes above ``nodes`` (tree, pos, total, node); the last has one node a tree."""

    def reduce(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, block = key
        total = int(group["total"].iloc[0])
        top = layers(group.sort_values("pos")["node"].tolist(), _steps(total, bits))[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [block], "total": [-(-total >> bits)], "node": [top]})

    found: list[Staged] = []
    while True:
        above = _by_block(nodes, bits).applyInPandas(reduce, "tree string, pos bigint, total bigint, node string")
        found.append(Staged(above, "merkle-nodes"))
        nodes = found[-1].df
        if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
            return found


RETURNED = "tree pos leaf subroot root siblings sides folded_root verified".split()

OUTER = "siblings string, sides string, subroot string, root string"


def _exchange(nodes: DataFrame, outer: DataFrame, bits: int, carried: str = "", kinds: str = "") -> DataFrame:
    """Proofs of ``nodes`` (tree, pos, total, node and ``carried``) from the outer nodes of their blocks.

    ``outer`` has (tree, pos, siblings, sides, subroot, root) with one row for each superblock. Where
    ``presented`` is carried, it is folded along the proof into ``folded_root``.
    """
    carry = carried.split()
    folds = "presented" in carry

    def join(key: tuple, local: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        local = local.sort_values("pos")
        ahead = above.iloc[0]
        found = layers(local["node"].tolist(), _steps(int(local["total"].iloc[0]), bits))
        proofs = [path(found, at) for at in range(len(local))]
        out = local[["tree", "pos", *carry]].copy()
        out["siblings"] = [siblings + ahead["siblings"] for siblings, _ in proofs]
        out["sides"] = [sides + ahead["sides"] for _, sides in proofs]
        out["subroot"], out["root"] = ahead["subroot"], ahead["root"]
        if folds:
            # the way above the superblock's root is the same for all that reach it
            reached: dict[str, str] = {}
            folded = []
            for node, (siblings, sides) in zip(local["presented"], proofs):
                top = fold(node, siblings, sides)
                if top not in reached:
                    reached[top] = fold(top, ahead["siblings"], ahead["sides"])
                folded.append(reached[top])
            out["folded_root"] = folded
        return out

    schema = f"tree string, pos bigint, {kinds}{', ' if kinds else ''}{OUTER}"
    schema += ", folded_root string" if folds else ""
    above = outer.select("tree", F.col("pos").alias("block"), "siblings", "sides", "subroot", "root")
    return _by_block(nodes, bits, *carry).cogroup(above.groupBy("tree", "block")).applyInPandas(join, schema)


def _descend(levels: list[Staged], outer: DataFrame, bits: int) -> DataFrame:
    """Outer nodes of the superblocks of the lowest table, from those of the highest tables' trees."""
    for level in reversed(levels[:-1]):
        outer = _exchange(level.df, outer, bits)
    return outer


def manifest(
    docs: DataFrame,
    id_column: str,
    tree_column: str,
    columns: list[str],
    presented: Column | None = None,
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its proof and what folding the proof gives.

    Leaves are the digests of ``columns``. Within each value of ``tree_column`` they are ordered by id
    (null first), equal ids by leaf; pairs of nodes are hashed up to one node, the tree's root. The
    roots, by value (null first, then bytewise), are the leaves of one more tree. ``presented`` is the
    leaf of a copy that is to be verified, by default the leaf itself; a null takes the leaf, too.

    Returns id, ``tree`` (the value as text), ``pos``, ``leaf``, ``subroot``, ``root``, ``siblings`` (hex digests from
    leaf to root, joined), ``sides`` (a letter a level, see ``path``), ``folded_root`` and ``verified``. The id
    column may not be called as another of these. A tree of one leaf is the leaf; repeated rows are leaves of
    their own; an empty table gives an empty one. Values of any length, empty ones included, are hashed whole
    where they are read; only digests and ids are shuffled. Other columns are not read.
    """
    if id_column in RETURNED:
        raise ValueError(f"the id column may not be called {id_column}")
    own = leaf([docs[c] for c in columns])
    kind = docs.schema[id_column].dataType.simpleString()
    # a text for each value of the tree that sorts as the value does, and before all others for null
    tree = F.coalesce(F.concat(F.lit("="), docs[tree_column].cast("string")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"),
        docs[id_column].alias("id"),
        own.alias("node"),
        F.coalesce(presented, own).alias("presented") if presented is not None else own.alias("presented"),
    )
    hashed = Staged(rows, "merkle-leaves", "zstd")
    leaves, numbered = _numbered(hashed.df, ["id", "node"])
    hashed.drop()
    levels = _climb(leaves, bits)
    trees = levels[-1].df.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    trees, numbered_trees = _numbered(trees, ["name"])
    above = _climb(trees, bits)
    top = above[-1].df.select(
        "tree", "pos", F.lit("").alias("siblings"), F.lit("").alias("sides"),
        F.lit("").alias("subroot"), F.col("node").alias("root"),
    )
    subroots = trees.withColumn("subnode", F.col("node"))
    roots = _exchange(subroots, _descend(above, top, bits), bits, "name subnode", "name string, subnode string")
    roots = roots.select(
        F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "siblings", "sides",
        F.col("subnode").alias("subroot"), "root",
    )
    outer = Staged(_descend(levels, roots, bits), "merkle-outer")
    for table in [numbered_trees, *above, *levels]:
        table.drop()
    leaves = leaves.withColumn("leaf", F.col("node"))
    found = _exchange(leaves, outer.df, bits, "id leaf presented", f"id {kind}, leaf string, presented string")
    return found.select(
        F.col("id").alias(id_column),
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("tree"),
        "pos", "leaf", "subroot", "root", "siblings", "sides", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
