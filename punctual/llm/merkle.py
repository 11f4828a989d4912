"""Merkle manifest of a dataset: hash trees stored in blocks, each block in van Emde Boas order.

A row's leaf is the hash of its columns. The leaves of a group, in the order of an id, are the bottom of a
binary tree; the groups' roots, in the order of the group, are the bottom of one more tree, whose root
stands for the whole dataset. A last node without a neighbour is hashed alone.

A tree is cut into aligned blocks of ``2 ** HEIGHT`` leaves, one row of a table each. The roots of the blocks
are the leaves of the next tier of blocks, until one block holds what is left. Within a block
the nodes lie in van Emde Boas order: the upper half of the levels first, then each subtree below it,
every part laid out by the same rule. So a walk from a leaf to the root of a block touches few
neighbouring runs of bytes whatever the size of a cache line, and a node is found by arithmetic alone.

Leaves are numbered by one range shuffle of narrow rows (id, group, digest); texts are read once, where
they lie. A task handles a block at a time. Proofs go down the tiers: the path above a block is found once per
block, and its leaves add the siblings within it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import written

#: Levels of edges in a block: it has up to 4,096 leaves and fills 256 kB.
HEIGHT = 12
DIGEST = 32
BLOCK = "named boolean, name string, block long, n long, levels int, nodes binary, root binary"
KEY = ["named", "name", "block"]


def _top() -> tuple[Column, Column]:
    """The tree over the groups' roots is a group of its own."""
    return F.lit(True).alias("named"), F.lit("").alias("name")


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of a row as lowercase hex: each value as `-` if null, else byte count, `:` and the value."""
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def node_hash(children: Sequence[bytes]) -> bytes:
    """Hash of a node from the digests of its children, which go in as lowercase hex."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def address(depth: int, index: int, levels: int) -> int:
    """Where node ``index`` of a depth lies in a tree of so many levels, the root being depth 0."""
    start = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        bottom, depth = levels - top, depth - top
        subtree, index = index >> depth, index & ((1 << depth) - 1)
        start += (1 << top) - 1 + subtree * ((1 << bottom) - 1)
        levels = bottom
    return start


@lru_cache(maxsize=64)
def addresses(depth: int, levels: int) -> np.ndarray:
    """``address`` of all nodes of a depth; at most as many as a block has leaves."""
    return np.array([address(depth, i, levels) for i in range(1 << depth)])


def lay_out(out: np.ndarray, start: int, levels: int, leaves: list[bytes]) -> bytes:
    """Write the tree over ``leaves``, of ``levels`` levels, to ``out`` from row ``start`` on; its root.

    The lower subtrees come first, each into its own run of rows. The hashes of pairs of
    their roots are the leaves of the upper half.
    """
    if levels == 1:
        out[start] = np.frombuffer(leaves[0], np.uint8)
        return leaves[0]
    top = levels // 2
    bottom = levels - top
    width, run = 1 << (bottom - 1), (1 << bottom) - 1
    begin = start + (1 << top) - 1
    roots = [
        lay_out(out, begin + i // width * run, bottom, leaves[i : i + width]) for i in range(0, len(leaves), width)
    ]
    return lay_out(out, start, top, [node_hash(roots[i : i + 2]) for i in range(0, len(roots), 2)])


def siblings(nodes: bytes, n: int, levels: int, at: int) -> list[tuple[bool, bytes | None]]:
    """For leaf ``at`` of a block, from below: whether the node is a left one, and its sibling if it has one."""
    found = []
    for depth in range(levels - 1, 0, -1):
        other = at ^ 1
        here = int(addresses(depth, levels)[other]) * DIGEST if other < n else None
        found.append((at & 1 == 0, None if here is None else nodes[here : here + DIGEST]))
        at, n = at >> 1, (n + 1) >> 1
    return found


def packed(path: list[tuple[bool, bytes | None]]) -> bytes:
    """A path as bytes: per level a mark (0 alone, 1 sibling to the right, 2 to the left) and the sibling."""
    return b"".join(b"\0" if s is None else (b"\1" if left else b"\2") + s for left, s in path)


def folded(leaf: bytes, path: bytes) -> tuple[bytes, bytes]:
    """The root that ``leaf`` leads to along a packed path, and the siblings on it as hex text."""
    at, met = 0, []
    while at < len(path):
        mark, at = path[at], at + 1
        if mark:
            sibling, at = path[at : at + DIGEST], at + DIGEST
            met.append(sibling.hex())
            leaf = node_hash([leaf, sibling] if mark == 1 else [sibling, leaf])
        else:
            leaf = node_hash([leaf])
    return leaf, "".join(met).encode()


@dataclass
class Manifest:
    """``leaves`` (id, group, digest, ..., named, name, pos) and the tiers of blocks, lowest first.

    ``tiers`` belong to the trees of the groups, ``upper`` to the tree over the groups' roots, ``roots``
    are (named, name, pos, root) of the groups, ``root`` is the root of all (None of an empty table).
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    roots: DataFrame
    upper: list[DataFrame]
    root: bytes | None
    height: int


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (named, name, ...) with their position ``pos`` in their group, counted from 0.

    One range shuffle sorts the rows. A range numbers its own rows; what lies before it in the same
    group is added by a join with the counts of the ranges. Rows that are equal in ``order`` must be
    told apart by its last column, so that no range gets all of them.
    """
    spark = rows.sparkSession
    keys = ["named", "name", *order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    cut = written(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    cut = cut.withColumn("range_no", F.shiftright("at", 33))
    counts = cut.groupBy("named", "name", "range_no").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("named", "name").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = cut.join(starts, ["named", "name", "range_no"])
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("start")).drop("at", "range_no", "first", "start")


def _blocks(leaves: DataFrame, height: int, name: str) -> DataFrame:
    """One tier: the blocks over ``leaves`` (named, name, pos, digest, size), size being that of the group."""

    def block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n, size = len(part), int(part["size"].iloc[0])
        # the only block of a group ends at its root, any other is as high as all
        levels = (size - 1).bit_length() + 1 if size <= 1 << height else height + 1
        out = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
        root = lay_out(out, 0, levels, list(part["digest"]))
        first = part.iloc[0]
        return pd.DataFrame([(first["named"], first["name"], first["block"], n, levels, out.tobytes(), root)], columns=names)

    names = [c.split(" ")[0] for c in BLOCK.split(", ")]
    rows = leaves.select("named", "name", F.shiftright("pos", height).alias("block"), "pos", "digest", "size")
    return written(rows.groupBy(*KEY).applyInPandas(block, BLOCK), name)


def _tiers(leaves: DataFrame, height: int, name: str) -> list[DataFrame]:
    """All tiers over ``leaves`` (named, name, pos, digest), lowest first. A group that has come
    down to one block takes no part in the tiers above."""
    sizes = leaves.groupBy("named", "name").agg(F.count("*").alias("size"))
    sizes = written(sizes, f"{name}_sizes")
    largest = sizes.agg(F.max("size")).first()[0] or 0
    found, now, shift = [], leaves.select("named", "name", "pos", "digest"), 0
    while not found or largest > 1 << shift:
        left = F.ceil(F.col("size") / F.lit(1 << shift).cast("double")).cast("long")
        known = sizes.where(F.lit(not shift) | (F.col("size") > 1 << shift)).select("named", "name", left.alias("size"))
        found.append(_blocks(now.join(known, ["named", "name"]), height, f"{name}_{len(found)}"))
        now = found[-1].select("named", "name", F.col("block").alias("pos"), F.col("root").alias("digest"))
        shift += height
    return found


def _alone(tier: DataFrame) -> DataFrame:
    """(named, name) of the groups with one block in this tier: theirs is the highest one."""
    return tier.groupBy("named", "name").agg(F.count("*").alias("n"), F.first("root").alias("root")).where("n = 1").drop("n")


def manifest(
    docs: DataFrame, columns: Sequence[str], group_col: str, id_col: str, extra: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> Manifest:
    """The hash trees of ``docs`` over the given columns, one per value of ``group_col``, and the tree over them.

    Leaves ascend by id, a null id first; rows that share an id stand in the order of their hashes.
    Groups ascend bytewise, null first and apart from the empty text. A null value hashes as `-`. Other
    columns are ignored, whatever their names. ``extra`` names further values that the leaves carry.
    """
    group = F.col(group_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), group.alias("group"), F.unhex(row_hash(columns)).alias("digest"),
        *[c.alias(n) for n, c in (extra or {}).items()],
        group.isNotNull().alias("named"), F.coalesce(group, F.lit("")).alias("name"),
        F.monotonically_increasing_id().alias("no"),
    )
    leaves = written(numbered(written(rows, "leaf_rows"), ["id", "digest", "no"], "leaf_order").drop("no"), "leaves")
    tiers = _tiers(leaves, height, "tier")
    tops = written(reduce(DataFrame.unionByName, [_alone(t) for t in tiers]), "group_roots")
    named = tops.select(*_top(), F.struct("named", "name").alias("of"), "root")
    roots = written(numbered(named, ["of"], "root_order"), "roots")
    upper = _tiers(roots.withColumnRenamed("root", "digest"), height, "upper")
    top = upper[-1].select("root").first()
    roots = roots.select("of.*", "pos", "root")
    return Manifest(leaves, tiers, roots, upper, None if top is None else bytes(top[0]), height)


def _above(tiers: list[DataFrame], ends: DataFrame, height: int, name: str) -> DataFrame:
    """The packed path above every block of the lowest tier: (named, name, block, above).

    ends: (named, name, path) above the roots of the groups.
    """

    def down(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        n, first = int(row["n"]), int(row["block"]) << height
        paths = [packed(siblings(row["nodes"], n, row["levels"], i)) + row["above"] for i in range(n)]
        return pd.DataFrame({"named": row["named"], "name": row["name"], "block": np.arange(first, first + n), "above": paths})

    above = None
    for step, tier in enumerate(reversed(tiers)):
        tops = _alone(tier).join(ends, ["named", "name"])
        start = tops.select("named", "name", F.lit(0).cast("long").alias("block"), F.col("path").alias("above"))
        if above is not None:
            # a group is one block, so that a task holds one at a time
            start = start.unionByName(above.groupBy(*KEY).applyInPandas(down, "named boolean, name string, block long, above binary"))
        paths = written(start, f"{name}_{step}")
        above = tier.join(paths, KEY).select(*KEY, "n", "levels", "nodes", "above")
    return above


def proofs(made: Manifest, changed: str | None = None) -> DataFrame:
    """One row per leaf: id, group, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proof of a leaf is its siblings, read from the blocks level by level up to the root of all, left to
    right. folded_root is recomputed along it from the leaf, or from the digest in the column ``changed`` of the
    leaves where that is not null. verified says if it equals the root. All digests are lowercase hex.
    """
    root, height = made.root, made.height
    block = F.shiftright("pos", height).alias("block")

    def of_groups(roots: pa.Table, blocks: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        first = row["block"] << height
        paths = [packed(siblings(row["nodes"], row["n"], row["levels"], p - first)) + row["above"] for p in roots["pos"].to_pylist()]
        return pa.table([roots["a"], roots["b"], pa.array(paths, pa.binary())], names=["a", "b", "path"])

    start = made.upper[-1].select("named", "name", F.lit(b"").alias("path"))
    uppers = _above(made.upper, start, height, "upper_path")
    tops = made.roots.select(*_top(), block, "pos", F.col("named").alias("a"), F.col("name").alias("b"))
    ends = tops.groupBy(*KEY).cogroup(uppers.groupBy(*KEY)).applyInArrow(of_groups, "a boolean, b string, path binary")
    ends = written(ends.select(F.col("a").alias("named"), F.col("b").alias("name"), "path"), "group_paths")
    lower = _above(made.tiers, ends, height, "path")
    lower = lower.join(made.roots.select("named", "name", F.col("root").alias("subroot")), ["named", "name"])
    out = T.StructType([made.leaves.schema["id"], made.leaves.schema["group"]])
    for column in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        out = out.add(column, "string")
    out = out.add("verified", "boolean")

    def of_leaves(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        nodes, n, levels, first = row["nodes"], row["n"], row["levels"], row["block"] << height
        digests, sums, ends = leaves["digest"].to_pylist(), [], []
        for leaf, other, pos in zip(digests, leaves["changed"].to_pylist(), leaves["pos"].to_pylist(), strict=True):
            end, met = folded(leaf if other is None else other, packed(siblings(nodes, n, levels, pos - first)) + row["above"])
            sums.append(hashlib.sha256(met).hexdigest())
            ends.append(end)
        rows = len(digests)
        texts = [[d.hex() for d in digests], [row["subroot"].hex()] * rows, [root.hex()] * rows, sums, [e.hex() for e in ends]]
        columns = [leaves["id"], leaves["group"], *[pa.array(t, pa.string()) for t in texts], pa.array([e == root for e in ends])]
        return pa.table(columns, names=out.names)

    other = F.lit(None).cast("binary") if changed is None else F.col(changed)
    leaves = made.leaves.select("named", "name", block, "pos", "id", "group", "digest", other.alias("changed"))
    return leaves.groupBy(*KEY).cogroup(lower.groupBy(*KEY)).applyInArrow(of_leaves, out)
