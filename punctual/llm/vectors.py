"""Near duplicates among embeddings: spherical k-means deals vectors to cells, cells are compared in blocks.

1. Equal vectors become one node, counted while they shuffle, so copies cost one row a task.
2. Spherical k-means is fitted on a bounded sample and every node is assigned by cosine. Its home is the cell
   of the nearest centre. It also visits each cell whose border it is close to: links cross
   borders, and a pair is compared if either of the two visits the home of the other.
3. The members of a cell are compared by blocks of normalised vectors with matrix products, in double
   precision, each pair in one cell only. Pairs are not emitted: a block gives for each member how many it
   is linked with, and to which group. Blocks of a large cell travel as one row each.
4. Links within and across blocks are joined to components; the smallest id of each stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import components, join_counted, written

COSINE = 0.95
#: Vectors that centres are fitted on, vectors of a cell that are aimed at, and centres at most.
SAMPLE, CELL, CELLS = 65_536, 512, 4096
#: Centres nearer to each other than this are one: cells of one dense group would share all their members.
APART = 0.8
ROUNDS = 8
#: How far from a border a vector visits the other side, in deviations of a random direction. See ``margin``.
REACH = 4.0
#: Members of a block, and rows of a block that are multiplied at once.
BLOCK, TILE = 4096, 512
MEMBER = "dim int, cell int, block int, node long, copies long, home int, visits array<int>, vec array<double>"
LINKS = "node long, links long, root long"


def margin(dim: int, cosine: float = COSINE, reach: float | None = REACH) -> float:
    """How near a border, seen from its home, a vector visits the cell behind it.

    Two unit vectors of this cosine are ``sqrt(2 - 2 * cosine)`` apart. Along the line between two centres they differ
    by that at most, and one of the two is within half of it of the border: with ``reach`` None this bound holds and
    no pair is missed. A difference in a random direction has a deviation of ``1 / sqrt(dim)`` of its
    length along any line; ``reach`` deviations miss fewer than one such pair in ten thousand.
    """
    apart = math.sqrt(max(0.0, 2 - 2 * cosine))
    share = 1.0 if reach is None else min(1.0, reach / math.sqrt(dim))
    return apart * share / 2


def normalised(vectors: list) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS, apart: float = APART) -> np.ndarray:
    """Up to ``k`` centres of length 1 for the rows of ``x``, by cosine; none nearer to another than ``apart``."""
    random = np.random.default_rng(k)
    centres = x[np.sort(random.permutation(len(x))[:k])]
    for _ in range(rounds):
        own = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        order = np.argsort(own, kind="stable")
        found, starts = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(x[order], starts, axis=0)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        good = size[:, 0] > 1e-9
        centres = centres.copy()
        centres[found[good]] = sums[good] / size[good]
    kept: list[int] = []
    for i, near in enumerate(centres @ centres.T >= apart):
        if not near[kept].any():
            kept.append(i)
    return centres[kept]


def cells_of(x: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The home cell of each row of ``x``, and the other cells that it visits."""
    score = x @ centres.T
    home = score.argmax(axis=1)
    gap = score[np.arange(len(x)), home][:, None] - score
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * centres[home] @ centres.T))
    near = gap <= reach * apart
    near[np.arange(len(x)), home] = False
    return home.astype(np.int32), [np.flatnonzero(row).astype(np.int32) for row in near]


class Members:
    """Members of one block of a cell as arrays."""

    def __init__(self, rows: pd.DataFrame):
        self.node, self.copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        self.home, self.visits = rows["home"].to_numpy(), list(rows["visits"])
        self.x = normalised(list(rows["vec"]))

    def packed(self) -> dict:
        flat = np.concatenate([*self.visits, np.empty(0, np.int32)]).astype(np.int32)
        return {
            "nodes": self.node.tobytes(), "copies": self.copies.tobytes(), "homes": self.home.tobytes(),
            "counts": np.array([len(v) for v in self.visits], np.int32).tobytes(), "visits": flat.tobytes(), "x": self.x.tobytes(),
        }

    @classmethod
    def unpacked(cls, row) -> Members:
        out = cls.__new__(cls)
        out.node, out.copies = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64)
        out.home = np.frombuffer(row["homes"], np.int32)
        ends = np.cumsum(np.frombuffer(row["counts"], np.int32))
        out.visits = np.split(np.frombuffer(row["visits"], np.int32), ends[:-1])
        out.x = np.frombuffer(row["x"], np.float64).reshape(len(out.node), -1)
        return out

    def visit(self, cells: np.ndarray) -> np.ndarray:
        """Which of ``cells`` (sorted) each member visits."""
        out = np.zeros((len(self.node), len(cells)), bool)
        owner = np.repeat(np.arange(len(self.node)), [len(v) for v in self.visits])
        flat = np.concatenate([*self.visits, np.empty(0, np.int32)]).astype(np.int64)
        at = np.minimum(np.searchsorted(cells, flat), len(cells) - 1)
        known = cells[at] == flat
        out[owner[known], at[known]] = True
        return out


def compared(left: Members, right: Members, cell: int, cosine: float = COSINE) -> pd.DataFrame:
    """(node, links, root) of the members that this pair of blocks (or one block with itself) links.

    A pair counts if one of the two is at home in ``cell``. If the other lives elsewhere and the pair
    also meets there, it counts in the lower of the two cells.
    """
    same = right is left
    homes = np.unique(np.concatenate([left.home, right.home]))
    lower = homes < cell
    col_l, col_r = np.searchsorted(homes, left.home), np.searchsorted(homes, right.home)
    twice_l, twice_r = left.visit(homes) & lower, right.visit(homes) & lower
    in_l, in_r = left.home == cell, right.home == cell
    met = np.zeros((len(left.node), len(right.node)), bool)
    for i in range(0, len(left.node), TILE):
        part = slice(i, min(i + TILE, len(left.node)))
        linked = left.x[part] @ right.x.T >= cosine
        if same:
            linked[np.arange(part.stop - i), np.arange(i, part.stop)] = False
        if linked.any():
            a, b = in_l[part][:, None], in_r[None]
            linked &= (a & b) | (a & ~b & ~twice_l[part][:, col_r]) | (~a & b & ~twice_r[:, col_l[part]].T)
            met[part] = linked
    rows, cols = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
    if not len(rows):
        return pd.DataFrame({"node": [], "links": [], "root": []})
    met = met[np.ix_(rows, cols)]
    links = met @ right.copies[cols]
    nodes = left.node[rows]
    if not same:
        links = np.concatenate([links, left.copies[rows] @ met])
        nodes = np.concatenate([nodes, right.node[cols]])
    return pd.DataFrame({"node": nodes, "links": links, "root": nodes[_roots(met, same)]})


def _roots(met: np.ndarray, same: bool) -> np.ndarray:
    """For the rows, and the columns after them unless they are the same, the first position they are connected with."""
    n = len(met)
    label = np.arange(n if same else n + met.shape[1])
    while True:
        rows, cols = label[:n], label if same else label[n:]
        new_rows, new_cols = rows.copy(), cols.copy()
        for i in range(0, n, TILE):
            part = met[i : i + TILE]
            new_rows[i : i + TILE] = np.minimum(rows[i : i + TILE], np.where(part, cols, len(label)).min(axis=1))
            new_cols = np.minimum(new_cols, np.where(part, rows[i : i + TILE, None], len(label)).min(axis=0))
        new = np.minimum(new_rows, new_cols) if same else np.concatenate([new_rows, new_cols])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def usable(vec: str | Column) -> Column:
    """Whether a vector has a direction: not null, without null, NaN or infinite components, and not zero."""
    v = (F.col(vec) if isinstance(vec, str) else vec).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def centres(nodes: DataFrame, sample: int = SAMPLE, cell: int = CELL, most: int = CELLS) -> dict[int, np.ndarray]:
    """Centres for each length of vector, from the rows of ``nodes`` (dim, key, vec) with the smallest share of hashes.

    The sample and the number of centres are bounded, so a task fits them and the driver hands them out.
    """
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(sample).collect()}
    n = sum(sizes.values())
    share = F.lit(int(min(1.0, sample / max(n, 1)) * (1 << 30)))
    some = nodes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        dim = int(part["dim"].iloc[0])
        k = min(most, math.ceil(sizes[dim] / cell), max(1, len(part) // 8))
        found = spherical_means(normalised(list(part["vec"])), k)
        return pd.DataFrame({"dim": dim, "no": np.arange(len(found)), "centre": [c.tobytes() for c in found]})

    fitted = some.where(F.col("dim").isin(list(sizes))).groupBy("dim").applyInPandas(fit, "dim int, no int, centre binary")
    rows = sorted(((r["dim"], r["no"], bytes(r["centre"])) for r in fitted.collect()), key=lambda r: r[:2])
    out: dict[int, list] = {}
    for dim, _, centre in rows:
        out.setdefault(dim, []).append(np.frombuffer(centre))
    return {dim: np.stack(found) for dim, found in out.items()}


def _members(nodes: DataFrame, model: dict[int, np.ndarray], cosine: float, reach: float | None, block: int) -> DataFrame:
    """``nodes`` once for each cell that they belong to, as ``MEMBER``, with the number of blocks of the cell."""

    def assign(batches):
        for dims, vecs in batches:
            homes, visits = np.zeros(len(dims), np.int32), [np.empty(0, np.int32)] * len(dims)
            for dim in dims.unique():
                at = np.flatnonzero(dims == dim)
                if dim in model:
                    found = cells_of(normalised(list(vecs.iloc[at])), model[dim], margin(dim, cosine, reach))
                    homes[at] = found[0]
                    for i, v in zip(at, found[1], strict=True):
                        visits[i] = v
            yield pd.DataFrame({"home": homes, "visits": visits})

    assign.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    place = F.pandas_udf(assign, "home int, visits array<int>")("dim", "vec")
    placed = written(nodes.select("node", "copies", "dim", "vec", place.alias("p")).select("node", "copies", "dim", "vec", "p.*"), "placed")
    each = placed.withColumn("cell", F.explode(F.concat(F.array("home"), F.col("visits"))))
    sizes = placed.select("dim", F.explode(F.concat(F.array("home"), F.col("visits"))).alias("cell")).groupBy("dim", "cell").agg(F.count("*").alias("m"))
    # a cell of one member links nothing
    cells = written(sizes.where("m > 1").select("dim", "cell", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "cells")
    return each.join(cells, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def links(nodes: DataFrame, cosine: float = COSINE, reach: float | None = REACH, block: int = BLOCK, **fit) -> DataFrame:
    """(node, links, root) in parts: what each block, or pair of blocks, links. nodes: (node, copies, dim, key, vec)."""
    members = _members(nodes, centres(nodes, **fit), cosine, reach, block)
    columns = [c.split(" ")[0] for c in MEMBER.split(", ")]

    def within(part: pd.DataFrame) -> pd.DataFrame:
        own = Members(part)
        return compared(own, own, int(part["cell"].iloc[0]), cosine)

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        first = part.iloc[0]
        return pd.DataFrame([{"dim": first["dim"], "cell": first["cell"], "block": first["block"], **Members(part).packed()}])

    def across(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        return compared(Members.unpacked(row["l"]), Members.unpacked(row["r"]), int(row["cell"]), cosine)

    parts = members.select(*columns).groupBy("dim", "cell", "block").applyInPandas(within, LINKS)
    large = members.where("blocks > 1")
    body = ["nodes", "copies", "homes", "counts", "visits", "x"]
    kinds = "dim int, cell int, block int, " + ", ".join(f"{c} binary" for c in body)
    packed = written(large.select(*columns).groupBy("dim", "cell", "block").applyInPandas(pack, kinds), "packed_blocks")
    ends = packed.select("dim", "cell", "block")
    counts = ends.groupBy("dim", "cell").agg(F.max("block").alias("last"))
    pairs = counts.withColumn("i", F.explode(F.expr("sequence(0, last - 1)"))).withColumn("j", F.explode(F.expr("sequence(i + 1, last)")))
    blocks = packed.select("dim", "cell", "block", F.struct(*body).alias("body"))
    one = blocks.select("dim", "cell", F.col("block").alias("i"), F.col("body").alias("l"))
    two = blocks.select("dim", "cell", F.col("block").alias("j"), F.col("body").alias("r"))
    met = pairs.drop("last").join(one, ["dim", "cell", "i"]).join(two, ["dim", "cell", "j"])
    return written(parts.unionByName(met.groupBy("dim", "cell", "i", "j").applyInPandas(across, LINKS)), "vector_links")


def joined(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
    reach: float | None = REACH, block: int = BLOCK, **fit,
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is at least ``cosine``. n_links counts the
    others that a vector is linked with, copies included; component_id is the smallest id that links lead to
    (null last), and one row of each component is kept. A vector that is null or zero, or has a null, NaN or infinite
    component, links with nothing; vectors of different lengths are not compared. Repeated rows are vectors of their own.
    Other columns are ignored, whatever their names. ``fit`` goes to ``centres``.
    """
    vec = F.col(vec_col).cast("array<double>")
    text = F.concat_ws(",", F.transform(vec, lambda x: x.cast("string")))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("no"), F.col(id_col).alias("id"),
        F.when(usable(vec_col), F.unhex(F.md5(text.cast("binary")))).alias("key"), vec.alias("vec"),
    )
    rows = written(rows, "vectors")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "no")).alias("first")
    nodes = rows.where("key is not null").groupBy("key").agg(first, F.count("*").alias("copies"), F.any_value("vec").alias("vec"))
    nodes = written(nodes.select("key", "first", F.col("first.no").alias("node"), "copies", F.size("vec").alias("dim"), "vec"), "nodes")
    found = links(nodes, cosine, reach, block, **fit)
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector_groups")
    labelled = nodes.drop("vec").join(total, "node", "left").join(tied, "node", "left").where("copies > 1 or links is not null")
    labelled = written(labelled.withColumn("root", F.coalesce("root", "node")), "linked_vectors")
    least = written(labelled.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("times")), "vector_classes")
    labels = join_counted(labelled, least, "root", "times", labelled.count()).select(
        "key", "least", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    labels = written(labels, "vector_labels")
    out = join_counted(rows.drop("vec"), labels, "key", "copies", rows.count())
    alone = F.col("least").isNull()
    return out.select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col("least.no") == F.col("no"))).alias("kept"),
    )
