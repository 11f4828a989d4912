"""Short hashes that say which data a number was computed on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.session import settle


def content_hash(columns: list[str]) -> Column:
    """Aggregate over all values of all rows that does not depend on their order.

    The sum of 60 bits of the MD5 of each row's values as text, a null being the text ``\\N``.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)"))


def ends(df: DataFrame, ts: str, row_id: str) -> DataFrame:
    """Row count and the first and last id by time; equal times are settled by the id."""
    order = F.struct(ts, row_id)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(row_id, order).alias("first"),
        F.max_by(row_id, order).alias("last"),
    )


def data_fingerprint(
    train: DataFrame,
    test: DataFrame,
    columns: list[str],
    *,
    ts: str = "placed_utc",
    row_id: str = "order_id",
    contents: bool = False,
) -> DataFrame:
    """One row with ``data_sha`` (12 hex digits) of both tables and the feature list.

    It covers the row counts, the sorted column names and the first and last id of each side;
    with ``contents`` also every value of the columns.
    """
    parts = [F.lit(",".join(sorted(columns)))]
    for df in (train, test):
        side = df.transform(ends, ts, row_id).select(F.struct("n", "first", "last").alias("s")).scalar()
        parts += [side["n"].cast("string"), side["first"].cast("string"), side["last"].cast("string")]
        if contents:
            total = df.agg(content_hash([row_id, *sorted(columns)]).alias("h")).scalar()
            parts.append(F.coalesce(total.cast("string"), F.lit("")))
    text = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    one_row = train.sparkSession.range(1)
    return one_row.select(F.substring(F.sha2(text, 256), 1, 12).alias("data_sha"))


# Rows of keys that one leaf covers are found by one range of the key; so many nodes have one node above them.
LEAF_KEYS, FAN = 1 << 12, 64


def hash_tree(df: DataFrame, key: str, columns: list[str], *, leaf_keys: int = LEAF_KEYS, fan: int = FAN) -> list[DataFrame]:
    """Digests of a table by range of an integer key, merged upwards: levels of (node, rows, digest), leaves first.

    A leaf covers ``leaf_keys`` consecutive keys (null keys have a leaf of their own, node null), a node above it
    ``fan`` nodes. Digests are sums over rows, so each level is one aggregation of the one below, and neither the order of the rows
    nor the files they are in matter. The table is read once, for the leaves.
    """
    node = F.floor(F.col(key) / F.lit(leaf_keys)).cast("long")
    leaves = df.groupBy(node.alias("node")).agg(F.count(F.lit(1)).alias("rows"), content_hash([key, *columns]).alias("digest"))
    levels = [settle(leaves)]
    while levels[-1].limit(2).count() > 1:
        above = F.floor(F.col("node") / F.lit(fan)).cast("long")
        ends_ = levels[-1].agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count_if(F.col("node").isNull()).alias("nulls")).first()
        if ends_["a"] is None or (ends_["a"] == ends_["b"] and ends_["nulls"]):
            above = F.lit(0).cast("long")  # a null key beside one node
        levels.append(settle(levels[-1].groupBy(above.alias("node")).agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))))
    return levels


def changed_ranges(
    old: list[DataFrame], new: list[DataFrame], *, leaf_keys: int = LEAF_KEYS, fan: int = FAN
) -> DataFrame:
    """The leaves in which two trees of the same shape parameters differ: low, high (keys, exclusive), old_rows, new_rows.

    Compared from the top down: of each level only the nodes below one that differs are looked at, so equal
    tables are told apart by one row each. Trees of different height are compared from the level that both have.
    """
    top = min(len(old), len(new)) - 1
    suspects = None
    for level in range(top, -1, -1):
        sides = []
        for tree, name in ((old, "old"), (new, "new")):
            nodes = tree[level]
            if suspects is not None:
                above = nodes.withColumn("_above", F.floor(F.col("node") / F.lit(fan)).cast("long"))
                nodes = above.join(suspects, F.coalesce("_above", F.lit(0).cast("long")) == F.coalesce("suspect", F.lit(0).cast("long")), "left_semi").drop("_above")
            sides.append(nodes.select("node", F.col("rows").alias(f"{name}_rows"), F.col("digest").alias(f"{name}_digest")))
        right = sides[1].withColumnRenamed("node", "_node")
        both = sides[0].join(right, F.col("node").eqNullSafe(F.col("_node")), "full")
        differ = both.filter(~(F.col("old_digest").eqNullSafe(F.col("new_digest")) & F.col("old_rows").eqNullSafe(F.col("new_rows"))))
        differ = settle(differ.withColumn("node", F.coalesce("node", "_node")).drop("_node"))
        suspects = differ.select(F.col("node").alias("suspect"))
    return differ.select(
        (F.col("node") * leaf_keys).alias("low"), ((F.col("node") + 1) * leaf_keys).alias("high"),
        F.coalesce("old_rows", F.lit(0).cast("long")).alias("old_rows"), F.coalesce("new_rows", F.lit(0).cast("long")).alias("new_rows"),
    )


def changed_rows(old: DataFrame, new: DataFrame, key: str, ranges: DataFrame, *, most_ranges: int = 1000) -> DataFrame:
    """The rows of the given key ranges that only one of two tables has, with ``change`` removed or added.

    The ranges become a filter on the key, so a scan reads the row groups, of a table sorted by the key the files, that hold
    them. With more than ``most_ranges`` of them one range around all is read.
    """
    found = ranges.limit(most_ranges + 1).collect()
    if len(found) > most_ranges:
        ends_ = ranges.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count_if(F.col("low").isNull()).alias("n")).first()
        found = [ends_, *([{"low": None}] if ends_["n"] else [])]
    inside = F.lit(False)
    for r in found:
        inside = inside | (F.col(key).isNull() if r["low"] is None else (F.col(key) >= r["low"]) & (F.col(key) < r["high"]))
    a, b = old.filter(inside), new.filter(inside).select(*old.columns)
    gone = a.exceptAll(b).withColumn("change", F.lit("removed"))
    return gone.unionByName(b.exceptAll(a).withColumn("change", F.lit("added")))
