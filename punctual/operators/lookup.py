"""Left lookups of a fact table in a keyed table, safe for large tables and for hot keys.

A lookup table is first written out and measured. A table that is proven small is broadcast,
so the facts never move. A larger one is joined by shuffle, with the rows of hot keys spread
over several tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.session import settle_observed

BROADCAST_BYTES = 64 * 1024 * 1024
# A key counts as hot from 1/HOT_SHARE of all rows, so there can be at most HOT_SHARE hot keys.
HOT_SHARE = 1000
SALTS = 64


def _text_bytes(table: DataFrame) -> Column | None:
    lengths = []
    for field in table.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            lengths.append(F.octet_length(field.name))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            lengths.append(F.octet_length(F.to_json(F.struct(field.name))) * 2)
    return sum((F.coalesce(F.sum(c), F.lit(0)) for c in lengths), F.lit(0)) if lengths else None


def size_metrics(table: DataFrame) -> dict[str, Column]:
    """Aggregates from which ``estimated_bytes`` tells the in-memory size of ``table``."""
    text = _text_bytes(table)
    return {"_rows": F.count(F.lit(1)), "_text": F.lit(0) if text is None else text}


def estimated_bytes(table: DataFrame, metrics: dict) -> int:
    return metrics["_rows"] * 16 * (1 + len(table.columns)) + metrics["_text"]


def stored_fits(table: DataFrame, limit: int) -> bool:
    """Whether a table read from files stays below ``limit`` bytes in memory.

    Rows are counted first, which reads no column of a Parquet file; only a table that may
    still fit has its texts measured.
    """
    text = _text_bytes(table)
    size = estimated_bytes(table, {"_rows": table.count(), "_text": 0})
    if size > limit or text is None:
        return size <= limit
    return size + table.agg(text).first()[0] <= limit


def attach(
    facts: DataFrame,
    table: DataFrame,
    on: str | list[str],
    how: str = "left",
    *,
    stored: bool = False,
    size: int | None = None,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with a ``table`` that has one row per ``on``.

    ``stored`` says that ``table`` is read straight from files, so that measuring it is cheap
    and it need not be written out first; ``size`` that it is settled and already measured.
    With ``null_safe`` a null key is a key like any other, as it is in a grouping. Keys of
    different types are compared in their common type, whichever way the join is done.
    """
    on = [on] if isinstance(on, str) else list(on)
    facts, table = _common_keys(facts, table, on)
    if size is not None:
        small = size <= broadcast_bytes
    elif stored:
        small = stored_fits(table, broadcast_bytes)
    else:
        table, metrics = settle_observed(table, size_metrics(table))
        small = estimated_bytes(table, metrics) <= broadcast_bytes
    if small:
        return _joined(facts, F.broadcast(table), on, how, null_safe)
    return salted_join(facts, table, on, how, null_safe=null_safe)


def _common_keys(facts: DataFrame, table: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their keys in one type, so that equal keys have equal hashes."""
    common = facts.select(*on).union(table.select(*on)).schema
    sides = []
    for side in (facts, table):
        casts = {k: F.col(k).cast(common[k].dataType) for k in on if side.schema[k].dataType != common[k].dataType}
        sides.append(side.withColumns(casts) if casts else side)
    return sides[0], sides[1]


def _joined(
    facts: DataFrame, table: DataFrame, on: list[str], how: str, null_safe: bool, also: list[str] | None = None
) -> DataFrame:
    """Join on ``on``; with ``null_safe`` nulls match each other. ``also`` are keys that are never null."""
    also = also or []
    if not null_safe:
        return facts.join(table, [*on, *also], how)
    names = {k: f"_of_{k}" for k in [*on, *also]}
    renamed = table.withColumnsRenamed(names)
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(names[k])) for k in names])
    return facts.join(renamed, match, how).drop(*names.values())


def hot_hashes(facts: DataFrame, on: list[str], share: int = HOT_SHARE) -> list[int]:
    """Hashes of all keys that hold at least ``1/share`` of the rows, and perhaps of a few more.

    One pass with a bounded number of counters per task, merged to at most ``share`` items;
    no key that is hot is ever missed.
    """
    keys = facts.select(F.xxhash64(*on).alias("h"))
    return list(keys.stat.freqItems(["h"], 1.0 / share).first()[0])


def salted_join(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    share: int = HOT_SHARE,
    salts: int = SALTS,
    null_safe: bool = False,
) -> DataFrame:
    """Shuffle join that spreads each hot key of ``facts`` over ``salts`` tasks.

    Only the table rows of hot keys are repeated. The salt comes from the row's content and
    its input partition, so copies of one row spread too and a retried task salts alike.
    """
    facts, table = _common_keys(facts, table, on)
    hot = hot_hashes(facts, on, share)
    if not hot:
        return _joined(facts, table, on, how, null_safe)
    is_hot = F.xxhash64(*on).isin(hot)
    content = [f.name for f in facts.schema if "map<" not in f.dataType.simpleString()]
    scatter = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", F.when(is_hot, scatter).otherwise(F.lit(0)))
    every, first = F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0))
    right = table.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(first)))
    return _joined(left, right, on, how, null_safe, ["_salt"]).drop("_salt")


def lookup_with_default(
    facts: DataFrame,
    profiles: DataFrame,
    on: str | list[str],
    defaults: dict[str, object],
    *,
    flag: str = "used_default_profile",
    stored: bool = False,
) -> DataFrame:
    """Attach profile columns; a key without a profile gets ``defaults`` and is flagged.

    A profile that exists but holds a null keeps its null: only the miss is replaced.
    """
    keys = [on] if isinstance(on, str) else list(on)
    known = profiles.select(*keys, *defaults).withColumn("_known", F.lit(True))
    joined = attach(facts, known, keys, stored=stored)
    missed = F.col("_known").isNull()
    filled: dict[str, Column] = {
        name: F.when(missed, F.lit(value)).otherwise(F.col(name)) for name, value in defaults.items()
    }
    return joined.withColumn(flag, missed).withColumns(filled).drop("_known")


def unseen(rows: DataFrame, known: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key never occurs in ``known``."""
    keys = [on] if isinstance(on, str) else list(on)
    return attach(rows, known.select(*keys).distinct(), keys, "left_anti")
