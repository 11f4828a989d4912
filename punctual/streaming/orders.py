"""Order events as they arrive: twins, deliveries matched to placements, outcomes, bias per day."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from punctual.functions.scores import bias, mae


def drop_twins(events: DataFrame, key: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Keep the first arrival of each natural key; a twin up to ``delay`` later is dropped.

    State is kept per key only until the watermark passes.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def deliveries(
    placed: DataFrame,
    delivered: DataFrame,
    *,
    on: list[str],
    placed_at: str,
    delivered_at: str,
    longest: str = "12 hours",
    delay: str = "1 hour",
) -> DataFrame:
    """Match a placement with its delivery within ``longest``; works on streams and on tables.

    Both sides carry a watermark, so an order that is never delivered leaves the state once
    ``longest`` has passed. In-flight orders give no row yet.
    """
    left = placed.withWatermark(placed_at, delay).alias("p")
    right = delivered.withWatermark(delivered_at, delay).alias("d")
    same = F.lit(True)
    for column in on:
        same = same & (F.col(f"p.{column}") == F.col(f"d.{column}"))
    window = (F.col(f"d.{delivered_at}") > F.col(f"p.{placed_at}")) & (
        F.col(f"d.{delivered_at}") < F.col(f"p.{placed_at}") + F.expr(f"interval {longest}")
    )
    took = F.timestamp_diff("SECOND", F.col(f"p.{placed_at}"), F.col(f"d.{delivered_at}")) / F.lit(60.0)
    joined = left.join(right, same & window, "inner")
    kept = [F.col(f"p.{c}") for c in placed.columns]
    extra = [F.col(f"d.{c}") for c in delivered.columns if c not in placed.columns]
    return joined.select(*kept, *extra, took.alias("actual_minutes"))


def bias_by_window(
    scored: DataFrame, ts: str, pred: str | Column, actual: str, *, width: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Rows, bias and MAE per time window, emitted when the watermark has closed the window."""
    groups = scored.withWatermark(ts, delay).groupBy(F.window(ts, width))
    return groups.agg(
        F.count(F.lit(1)).alias("rows"), bias(pred, actual).alias("bias"), mae(pred, actual).alias("mae")
    ).select(F.col("window.start").alias("window_start"), "rows", "bias", "mae")


def windows_so_far(
    emitted: DataFrame, arrived: DataFrame, ts: str, pred: str | Column, actual: str, *, width: str = "1 day"
) -> DataFrame:
    """All windows of a stream, also those that its watermark has not closed, and what came too late for the others.

    emitted: what ``bias_by_window`` wrote; arrived: everything the stream has read, as a table. A window is closed if it or
    a later one was emitted. Closed windows are taken as emitted; ``late_rows`` counts the rows that the stream dropped
    because the window was closed when they came. Open windows are computed from their own rows only, by a
    filter that reaches the scan, and have no late rows. A window that was closed before its first row came
    has 0 rows.
    """
    last = emitted.agg(F.max("window_start")).scalar()
    start = F.window(ts, width)["start"]
    measures = [F.count(F.lit(1)).alias("rows"), bias(pred, actual).alias("bias"), mae(pred, actual).alias("mae")]
    after = last + F.expr(f"interval {width}")
    rest = arrived.filter(F.coalesce(F.col(ts) >= after, F.lit(True)))
    open_ = rest.groupBy(start.alias("window_start")).agg(*measures)
    came = arrived.filter(F.col(ts) < after).groupBy(start.alias("window_start")).agg(F.count(F.lit(1)).alias("_came"))
    closed = came.join(emitted, "window_start", "left").select(
        "window_start", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "bias", "mae", F.lit(True).alias("closed"),
        (F.col("_came") - F.coalesce("rows", F.lit(0))).alias("late_rows"),
    )
    return closed.unionByName(open_.withColumns({"closed": F.lit(False), "late_rows": F.lit(0).cast("long")}))


# What can happen to an order, and how long it may take.
PLACED, DELIVERED, CANCELLED = "placed", "delivered", "cancelled"
LONGEST_MINUTES = 720
OUTCOME = "outcome string, placed_ms long, actual_minutes double"
# The times that an order has in the state, in this order.
STEPS = {PLACED: 0, DELIVERED: 1, CANCELLED: 2}
# Groups of orders that share a state. A stream that has begun keeps its number of them.
BUCKETS = 2048


class OrderLifecycle(StatefulProcessor):
    """The orders of a bucket in one state, and a timer at the first time by which one of them must have been delivered.

    Every call of the state is a message to the JVM. A state and a timer for each order would take several of them
    an order; so they are a few a bucket and batch.
    """

    def __init__(self, keys: T.StructType, longest_minutes: int):
        self.keys, self.longest = keys, longest_minutes * 60_000
        self.zoned = [i for i, f in enumerate(keys) if isinstance(f.dataType, T.TimestampType)]
        self.bytes = [i for i, f in enumerate(keys) if isinstance(f.dataType, T.BinaryType)]

    def init(self, handle) -> None:
        order = T.StructType().add("key", self.keys)
        for step in STEPS:
            order = order.add(f"{step}_ms", "long")
        self.handle = handle
        self.orders = handle.getValueState("orders", T.StructType().add("orders", T.ArrayType(order.add("done", "boolean"))))

    def _own(self, key: Iterable) -> tuple:
        """A key that is the same whether it comes from a row or from the state."""
        if not self.zoned and not self.bytes:
            return tuple(key)
        values = list(key)
        for i in self.zoned:
            values[i] = None if values[i] is None else values[i].astimezone(timezone.utc)
        for i in self.bytes:
            values[i] = None if values[i] is None else bytes(values[i])
        return tuple(values)

    def _known(self) -> dict[tuple, list]:
        """Per key: placed, delivered, cancelled, done."""
        found = self.orders.get()
        return {self._own(key): steps for key, *steps in found[0]} if found else {}

    def _due(self, order: list) -> int:
        return (min(x for x in order[1:3] if x is not None) if order[0] is None else order[0]) + self.longest

    def _first_due(self, orders: Iterable[list]) -> int | None:
        return min(map(self._due, orders), default=None)

    def _keep(self, known: dict[tuple, list], alarm: int | None) -> None:
        """Store the orders; ``alarm`` is the timer that is set."""
        due = self._first_due(known.values())
        if due != alarm:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            if due is not None:
                self.handle.registerTimer(due)
        if known:
            self.orders.update(([(key, *order) for key, order in known.items()],))
        else:
            self.orders.clear()

    def _row(self, key: tuple, outcome: str, placed: int | None, end: int | None = None) -> Row:
        minutes = None if placed is None or end is None else (end - placed) / 60_000
        return Row(**dict(zip(self.keys.names, key, strict=True)), outcome=outcome, placed_ms=placed, actual_minutes=minutes)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._known()
        alarm = self._first_due(known.values())
        touched: dict[tuple, list] = {}
        width = len(self.keys)
        for row in rows:
            own, step, at_ms = self._own(row[-2 - width : -2]), STEPS.get(row[-2]), row[-1]
            order = known.get(own)
            if order is None:
                order = known[own] = [None, None, None, False]
            touched[own] = order
            # of two reports of the same step the earlier counts
            if step is not None and at_ms is not None and (order[step] is None or at_ms < order[step]):
                order[step] = at_ms
        for own, order in touched.items():
            placed, delivered, cancelled, done = order
            if placed is None and delivered is None and cancelled is None:
                del known[own]
            elif not done and placed is not None and (delivered is not None or cancelled is not None):
                # a settled order stays known until no row of it can come any more
                order[3] = True
                if cancelled is not None and (delivered is None or cancelled <= delivered):
                    yield self._row(own, "cancelled", placed)
                elif delivered <= placed:
                    yield self._row(own, "not_positive", placed, delivered)
                elif delivered - placed >= self.longest:
                    yield self._row(own, "timed_out", placed)
                else:
                    yield self._row(own, "delivered", placed, delivered)
        self._keep(known, alarm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known, now = self._known(), timerValues.getCurrentWatermarkInMs()
        for own in [own for own, order in known.items() if self._due(order) <= now]:
            placed, _, _, done = known.pop(own)
            if not done:
                yield self._row(own, "timed_out" if placed is not None else "never_placed", placed)
        # the timer that has run out is removed by Spark
        self._keep(known, None)

    def close(self) -> None:
        pass


def order_outcomes(
    steps: DataFrame, on: list[str], *, at: str = "at", kind: str = "kind", longest_minutes: int = LONGEST_MINUTES,
    delay: str = "1 hour", buckets: int = BUCKETS,
) -> DataFrame:
    """One row per order as soon as its end is known: the keys, outcome, placed_at, actual_minutes.

    ``steps`` has a row per step of an order: placed, delivered or cancelled, in any order of arrival. The outcome is
    delivered (with its minutes), cancelled, not_positive (delivered before it was placed), timed_out (delivered
    after ``longest_minutes`` or, by a timer on the event time, not at all) or never_placed. The
    earlier of a delivery and a cancellation counts if both are known when the first is handled; an
    order has one row, later steps change nothing. Rows behind the watermark are dropped. Start the
    query within ``state_in_rocksdb``. ``orders_in_flight`` reads what is still open.

    Orders are dealt over ``buckets`` by a hash of their keys. A task holds the orders of one bucket at a time, those of
    the last ``longest_minutes``: with many millions of them, begin with more buckets.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(buckets)).cast("int").alias("_bucket")
    timed = steps.withWatermark(at, delay).select(bucket, at, *on, F.col(kind).alias("kind"), F.unix_millis(at).alias("at_ms"))
    keys = T.StructType([steps.schema[c] for c in on])
    out = T.StructType(list(keys.fields))
    for column in OUTCOME.split(", "):
        out = out.add(*column.split(" "))
    found = timed.groupBy("_bucket").transformWithState(OrderLifecycle(keys, longest_minutes), out, "Append", "EventTime")
    return found.select(*on, "outcome", F.timestamp_millis("placed_ms").alias("placed_at"), "actual_minutes")


def orders_in_flight(spark: SparkSession, progress: str) -> DataFrame:
    """The orders without an outcome so far, read from the state that ``order_outcomes`` keeps below ``progress``."""
    state = spark.read.format("statestore").option("stateVarName", "orders").load(progress)
    orders = state.select(F.explode("value.orders").alias("o")).filter("not o.done")
    placed = F.timestamp_millis("o.placed_ms").alias("placed_at")
    return orders.select("o.key.*", F.lit("in_flight").alias("outcome"), placed, F.lit(None).cast("double").alias("actual_minutes"))
