"""Tumbling-window price aggregates and the serving queries on top of them.

A1  window_aggregates   (window, symbol) → avg/min/max rounded to 4, tick count
W5  latest_window       newest window row per symbol
W7  windows_since       windows of one symbol starting after a point in time
O4  top_windows         newest N window rows overall

Plans: the aggregate is a partial (map-side) hash aggregate, one exchange on
(window, symbol), then the final merge; a hot symbol is split across many
groups by its windows, so no group holds a third of the data. ``latest_window``
is a ``max_by`` aggregate — map-side combine, no sort, one row per symbol out
of every map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, TimestampNTZType,
                               TimestampType)

from ..schema import WINDOW_DURATION

WINDOW_COLUMNS = ["window_start", "window_end", "symbol", "avg_price", "min_price",
                  "max_price", "tick_count"]


def half_up_mean(total: Column, n: Column) -> Column:
    """total / n of whole numbers, rounded half away from zero, in whole numbers throughout."""
    size = F.abs(total)
    mean = F.call_function("div", size, n) + F.when(2 * (size % n) >= n, 1).otherwise(0)
    return F.when(total < 0, -mean).otherwise(mean)


def _exact_avg4(price: Column) -> tuple[Column, Column]:
    """avg rounded half-up to 4 decimals, computed on integers (deterministic).

    Prices are first rounded to 1e-4 units; their sum and count give the mean in
    units. The same on any engine and any partitioning (no floating-point summation
    order), for negative prices too. Prices that are NaN, infinite or beyond the
    range of units are left out; a sum beyond it gives null.
    """
    units = F.round(price * 10000).try_cast("bigint")
    n = F.count(units)
    avg4 = F.when(n > 0, half_up_mean(F.try_sum(units), n) / F.lit(10000.0))
    return avg4, n


def window_aggregates(ticks: DataFrame, duration: str = WINDOW_DURATION,
                      mode: str = "double", watermark: str | None = None) -> DataFrame:
    """Tumbling-window aggregates per (window, symbol).

    mode="double": round(avg(price), 4) on doubles (default, the original
                   expression). Where the exact mean ends in a 5 at the fifth
                   decimal, the summation order decides the rounding.
    mode="exact":  avg of prices cut to 1e-4 units, rounded half-up on integers
                   (see ``_exact_avg4``); the same on any partitioning.
    Rows with a null timestamp fall in no window; null prices are ignored
    (a window of only null prices gives nulls and tick_count 0).
    """
    src = ticks.select("timestamp", "symbol", "price")
    if watermark:
        src = src.withWatermark("timestamp", watermark)
    grouped = src.groupBy(F.window("timestamp", duration).alias("w"), "symbol")
    price = F.col("price")
    if mode == "double":
        avg = F.round(F.avg(price), 4)
    elif mode == "exact":
        avg, _ = _exact_avg4(price)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out = grouped.agg(
        avg.alias("avg_price"),
        F.round(F.min(price), 4).alias("min_price"),
        F.round(F.max(price), 4).alias("max_price"),
        F.count(price).alias("tick_count"),
    )
    return out.select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"),
                      *WINDOW_COLUMNS[2:])


_FIXED_WIDTH = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType,
                DateType, TimestampType, TimestampNTZType)


def _fixed_width(kind) -> bool:
    return isinstance(kind, _FIXED_WIDTH) or isinstance(kind, DecimalType) and kind.precision <= 18


def latest_window(windows: DataFrame) -> DataFrame:
    """Newest window row per symbol (``DISTINCT ON (symbol) ORDER BY window_start DESC``).

    (window_start, symbol) is unique, so one ``max_by(col, window_start)`` per
    column picks the same row for every column. With only fixed-width columns
    that is a hash aggregate; a single ``max_by(struct(...))`` would force a
    sort-based one (each map task sorting its input).
    """
    rest = [f for f in windows.schema.fields if f.name != "symbol"]
    order = F.col("window_start")
    if all(_fixed_width(f.dataType) for f in rest):
        aggs = [(F.max(order) if f.name == "window_start" else F.max_by(f.name, order)).alias(f.name)
                for f in rest]
        return windows.groupBy("symbol").agg(*aggs).select(windows.columns)
    best = F.max_by(F.struct(*[f.name for f in rest]), order)
    return (windows.groupBy("symbol").agg(best.alias("w"))
            .select("symbol", *[F.col(f"w.{f.name}").alias(f.name) for f in rest]))


def windows_since(windows: DataFrame, since: Column | str,
                  symbol: str | None = None) -> DataFrame:
    """Windows starting strictly after ``since`` (e.g. ``as_of - 1 hour``), optionally one symbol."""
    since_c = F.lit(since).cast("timestamp") if isinstance(since, str) else since
    cond = F.col("window_start") > since_c
    if symbol is not None:
        cond = cond & (F.col("symbol") == F.lit(symbol))
    return windows.where(cond)


def top_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` window rows overall; ties broken by symbol (TakeOrderedAndProject)."""
    return windows.orderBy(F.col("window_start").desc(), F.col("symbol").asc()).limit(n)
