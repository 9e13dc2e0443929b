"""Serving queries: live-over-stored overlay, symbol cards, live detail, display rows.

J1  price_overlay   stored and live latest prices, live wins; symbols of both kept
J2  symbol_cards    one card per dimension symbol, in dimension order
J3                  is_live flag on overlay and cards
J4  live_detail     the live tick of each dimension symbol that has one
K9  session_summary session stats as display rows, sorted by symbol

Joins. Overlay inputs are one row per symbol each; Catalyst/AQE picks the
strategy from their measured size (full outer: shuffled hash or sort-merge).
The symbol dimension is a fixed list, so it is the broadcast side: it is
the build side of a right-outer (cards) or inner (detail) broadcast hash
join and the per-symbol tables are streamed, never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import format as fmt
from ..schema import SYMBOLS


def symbol_dim(spark: SparkSession, symbols: list[str] | None = None) -> DataFrame:
    """The ordered symbol dimension (ord, symbol); fixed size, safe to broadcast."""
    syms = SYMBOLS if symbols is None else symbols
    return spark.createDataFrame([(i, s) for i, s in enumerate(syms)], "ord int, symbol string")


def price_overlay(stored: DataFrame, live: DataFrame) -> DataFrame:
    """symbol, price, is_live. A live entry overrides the stored one (even a null price)."""
    s = stored.select("symbol", F.col("price").alias("_stored"))
    lv = live.select("symbol", F.col("price").alias("_live"), F.lit(True).alias("_in_live"))
    j = s.join(lv, "symbol", "full_outer")
    is_live = F.coalesce(F.col("_in_live"), F.lit(False))
    price = F.when(is_live, F.col("_live")).otherwise(F.col("_stored"))
    return j.select("symbol", price.alias("price"), is_live.alias("is_live"))


def symbol_cards(dim: DataFrame, overlay: DataFrame) -> DataFrame:
    """ord, symbol, price, is_live, price_text for every dimension symbol.

    Symbols outside the dimension are dropped, missing ones shown as '—'.
    """
    # Semi join first (a small dimension is broadcast by its size): at most one overlay
    # row per dimension symbol survives, so the outer join below is between
    # two inputs bounded by the dimension size.
    hits = overlay.join(dim.select("symbol"), "symbol", "left_semi")
    j = dim.join(hits, "symbol", "left")
    return j.select("ord", "symbol", "price",
                    F.coalesce(F.col("is_live"), F.lit(False)).alias("is_live"),
                    fmt.price_text("price").alias("price_text"))


def live_detail(dim: DataFrame, live_ticks: DataFrame) -> DataFrame:
    """Live tick of each dimension symbol with display texts; missing symbols skipped."""
    j = live_ticks.join(dim, "symbol", "inner")
    return j.select("ord", "symbol", "price", "volume", "timestamp",
                    fmt.dollars("price").alias("price_text"),
                    fmt.grouped_int("volume").alias("volume_text"),
                    fmt.ts_text("timestamp").alias("time_text"))


def window_rows(windows: DataFrame) -> DataFrame:
    """Window aggregates as display texts (dashboard table)."""
    return windows.select(
        "symbol",
        fmt.ts_text("window_start").alias("window_start_text"),
        fmt.ts_text("window_end").alias("window_end_text"),
        fmt.dollars("avg_price").alias("avg_text"),
        fmt.dollars("min_price").alias("min_text"),
        fmt.dollars("max_price").alias("max_text"),
        "tick_count")


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts as one display line each."""
    line = F.format_string("**%s** | %s | Price: %s | Volume: %s | Time: %s",
                           F.col("symbol"), F.col("alert_type"), fmt.dollars("price"),
                           fmt.grouped_int("volume"), fmt.ts_text("timestamp"))
    return alerts.select("*", line.alias("line"))


def session_summary(stats: DataFrame) -> DataFrame:
    """K9: symbol, ticks, min/max text ('N/A' when missing), alerts; sorted by symbol."""
    return (stats.select("symbol", "ticks", fmt.or_na("min_price").alias("min_text"),
                         fmt.or_na("max_price").alias("max_text"), "alerts")
            .orderBy("symbol"))
