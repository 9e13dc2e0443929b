"""Bounded tick history per symbol and its normalisation.

W4/O5  last_n_ticks    newest ``n`` ticks per symbol (arrival order)
W6     pct_change      % change of each kept tick from the oldest kept one
O3     oldest_first    history in chart order (symbol, seq ascending)
K3     history_entries history rows as stored: JSON text per tick, newest first
S7     read_history    stored entries back as (timestamp text, price), oldest first;
                       malformed entries skipped

Skew. ``row_number() <= n`` over a per-symbol window gets a partial
window-group limit before the exchange, so each map task ships at most ``n``
rows per symbol; but the final task of a hot symbol would still receive
``n`` rows from every map task. ``last_n_ticks`` therefore ranks twice: first
per (symbol, partition, chunk), then per symbol over those survivors, whose map
side is cut again to ``n`` per shuffle partition. The last stage's input per
symbol is bounded by ``n`` × shuffle partitions, not by the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import text_to_double, tick_json, timestamp_text
from ..schema import HISTORY_LEN
from .rolling import DEFAULT_CHUNK


def last_n_ticks(ticks: DataFrame, n: int = HISTORY_LEN,
                 chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Newest ``n`` ticks per symbol by (partition, offset); adds ``rank`` (1 = newest).

    Ties in event time do not matter: the order is the arrival order, so of
    two ticks with the same timestamp the later-arrived one ranks first.
    """
    cols = ticks.columns
    t = (ticks.where(F.col("offset").isNotNull())
         .withColumn("_chunk", F.expr(f"`offset` div {int(chunk_size)}")))
    w1 = (Window.partitionBy("symbol", "partition", "_chunk")
          .orderBy(F.col("offset").desc()))
    stage1 = t.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy("symbol").orderBy(F.col("partition").desc(), F.col("offset").desc())
    return (stage1.withColumn("rank", F.row_number().over(w2).cast("bigint"))
            .where(F.col("rank") <= n)
            .select(*cols, "rank"))


def pct_change(history: DataFrame) -> DataFrame:
    """Add ``base_price`` (oldest kept tick) and ``pct_change``.

    pct_change = round((price - base) / base * 100, 4); null when base is 0.
    ``history`` is the bounded output of ``last_n_ticks`` (≤ n rows per symbol),
    so the per-symbol window here is small by construction.
    """
    w = Window.partitionBy("symbol")
    base = F.min_by("price", F.struct("partition", "offset")).over(w)
    pct = F.round(F.try_divide(F.col("price") - F.col("base_price"),
                               F.col("base_price")) * 100, 4)
    return history.withColumn("base_price", base).withColumn("pct_change", pct)


def oldest_first(history: DataFrame) -> DataFrame:
    """Chart order: per symbol, oldest kept tick first (bounded input)."""
    return history.orderBy("symbol", "partition", "offset")


def history_entries(history: DataFrame) -> DataFrame:
    """Stored form of the history: symbol, rank, partition, offset, JSON text.

    The JSON holds symbol, price, volume, timestamp (plain text) and source.
    """
    return history.select(
        "symbol", "rank", "partition", "offset",
        tick_json(F.col("symbol"), F.col("price"), F.col("volume"),
                  timestamp_text(F.col("timestamp")), F.col("source")).alias("tick_json"))


_ENTRY_SCHEMA = "price string, timestamp string"


def read_history(entries: DataFrame, json_col: str = "tick_json") -> DataFrame:
    """Stored history entries → symbol, rank, timestamp (text), price (double).

    An entry whose JSON does not parse, whose price is not a number, or that
    has no timestamp is skipped. Oldest first within a symbol (highest rank
    first), as a chart draws it. The price is read as text and cast with
    ``try_cast``, so a quoted number still counts.
    """
    e = F.from_json(F.col(json_col), _ENTRY_SCHEMA)
    parsed = entries.select("symbol", "rank", F.inline(F.array(e)))
    out = parsed.select("symbol", "rank", "timestamp",
                        text_to_double(F.col("price")).alias("price"))
    return (out.where(F.col("price").isNotNull() & F.col("timestamp").isNotNull())
            .orderBy("symbol", F.col("rank").desc()))
