"""Rolling mean of the last N ticks per symbol, deviation alerts, session stats.

W1  rolling_mean     mean of the last ``n`` prices (current included) in arrival
                     order; null until ``min_ticks`` ticks of the symbol were seen
W2  deviation        |price - mean| / mean, null when the mean is 0
W3  price_alerts     deviation > threshold → PRICE_SURGE (price > mean) else PRICE_DROP
A2  session_stats    per symbol: ticks, min, max, alert count

Skew. A plain ``avg over (partition by symbol order by seq rows 9 preceding)``
sends every tick of a symbol to one task; with a handful of symbols, one of
them may carry a third of all rows. ``rolling_mean`` therefore counts the ticks
per (symbol, partition) first. Symbols of at most ``chunk_size`` ticks are
windowed whole. A busier symbol is cut into *pieces*, ranges of offsets of one
partition whose width follows from its own density, so that a piece has about
``chunk_size`` ticks however dense or sparse they are; ranges that hold far more
(a burst) are cut again. Only the first ``n - 1`` rows of a piece miss part of
their frame; they get it from a *halo*: the last ``n - 1`` ticks of the symbol
before the piece, from the tails of up to ``n - 1`` preceding pieces. The halo is
at most n - 1 rows per piece of a busy symbol, and nothing where no symbol is
busy: then the plan is one scan, one exchange, one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import (ALERT_THRESHOLD, PRICE_DROP, PRICE_SURGE, SMA_MIN_TICKS,
                      SMA_WINDOW)
from ..session import stored
from .windows import half_up_mean

DEFAULT_CHUNK = 1 << 20     # ticks of one symbol per task, about
HEAVY = 4                   # a piece of more than so many chunks is cut again
BROADCAST_ROWS = 100_000    # pieces tables up to this many rows (a few MB) are broadcast


def _usable(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("price").isNotNull() & F.col("offset").isNotNull())


def _joined(ticks: DataFrame, table: DataFrame, rows: int, on: list[str], how: str = "left") -> DataFrame:
    """``ticks`` with the columns of a small table whose keys are named ``_k_<key>``; nulls match."""
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in on]
    small = F.broadcast(table) if rows <= BROADCAST_ROWS else table
    return ticks.join(small, same, how).drop(*[f"_k_{k}" for k in on])


def _start(lo: str, width: str):
    """First offset of the range of ``width`` offsets, counted from ``lo``, that holds a tick."""
    return F.expr(f"`{lo}` + ((`offset` - `{lo}`) div `{width}`) * `{width}`")


def _ranges(counts: DataFrame, chunk_size: int, keys: list[str]) -> DataFrame:
    """Rows of (keys, n, lo, hi) with the width that gives a range about ``chunk_size`` ticks."""
    width = F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo") + 1) * (chunk_size / F.col("n")))).cast("bigint")
    return counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("lo").alias("_lo"), width.alias("_width"))


class Pieces:
    """How busy symbols are cut: tables of ranges, from coarse to fine, and their numbers of rows.

    Built from counts: at most rows / chunk_size symbols are busy, and a finer
    table has a row per range that held too much.
    """

    def __init__(self, ticks: DataFrame, chunk_size: int):
        self.levels: list[tuple[DataFrame, int]] = []
        ticks = _usable(ticks).select("symbol", "partition", "offset")
        per = ticks.groupBy("symbol", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))
        total = F.sum("n").over(Window.partitionBy("symbol"))
        counts = stored(per.withColumn("_total", total).where(F.col("_total") > chunk_size), "busy-symbols")
        keys = ["symbol", "partition"]
        while rows := counts.count():
            self.levels.append((_ranges(counts, chunk_size, keys), rows))
            keys = ["symbol", "partition", "_piece"]
            found = self.of(ticks).where("_piece is not null")
            heavy = (found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))
                     .where((F.col("n") > HEAVY * chunk_size) & (F.col("hi") > F.col("lo"))))  # one offset cannot be cut
            counts = stored(heavy, "busy-pieces")

    def of(self, ticks: DataFrame) -> DataFrame:
        """``ticks`` with ``_piece``: the first offset of its range, null where the symbol is whole."""
        out = ticks.withColumn("_piece", F.lit(None).cast("bigint"))
        for k, (table, rows) in enumerate(self.levels):
            out = _joined(out, table, rows, ["symbol", "partition"] + ["_piece"] * (k > 0))
            out = out.withColumn("_piece", F.when(F.col("_lo").isNotNull(), _start("_lo", "_width")).otherwise(F.col("_piece"))).drop("_lo", "_width")
        return out


def halo_rows(ticks: DataFrame, h: int, pieces: Pieces) -> DataFrame:
    """For every piece of a busy symbol: the last ``h`` ticks of the symbol before it.

    Output: symbol, partition, _piece (the requesting piece), _sp (source
    partition), offset, price. Built only from the tails of the pieces (their
    ``h`` newest ticks, cut map-side by a partial window-group limit), so its size
    is at most ``h`` rows per piece.
    """
    key = ["symbol", "partition", "_piece"]
    t = pieces.of(_usable(ticks).select("symbol", "partition", "offset", "price")).where("_piece is not null")
    wt = Window.partitionBy(*key).orderBy(F.col("offset").desc())
    tails = (t.select(*key, "offset", "price", F.row_number().over(wt).alias("_tr"))
             .where(F.col("_tr") <= h)
             .groupBy(*key)
             .agg(F.array_sort(F.collect_list(F.struct(F.col("partition").alias("_sp"), "offset", "price")))
                  .alias("_tail")))
    # Up to h preceding pieces of the symbol: each holds >= 1 tick,
    # so together they hold the h ticks just before the piece.
    w = Window.partitionBy("symbol").orderBy("partition", "_piece").rowsBetween(-h, -1)
    before = tails.select(*key, F.flatten(F.collect_list("_tail").over(w)).alias("_before"))
    last = F.slice("_before", F.greatest(F.size("_before") - h, F.lit(0)) + 1, F.lit(h))
    return before.select(*key, F.inline(last))


def rolling_mean(ticks: DataFrame, n: int = SMA_WINDOW, min_ticks: int = SMA_MIN_TICKS,
                 chunk_size: int = DEFAULT_CHUNK, out_col: str = "sma",
                 exact4: bool = False, prior: DataFrame | None = None) -> DataFrame:
    """Add ``out_col``: mean of the last ``n`` prices of the symbol up to this tick.

    With ``exact4`` also ``<out_col>4``: the same mean rounded half-up to 4
    decimals from integer 1e-4 price units (same value on every engine).

    ``prior``: earlier ticks of the same symbols (symbol, partition, offset,
    price; at least the last ``n - 1`` of each symbol) that enter the frames
    but are not emitted — the state carried between micro-batches.

    Order is (partition, offset). Ticks without a price are left out (they have
    no mean and do not enter anyone's window), as are ticks without an offset.
    The ticks are counted when the frame is built (one scan of three columns).
    Plan: ticks ∪ halo rows → one exchange on (symbol, piece) → sort → window →
    drop halo rows. The frame sum runs in the same order as the plain per-symbol
    window, so the means are identical to it.
    """
    if not 1 <= min_ticks <= n:
        raise ValueError("need 1 <= min_ticks <= n")
    h = n - 1
    cols = ticks.columns
    src = ticks.withColumn("_emit", F.lit(True))
    if prior is not None:
        src = src.unionByName(
            prior.select("symbol", "partition", "offset", "price")
            .withColumn("_emit", F.lit(False)), allowMissingColumns=True)
    pieces = Pieces(src, chunk_size)
    main = pieces.of(_usable(src)).withColumn("_sp", F.col("partition"))
    keys = ["symbol"]
    if pieces.levels:
        # the partition of a piece; a symbol that is whole spans all of its partitions
        keys += ["_in", "_piece"]
        inside = F.when(F.col("_piece").isNotNull(), F.col("partition"))
        main = main.withColumn("_in", inside)
        if h > 0:
            halo = halo_rows(src, h, pieces).withColumn("_in", inside).withColumn("_emit", F.lit(False))
            main = main.unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_sp", "offset")
    frame = w.rowsBetween(-h, 0)
    valid = F.row_number().over(w) >= min_ticks
    main = main.withColumn(out_col, F.when(valid, F.avg("price").over(frame)))
    out = [out_col]
    if exact4:
        # NaN, infinite and out-of-range prices are left out of the exact mean
        unit = F.round(F.col("price") * 10000).try_cast("bigint")
        units = F.try_sum(unit).over(frame)
        cnt = F.count(unit).over(frame)
        main = main.withColumn(out_col + "4", F.when(
            valid & (cnt > 0), half_up_mean(units, cnt) / F.lit(10000.0)))
        out.append(out_col + "4")
    return main.where(F.col("_emit")).select(*cols, *out)


def deviation(price: str = "price", sma: str = "sma"):
    """|price - sma| / sma; null when sma is null or 0 (no division error)."""
    return F.try_divide(F.abs(F.col(price) - F.col(sma)), F.col(sma))


def price_alerts(with_sma: DataFrame, threshold: float = ALERT_THRESHOLD,
                 sma: str = "sma") -> DataFrame:
    """Add ``deviation`` and ``alert_type`` (null when no alert).

    Alert when deviation is strictly greater than ``threshold``; direction
    PRICE_SURGE when the price is above the mean, else PRICE_DROP.
    """
    dev = deviation("price", sma)
    kind = F.when(dev > F.lit(threshold),
                  F.when(F.col("price") > F.col(sma), F.lit(PRICE_SURGE))
                  .otherwise(F.lit(PRICE_DROP)))
    return with_sma.withColumn("deviation", dev).withColumn("alert_type", kind)


def rolling_alerts(ticks: DataFrame, n: int = SMA_WINDOW, threshold: float = ALERT_THRESHOLD,
                   chunk_size: int = DEFAULT_CHUNK, exact4: bool = False,
                   prior: DataFrame | None = None) -> DataFrame:
    """W1-W3 in one call: every priced tick with its mean, deviation and alert."""
    return price_alerts(rolling_mean(ticks, n=n, chunk_size=chunk_size, exact4=exact4,
                                     prior=prior), threshold)


def session_stats(alerted: DataFrame) -> DataFrame:
    """A2: per symbol tick count, min and max price, number of price alerts.

    Input is the output of ``rolling_alerts`` (one row per priced tick).
    Partial aggregation before the shuffle; one row per symbol out.
    """
    return (alerted.groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("ticks"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price"),
                 F.count("alert_type").alias("alerts")))
