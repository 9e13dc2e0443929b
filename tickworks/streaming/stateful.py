"""T5: keyed, stateful rolling mean and alerts for streams.

A micro-batch is cut into *segments*: a symbol's ticks within ``SEGMENT`` offsets
of one partition. A segment is one group of a stateless grouping
(``segment_means``), so a hot symbol runs in as many tasks as it has segments,
and none holds more than ``SEGMENT`` ticks. It finishes all means but those of its
first n - 1 ticks, whose frames reach back before it. Those *heads*, its last
n - 1 ticks (*tails*) and a row of sums go on to the symbol's state; finished rows
go on by (symbol, lane) and pass through.

``RollingMeanProcessor`` runs under ``groupBy("symbol", "lane").transformWithStateInPandas``.
In the boundary lane it has at most 2 (n - 1) + 1 rows per segment; with the last
n - 1 prices of the state it finishes the heads. State per symbol: those prices
(ListState) and the session stats (ValueState), kept in the checkpointed state store
(RocksDB), so a restarted query continues where it stopped. Other lanes have no
state; their frames are passed on one by one.
``TickStateProcessor`` keeps the latest tick and the bounded history (K2, K3) of
what ``newest_of_segment`` left of each segment.

Order within a symbol is (partition, offset). The frame sums are accumulated
oldest-first, the order the batch window uses, so stream and batch give identical
means.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schema import (ALERT_THRESHOLD, PRICE_DROP, PRICE_SURGE, SMA_MIN_TICKS,
                      SMA_WINDOW)

STATS_STATE = "ticks bigint, min_price double, max_price double, alerts bigint"
TICK_STATE = ("price double, volume bigint, ts_us bigint, source string, partition int, "
              "offset bigint")
LATEST_OUTPUT = ("symbol string, price double, volume bigint, ts_us bigint, source string, "
                 "partition int, offset bigint")

ROLLING_OUTPUT = ("symbol string, partition int, offset bigint, timestamp timestamp, "
                  "price double, sma double, sma4 double, deviation double, alert_type string")


def rolling_frame(prev: np.ndarray, prices: np.ndarray, seen: int, n: int, min_ticks: int,
                  threshold: float) -> dict[str, np.ndarray]:
    """Means, exact 4-decimal means, deviations and alert types for new prices.

    ``prev`` are the last ≤ n-1 prices before them, ``seen`` the number of ticks
    of the symbol before them. Small vectorised helper (≤ n passes over the batch).
    """
    h = n - 1
    p = np.concatenate([prev, prices])
    m, k = len(prev), len(prices)
    scaled = p * 10000
    whole = np.isfinite(scaled) & (np.abs(scaled) < 2.0 ** 63)  # as the batch form's try_cast
    x = np.where(whole, scaled, 0.0)
    low = np.floor(np.abs(x))
    units = (np.sign(x) * (low + (np.abs(x) - low >= 0.5))).astype(np.int64)  # half-up, as round()
    pos = np.arange(k) + m
    s = np.zeros(k)
    u = np.zeros(k, dtype=np.int64)
    c = np.zeros(k, dtype=np.int64)
    cw = np.zeros(k, dtype=np.int64)
    for d in range(h, -1, -1):          # oldest element of the frame first
        e = pos - d
        ok = e >= 0
        idx = np.where(ok, e, 0)
        s = np.where(ok, s + p[idx], s)
        u = np.where(ok, u + units[idx], u)
        c = c + ok
        cw = cw + (ok & whole[idx])
    valid = (seen + np.arange(1, k + 1)) >= min_ticks
    sma = np.where(valid, s / c, np.nan)
    cw1 = np.maximum(cw, 1)
    size = np.abs(u)
    mean = size // cw1 + (2 * (size % cw1) >= cw1)      # half away from zero, in whole units
    sma4 = np.where(valid & (cw > 0), np.sign(u) * mean / 10000.0, np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        dev = np.abs(prices - sma) / sma
    dev = np.where(np.isfinite(dev), dev, np.nan)
    alert = np.where(dev > threshold, np.where(prices > sma, PRICE_SURGE, PRICE_DROP), None)
    return {"sma": sma, "sma4": sma4, "deviation": dev, "alert_type": alert}


#: Rows between the segments and the state: the result's columns, and what a segment sums up.
SEGMENT_OUTPUT = ROLLING_OUTPUT + (", lane int, kind string, ticks bigint, min_price double, max_price double, "
                                   "alerts bigint")
RESULT_COLUMNS = [c.split()[0] for c in ROLLING_OUTPUT.split(", ")]
SEGMENT = 1 << 16           # offsets; a segment holds no more ticks than that
LANES = 64                  # groups of finished rows per symbol
BOUNDARY = -1


def _in_order(df: pd.DataFrame) -> pd.DataFrame:
    return df.sort_values(["partition", "offset"], kind="mergesort")


def segment_means(n: int = SMA_WINDOW, min_ticks: int = SMA_MIN_TICKS, threshold: float = ALERT_THRESHOLD):
    """The function of one segment: (symbol, partition, segment number), its ticks → SEGMENT_OUTPUT."""
    h = n - 1

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = _in_order(df[df["price"].notna() & df["offset"].notna()])
        k = len(df)
        if not k:
            return pd.DataFrame(columns=[c.split()[0] for c in SEGMENT_OUTPUT.split(", ")])
        out = df[["symbol", "partition", "offset", "timestamp", "price"]].copy()
        out["kind"], out["lane"] = "head", BOUNDARY
        for c in ("sma", "sma4", "deviation"):
            out[c] = np.nan
        out["alert_type"] = None
        first = out.iloc[:h]
        if k <= h:
            return first.reindex(columns=[*RESULT_COLUMNS, "lane", "kind", "ticks", "min_price", "max_price", "alerts"])
        prices = df["price"].to_numpy(dtype=float)
        done = out.iloc[h:].assign(kind="done", lane=int(key[2]) % LANES,
                                   **rolling_frame(prices[:h], prices[h:], h, n, min_ticks, threshold))
        tails = out.iloc[max(h, k - h):].assign(kind="tail")
        total = out.iloc[-1:].assign(kind="sum", ticks=k - h, min_price=prices[h:].min(), max_price=prices[h:].max(),
                                     alerts=int(pd.notna(done["alert_type"]).sum()))
        return pd.concat([first, done, tails, total], ignore_index=True)

    return run


class RollingMeanProcessor(StatefulProcessor):
    """Per-symbol rolling mean of the last ``n`` ticks with deviation alerts, over segments."""

    def __init__(self, n: int = SMA_WINDOW, min_ticks: int = SMA_MIN_TICKS,
                 threshold: float = ALERT_THRESHOLD):
        self.n = n
        self.min_ticks = min_ticks
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prices = handle.getListState("prices", "price double")
        self.stats = handle.getValueState("stats", STATS_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        if key[1] != BOUNDARY:
            for frame in rows:
                yield frame[RESULT_COLUMNS]
            return
        # at most 2 (n - 1) + 1 rows a segment
        df = _in_order(pd.concat(list(rows), ignore_index=True))
        sums, df = df[df["kind"] == "sum"], df[df["kind"] != "sum"]
        prev = np.array([r[0] for r in self.prices.get()], dtype=float) \
            if self.prices.exists() else np.zeros(0)
        prices = df["price"].to_numpy(dtype=float)
        res = rolling_frame(prev, prices, len(prev), self.n, self.min_ticks, self.threshold)
        tail = np.concatenate([prev, prices])[-(self.n - 1):] if self.n > 1 else []
        self.prices.put([(float(x),) for x in tail])
        head = (df["kind"] == "head").to_numpy()
        out = df.assign(**res)[head]
        # A2 session stats, kept per symbol in the state store.
        st = self.stats.get() if self.stats.exists() else (0, None, None, 0)
        low = [st[1], *sums["min_price"], *out["price"]]
        high = [st[2], *sums["max_price"], *out["price"]]
        known = lambda xs: [float(x) for x in xs if x is not None]
        self.stats.update((st[0] + len(out) + int(sums["ticks"].sum()), min(known(low)), max(known(high)),
                           st[3] + int(pd.notna(out["alert_type"]).sum()) + int(sums["alerts"].sum())))
        yield out[RESULT_COLUMNS]

    def close(self) -> None:
        pass


def newest_of_segment(n: int):
    """The function of one segment that keeps its newest ``n`` ticks."""
    return lambda df: _in_order(df[df["offset"].notna()]).tail(n)


def _micros(ts: pd.Series) -> pd.Series:
    """Timestamps (any pandas datetime unit or zone) → epoch microseconds (NaN for NaT)."""
    t = pd.to_datetime(ts, utc=True)
    return (t - pd.Timestamp(0, tz="UTC")) // pd.Timedelta(microseconds=1)


class TickStateProcessor(StatefulProcessor):
    """K2 + K3 in the state store: latest tick and the newest ``history_len`` ticks per symbol.

    Only the symbols of a micro-batch are read and written; readers scan the
    state with the state data source (``read_tick_state``) instead of a table
    rewritten every batch. Emits the new latest tick of each touched symbol
    (a change stream, e.g. for the live channel).
    """

    def __init__(self, history_len: int = 100):
        self.history_len = history_len

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", TICK_STATE)
        self.history = handle.getListState("history", TICK_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        # frame by frame: no more than history_len rows and one frame are held
        df = None
        for frame in rows:
            frame = frame if df is None else pd.concat([df, frame], ignore_index=True)
            df = _in_order(frame[frame["offset"].notna()]).tail(self.history_len)
        if df is None or df.empty:
            return
        ts_us = _micros(df["timestamp"])
        new = [(None if pd.isna(p) else float(p), None if pd.isna(v) else int(v),
                None if pd.isna(t) else int(t), s, int(pt), int(o))
               for p, v, t, s, pt, o in zip(df["price"], df["volume"], ts_us, df["source"],
                                            df["partition"], df["offset"])]
        old = list(self.history.get()) if self.history.exists() else []
        merged = (old + new)[-self.history_len:]
        self.history.put(merged)
        self.latest.update(merged[-1])
        last = merged[-1]
        yield pd.DataFrame([{"symbol": key[0], "price": last[0], "volume": last[1],
                             "ts_us": last[2], "source": last[3], "partition": last[4],
                             "offset": last[5]}])

    def close(self) -> None:
        pass
