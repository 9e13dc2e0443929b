"""Streaming jobs: named queries, triggers, checkpoints, lag metrics.

T1-T4  start_window_upsert   watermark 1 min, 5-min windows, update mode → K5 upsert
T4     start_window_final    same windows in append mode: final values only, file sink
T6     start_volume_alerts   append-mode alert query → K6
       start_tick_fanout     raw ticks → latest price (K2) + history (K3) in one scan
T5     start_rolling_state   transformWithStateInPandas rolling mean (keyed state);
                             read_rolling_state: A2 session stats from its state store
K2,K3  start_tick_state      latest tick + bounded history as keyed state; read_tick_state
       start_rolling_halo    foreachBatch rolling mean on the chunked batch operator,
                             last n-1 ticks per symbol kept as a snapshot between batches
S8     start_channel_reader  live table of the channels: last tick and last update per symbol
T7-T9  named queries, processing-time or available-now triggers, one checkpoint each
T10    await_any             wait for any query to end (with timeout)
T11    drain_and_stop        process everything available, then stop
T13    source_lag            end-vs-latest offsets of the last progress, as rows
K10    ProgressLog           listener recording every batch (rows, durations) of every query

Triggers of the original jobs: raw ticks every 3 s, window upserts every 10 s,
volume alerts every 5 s. Tests and oracle runs use ``availableNow``.
"""

from __future__ import annotations

import json
import sys
from collections import deque

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.alerts import volume_alerts
from ..operators.latest import channel_latest
from ..operators.rolling import DEFAULT_CHUNK, rolling_alerts
from ..operators.windows import window_aggregates
from ..schema import SMA_WINDOW, TICK_COLUMNS, TICK_SCHEMA, WATERMARK_DELAY, WINDOW_DURATION
from .sinks import (AlertAppendSink, SnapshotSink, WindowUpsertSink, _names, fan_out,
                    history_fold, latest_fold, replace_fold, start_channel_publish, stats_fold)
from .stateful import (LATEST_OUTPUT, ROLLING_OUTPUT, SEGMENT, SEGMENT_OUTPUT, STATS_STATE,
                       RollingMeanProcessor, TickStateProcessor, newest_of_segment, segment_means)

# Trigger intervals of the three original queries.
RAW_TRIGGER = {"processingTime": "3 seconds"}
WINDOW_TRIGGER = {"processingTime": "10 seconds"}
ALERT_TRIGGER = {"processingTime": "5 seconds"}
AVAILABLE_NOW = {"availableNow": True}

STATE_PROVIDER = ("org.apache.spark.sql.execution.streaming.state."
                  "RocksDBStateStoreProvider")


def persisted(fn):
    """Run a foreachBatch body on a persisted batch.

    Every action on the batch DataFrame would otherwise re-run the micro-batch
    plan (for stateful queries: the whole state-store update) once per action.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            fn(batch_df, batch_id)
        finally:
            batch_df.unpersist()
    return run


def _start(df: DataFrame, name: str, checkpoint: str, trigger: dict, output_mode: str,
           batch_fn=None, fmt: str | None = None, path: str | None = None):
    # A4: rows per micro-batch, reported in the progress' observedMetrics.
    df = df.observe(f"{name}_rows", F.count(F.lit(1)).alias("rows"))
    w = (df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(**trigger))
    if batch_fn is not None:
        w = w.foreachBatch(persisted(batch_fn))
    elif fmt is not None:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    return w.start()


def start_window_upsert(ticks: DataFrame, table: str, checkpoint: str,
                        trigger: dict = WINDOW_TRIGGER, duration: str = WINDOW_DURATION,
                        watermark: str = WATERMARK_DELAY, mode: str = "double",
                        name: str = "window_aggregates"):
    """5-minute windows, 1-minute watermark, update mode: changed windows are upserted."""
    agg = window_aggregates(ticks, duration, mode=mode, watermark=watermark)
    return _start(agg, name, checkpoint, trigger, "update", WindowUpsertSink(table))


def start_window_final(ticks: DataFrame, path: str, checkpoint: str,
                       trigger: dict = WINDOW_TRIGGER, duration: str = WINDOW_DURATION,
                       watermark: str = WATERMARK_DELAY, mode: str = "double",
                       name: str = "window_aggregates_final"):
    """T4 append option: each window written once, when the watermark passes its end.

    No partial values and no upsert: the native parquet file sink (exactly-once
    through its commit log), partitioned by window date.
    """
    agg = window_aggregates(ticks, duration, mode=mode, watermark=watermark)
    out = agg.withColumn("window_date", F.to_date("window_start"))
    w = (out.writeStream.queryName(name).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(**trigger).format("parquet").option("path", path)
         .partitionBy("window_date"))
    return w.start()


def start_volume_alerts(ticks: DataFrame, table: str, checkpoint: str,
                        trigger: dict = ALERT_TRIGGER, name: str = "volume_alerts",
                        reject_table: str | None = None):
    """Volume alerts appended per batch; alerts without a timestamp go to ``reject_table``."""
    return _start(volume_alerts(ticks), name, checkpoint, trigger, "append",
                  AlertAppendSink(table, reject_table))


def start_tick_fanout(ticks: DataFrame, latest_path: str, history_path: str, checkpoint: str,
                      trigger: dict = RAW_TRIGGER, history_len: int = 100,
                      name: str = "raw_ticks"):
    """Latest price and bounded history from one read of the raw ticks."""
    cols = list(TICK_COLUMNS)
    sink = fan_out(SnapshotSink(latest_path, latest_fold(cols)),
                   SnapshotSink(history_path, history_fold(cols, history_len)))
    return _start(ticks.select(*cols), name, checkpoint, trigger, "append", sink)


def _use_rocksdb(spark: SparkSession) -> None:
    """State-store settings for the Python stateful processors."""
    # Send the processors' module by value: Python workers (and the driver-side
    # runner that initialises the state schema) then need no tickworks install.
    cloudpickle.register_pickle_by_value(sys.modules[RollingMeanProcessor.__module__])
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def by_segment(ticks: DataFrame, segment: int):
    """The ticks of a micro-batch, grouped by symbol and a range of ``segment`` offsets of a partition."""
    return ticks.groupBy("symbol", "partition", F.expr(f"`offset` div {int(segment)}").alias("segment"))


def start_rolling_state(ticks: DataFrame, path: str, checkpoint: str,
                        trigger: dict = AVAILABLE_NOW, n: int = SMA_WINDOW,
                        name: str = "rolling_alerts", segment: int = SEGMENT):
    """T5: keyed state (RocksDB) carries the last n-1 prices of each symbol.

    A symbol's ticks of a micro-batch are cut by ``segment`` offsets; only the
    ends of a segment meet in the symbol's state (see ``stateful``).
    """
    spark = ticks.sparkSession
    _use_rocksdb(spark)
    cols = ticks.select("symbol", "partition", "offset", "timestamp", "price")
    out = (by_segment(cols, segment).applyInPandas(segment_means(n), SEGMENT_OUTPUT)
           .groupBy("symbol", "lane")
           .transformWithStateInPandas(RollingMeanProcessor(n=n), ROLLING_OUTPUT,
                                       "Append", "None"))
    return _start(out, name, checkpoint, trigger, "append", fmt="parquet", path=path)


def start_tick_state(ticks: DataFrame, path: str, checkpoint: str,
                     trigger: dict = AVAILABLE_NOW, history_len: int = 100,
                     name: str = "tick_state", segment: int = SEGMENT):
    """K2 + K3 as keyed state: latest tick and bounded history per symbol.

    The change stream (new latest tick of each touched symbol) is appended to
    ``path``; the full state is read with ``read_tick_state(spark, checkpoint)``.
    A segment of a hot symbol passes on its newest ``history_len`` ticks only.
    """
    spark = ticks.sparkSession
    _use_rocksdb(spark)
    cols = ticks.select("symbol", "partition", "offset", "timestamp", "price", "volume", "source")
    newest = by_segment(cols, segment).applyInPandas(newest_of_segment(history_len), cols.schema)
    out = (newest.groupBy("symbol")
           .transformWithStateInPandas(TickStateProcessor(history_len), LATEST_OUTPUT,
                                       "Append", "None"))
    return _start(out, name, checkpoint, trigger, "append", fmt="parquet", path=path)


def _ran(spark: SparkSession, checkpoint: str) -> bool:
    """Has the query of this checkpoint finished a batch?"""
    return any(name.isdigit() for name in _names(spark, f"{checkpoint}/commits"))


def read_tick_state(spark: SparkSession, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """(latest, history) per symbol from the state store of ``start_tick_state``.

    history carries ``rank`` (1 = newest); the ranking window runs over at most
    ``history_len`` rows per symbol.
    """
    if not _ran(spark, checkpoint):
        none = spark.createDataFrame([], TICK_SCHEMA).drop("kafka_timestamp")
        return none, none.withColumn("rank", F.lit(0).cast("bigint"))

    def ticks(df: DataFrame, col: str) -> DataFrame:
        return df.select(F.col("key.symbol").alias("symbol"), f"{col}.*").select(
            "symbol", "price", "volume", F.timestamp_micros("ts_us").alias("timestamp"),
            "source", "partition", "offset")
    latest = ticks(spark.read.format("statestore").option("stateVarName", "latest")
                   .load(checkpoint), "value")
    hist = ticks(spark.read.format("statestore").option("stateVarName", "history")
                 .load(checkpoint), "list_element")
    w = Window.partitionBy("symbol").orderBy(F.col("partition").desc(), F.col("offset").desc())
    return latest, hist.withColumn("rank", F.row_number().over(w).cast("bigint"))


def read_rolling_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """A2 from the state store of ``start_rolling_state``: ticks, min, max, alerts per symbol."""
    if not _ran(spark, checkpoint):
        return spark.createDataFrame([], f"symbol string, {STATS_STATE}")
    df = spark.read.format("statestore").option("stateVarName", "stats").load(checkpoint)  # boundary lanes only
    return df.select(F.col("key.symbol").alias("symbol"), "value.*")


def start_channel_reader(messages: DataFrame, path: str, checkpoint: str,
                         trigger: dict = RAW_TRIGGER, name: str = "channel_reader"):
    """Listen to the channels; the live table has each symbol's last tick and last update.

    One aggregate over messages parsed once, in update mode: a batch emits the
    symbols it touched, whose rows replace those of the snapshot under ``path``.
    """
    return _start(channel_latest(messages), name, checkpoint, trigger, "update",
                  SnapshotSink(path, replace_fold("symbol")))


class RollingHaloBatch:
    """foreachBatch body of ``start_rolling_halo``.

    Batch N: prior = tails snapshot below N (last n-1 ticks per symbol);
    output = chunked batch rolling mean of batch N with prior rows in the
    frames → appended as partition batch_id=N; tails version N = newest n-1
    ticks per symbol of prior ∪ batch N.
    """

    def __init__(self, out_path: str, tails_path: str, n: int = SMA_WINDOW,
                 chunk_size: int = DEFAULT_CHUNK, stats_path: str | None = None):
        self.out = AlertAppendSink(out_path)
        self.n = n
        self.chunk_size = chunk_size
        cols = ["symbol", "partition", "offset", "price"]
        self.tails = SnapshotSink(tails_path, history_fold(cols, n - 1))
        self.stats = SnapshotSink(stats_path, stats_fold()) if stats_path else None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        spark = batch_df.sparkSession
        batch_df.persist()
        try:
            prior = self.tails.previous(spark, batch_id)
            res = rolling_alerts(batch_df, n=self.n, chunk_size=self.chunk_size,
                                 exact4=True, prior=prior)
            if self.stats is None:
                self.out.append(res, batch_id)   # not empty: tested above
            else:
                res = res.persist()
                self.out.append(res, batch_id)
                self.stats(res, batch_id)
                res.unpersist()
            self.tails(batch_df.where(F.col("price").isNotNull()), batch_id)
        finally:
            batch_df.unpersist()


def start_rolling_halo(ticks: DataFrame, out_path: str, tails_path: str, checkpoint: str,
                       trigger: dict = AVAILABLE_NOW, n: int = SMA_WINDOW,
                       chunk_size: int = DEFAULT_CHUNK, stats_path: str | None = None,
                       name: str = "rolling_alerts_halo"):
    body = RollingHaloBatch(out_path, tails_path, n, chunk_size, stats_path)
    return _start(ticks.select(*TICK_COLUMNS), name, checkpoint, trigger, "append", body)


def start_tick_jobs(ticks: DataFrame, root: str, trigger: dict | None = None, state: str = "keyed") -> dict:
    """The three original queries, concurrently, each named and checkpointed.

    raw_ticks (latest + history, every 3 s), window_aggregates (upsert, every
    10 s) and volume_alerts (append, every 5 s) under ``root``, and the per-symbol
    publish of every tick (tick_channel, every 3 s). Alerts without a timestamp go
    to ``alert_rejects``. Each query reads the source on its own (independent
    triggers); ``trigger`` overrides all four.

    ``state="keyed"`` holds latest price and history in the state store of raw_ticks, where a
    batch writes only the symbols it touched; read them with ``read_tick_jobs``.
    ``state="snapshot"`` rewrites all symbols as tables under ``latest`` and ``history`` each batch,
    for readers without the state data source. A checkpoint of one form does not go on with the other.
    """
    if state not in ("keyed", "snapshot"):
        raise ValueError(f"state is keyed or snapshot, not {state!r}")
    raw = dict(checkpoint=f"{root}/ckpt/raw_ticks", trigger=trigger or RAW_TRIGGER, name="raw_ticks")
    return {
        "raw_ticks": (start_tick_state(ticks, f"{root}/latest_changes", **raw) if state == "keyed"
                      else start_tick_fanout(ticks, f"{root}/latest", f"{root}/history", **raw)),
        "window_aggregates": start_window_upsert(ticks, f"{root}/windows",
                                                 f"{root}/ckpt/windows",
                                                 trigger or WINDOW_TRIGGER),
        "volume_alerts": start_volume_alerts(ticks, f"{root}/alerts", f"{root}/ckpt/alerts",
                                             trigger or ALERT_TRIGGER,
                                             reject_table=f"{root}/alert_rejects"),
        "tick_channel": start_channel_publish(ticks, f"{root}/channel", f"{root}/ckpt/channel",
                                              trigger or RAW_TRIGGER),
    }


def read_tick_jobs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(latest, history) of ``start_tick_jobs`` with keyed state; empty before its first batch."""
    return read_tick_state(spark, f"{root}/ckpt/raw_ticks")


def await_any(spark: SparkSession, timeout_s: float | None = None,
              reset: bool = False) -> bool:
    """Block until any query ends (or the timeout passes).

    Queries that ended earlier in the session count until ``resetTerminated``;
    ``reset=True`` clears them first so only the active ones are awaited.
    """
    if reset:
        spark.streams.resetTerminated()
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(timeout_s))   # in seconds


def drain_and_stop(query) -> None:
    """Finish what is available, then stop (graceful stop)."""
    query.processAllAvailable()
    query.stop()


def source_lag(spark: SparkSession, query) -> DataFrame:
    """Per source of the last progress, its end and latest offsets (JSON text).

    For Kafka sources the offsets are {topic: {partition: offset}}; the lag of a
    partition is latest - end. Progress is metadata, read on the driver.
    """
    prog = query.lastProgress or {}
    rows = [(query.name, s.get("description"), json.dumps(s.get("endOffset")),
             json.dumps(s.get("latestOffset")), int(s.get("numInputRows") or 0))
            for s in prog.get("sources", [])]
    return spark.createDataFrame(
        rows, "query string, source string, end_offset string, latest_offset string, "
              "num_input_rows bigint")


def partition_lag(spark: SparkSession, query) -> DataFrame:
    """(query, topic, partition, lag) = latest - end offset of the last progress.

    For sources whose offsets are {topic: {partition: offset}} (Kafka); others
    give no rows. One row per topic partition, from driver-side metadata.
    """
    def offsets(x) -> dict:
        return x if isinstance(x, dict) and all(isinstance(v, dict) for v in x.values()) else {}

    rows = []
    last_progress = query.lastProgress
    for s in json.loads(last_progress.json)["sources"] if last_progress else []:
        end, latest = offsets(s.get("endOffset")), offsets(s.get("latestOffset"))
        rows += [(query.name, topic, int(p), int(last) - int(end.get(topic, {}).get(p, 0)))
                 for topic, parts in latest.items() for p, last in parts.items()]
    return spark.createDataFrame(rows, "query string, topic string, partition int, lag bigint")


class ProgressLog(StreamingQueryListener):
    """Per-batch log of all queries of a session (rows written, batch id, timings).

    ``spark.streams.addListener(log)``; ``log.to_df(spark)`` returns the events
    so far as rows. Progress events are driver-side metadata, one per batch; the
    newest ``max_events`` are held.
    """

    def __init__(self, max_events: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=max_events)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        observed = p.get("observedMetrics") or {}
        obs_rows = next((int(v.get("rows", 0)) for v in observed.values()), None)
        d = p.get("durationMs") or {}
        self.rows.append((p.get("name"), int(p["batchId"]), int(p.get("numInputRows") or 0),
                          obs_rows, int(d.get("addBatch", 0)), int(d.get("triggerExecution", 0))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            list(self.rows), "query string, batch_id bigint, input_rows bigint, output_rows bigint, "
                       "add_batch_ms bigint, trigger_ms bigint")
