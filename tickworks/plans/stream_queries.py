"""Registered streaming queries.

Each one replays the whole ``events`` table as Kafka-shaped records (4 parts of
several files, one part per trigger, in offset order), runs a Structured Streaming query with
``availableNow`` through the real sink, waits for it, and returns the sink
table read back as a batch DataFrame. With in-order files no row is late, so
the oracle is the batch SQL of the same operator. The session's shuffle
partitions hold: set them before the first run of a stateful stream.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from ..operators.ingest import parse_ticks
from ..operators.windows import WINDOW_COLUMNS, window_aggregates, windows_since
from ..schema import ALERT_SCHEMA, CHANNEL_SCHEMA, TICK_SCHEMA, WINDOW_AGG_SCHEMA
from ..session import checkpoint_root, work_dir
from ..sources.fixtures import kafka_records_from_ticks
from ..sources.streams import archive_read, archive_stream, replay_stream, write_replay_files
from ..streaming import jobs
from ..streaming.sinks import (AlertAppendSink, SnapshotSink, history_fold, read_appended,
                               path_exists, read_channel, read_snapshot, read_table,
                               read_window_table, start_archive, start_channel_publish)
from ..streaming.stateful import ROLLING_OUTPUT
from .catalog import (_AVG_EXACT, _TS_TEXT, _VOLUME_ALERTS_SQL, _WINDOW_SQL, _history_sql,
                      _rolling_sql, _ROLLING_SELECT, _ticks_sql, event_ticks, register)

REPLAY_PARTS = 4
RECORDS_PER_FILE = 1 << 20
_replays: dict[tuple[str, str], tuple[str, int]] = {}


def replay_records(spark, sf_dir: str) -> tuple[str, int]:
    """(glob, files per part) of the events ticks' replay, written once per process and checkpoint root.

    Each part has at least two writers, and one per ``RECORDS_PER_FILE`` offsets beyond.
    """
    key = (checkpoint_root(spark), sf_dir)
    if key not in _replays:
        records = kafka_records_from_ticks(event_ticks(spark, sf_dir))
        _replays[key] = write_replay_files(records, work_dir(spark, "replay"), REPLAY_PARTS,
                                           files_per_part=_files(records))
    return _replays[key]


def _files(records) -> int:
    lo, hi = records.select(F.min("offset"), F.max("offset")).first()
    return 2 if lo is None else max(2, (hi - lo) // (REPLAY_PARTS * RECORDS_PER_FILE) + 1)


def stream_ticks(spark, sf_dir: str):
    glob, files = replay_records(spark, sf_dir)
    return parse_ticks(replay_stream(spark, glob, max_files_per_trigger=files))


FINAL_SCHEMA = StructType([*WINDOW_AGG_SCHEMA.fields, StructField("window_date", DateType())])
HISTORY_SCHEMA = StructType([*TICK_SCHEMA.fields, StructField("rank", LongType())])
APPENDED_SCHEMA = StructType([*ALERT_SCHEMA.fields, StructField("partition", IntegerType()), StructField("offset", LongType())])
STATS_SCHEMA = "symbol string, ticks bigint, min_price double, max_price double, alerts bigint"


def _or_empty(spark, path, read, schema):
    """``read()`` of a sink's table, or no rows where no batch has written it."""
    found = read() if path_exists(spark, path) else None
    return spark.createDataFrame([], schema) if found is None else found


def _snapshot(spark, path, schema):
    return _or_empty(spark, path, lambda: read_snapshot(spark, path), schema)


def _appended(spark, path, schema=APPENDED_SCHEMA):
    return _or_empty(spark, path, lambda: read_appended(spark, path), schema)


def _stored_windows(table):
    """Rows of the stored window table with prices as doubles."""
    return table.select(*[F.col(c).cast("double").alias(c) if c.endswith("_price") else F.col(c) for c in WINDOW_COLUMNS])


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name} failed: {query.exception()}")


@register("window_agg_stream",
          _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT))
def window_agg_stream(spark, sf_dir):
    """Watermarked 5-minute windows in update mode, upserted per batch."""
    root = work_dir(spark, "window_agg_stream")
    q = jobs.start_window_upsert(stream_ticks(spark, sf_dir), f"{root}/table", f"{root}/ckpt",
                                 trigger=jobs.AVAILABLE_NOW, mode="exact")
    _run(q)
    return _stored_windows(read_window_table(spark, f"{root}/table"))


@register("window_agg_stream_final", f"""
SELECT * FROM ({_WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT)}) w
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'""")
def window_agg_stream_final(spark, sf_dir):
    """T4 append mode: only windows closed by the final watermark (max event time - 1 min)."""
    root = work_dir(spark, "window_agg_final")
    q = jobs.start_window_final(stream_ticks(spark, sf_dir), f"{root}/table", f"{root}/ckpt",
                                trigger=jobs.AVAILABLE_NOW, mode="exact")
    _run(q)
    return read_table(spark, f"{root}/table", FINAL_SCHEMA).select(*WINDOW_COLUMNS)


LATE_PARTS = 6
LATE_EVERY, LATE_BY = 11, 4

_LATE_SQL = f"""
WITH e AS (
  SELECT *, least({LATE_PARTS - 1}, (event_id - lo) // step
    + CASE WHEN event_id % {LATE_EVERY} = 0 THEN 1 + event_id % {LATE_BY} ELSE 0 END) AS part
  FROM (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // {LATE_PARTS} + 1 AS step FROM events) s, events),
b AS (SELECT *, dense_rank() OVER (ORDER BY part) AS batch FROM e),
tops AS (SELECT batch, max(ts) AS top FROM b GROUP BY batch),
marks AS (SELECT x.batch, (SELECT max(top) FROM tops y WHERE y.batch <= x.batch - 2) - INTERVAL '1 minute' AS mark FROM tops x),
kept AS (
  SELECT b.* FROM b JOIN marks USING (batch)
  WHERE mark IS NULL OR time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' > mark)
""" + _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT).replace("FROM events", "FROM kept")


@register("window_agg_late", _LATE_SQL)
def window_agg_late(spark, sf_dir):
    """Every 11th record arrives one to four parts late.

    A late row whose window still is open is merged, one whose window ended before the
    watermark of the batch before its own is dropped. That watermark is a minute
    behind the newest event time of the batches before.
    """
    root = work_dir(spark, "window_agg_late")
    records = kafka_records_from_ticks(event_ticks(spark, sf_dir))
    lo, hi = records.select(F.min("offset"), F.max("offset")).first()
    step = 1 if lo is None else (hi - lo) // LATE_PARTS + 1
    late = F.when(F.col("offset") % LATE_EVERY == 0, 1 + F.col("offset") % LATE_BY).otherwise(0)
    part = F.least(F.lit(LATE_PARTS - 1), F.floor((F.col("offset") - (lo or 0)) / step) + late)
    glob, files = write_replay_files(records.withColumn("delivered", part), f"{root}/in", LATE_PARTS,
                                     order_col="delivered", files_per_part=_files(records))
    ticks = parse_ticks(replay_stream(spark, glob, max_files_per_trigger=files))
    _run(jobs.start_window_upsert(ticks, f"{root}/table", f"{root}/ckpt", trigger=jobs.AVAILABLE_NOW, mode="exact"))
    return _stored_windows(read_window_table(spark, f"{root}/table"))


@register("windows_last_hour_stored", f"""
SELECT * FROM ({_WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT)}) w
WHERE window_start > (SELECT max(ts) FROM events) - INTERVAL '1 hour' AND symbol = (SELECT min(event_type) FROM events)""")
def windows_last_hour_stored(spark, sf_dir):
    """A symbol's windows of the last hour, read from the stored table: other dates and symbols are not read."""
    root = work_dir(spark, "windows_stored")
    ticks = event_ticks(spark, sf_dir)
    _run(jobs.start_window_upsert(stream_ticks(spark, sf_dir), f"{root}/table", f"{root}/ckpt",
                                  trigger=jobs.AVAILABLE_NOW, mode="exact"))
    as_of, symbol = ticks.agg(F.max("timestamp"), F.min("symbol")).first()
    if as_of is None:
        return _stored_windows(read_window_table(spark, f"{root}/table"))
    since = as_of - timedelta(hours=1)
    return _stored_windows(windows_since(read_window_table(spark, f"{root}/table", since=since, symbol=symbol), F.lit(since)))


@register("volume_alerts_stream", _VOLUME_ALERTS_SQL)
def volume_alerts_stream(spark, sf_dir):
    """Append-mode volume alerts, one idempotent partition per batch."""
    root = work_dir(spark, "volume_alerts_stream")
    q = jobs.start_volume_alerts(stream_ticks(spark, sf_dir), f"{root}/table", f"{root}/ckpt",
                                 trigger=jobs.AVAILABLE_NOW)
    _run(q)
    return _appended(spark, f"{root}/table").select(
        "symbol", "price", "volume", "alert_type", "timestamp", "partition", "offset")


def _fanout(spark, sf_dir):
    root = work_dir(spark, "tick_fanout")
    q = jobs.start_tick_fanout(stream_ticks(spark, sf_dir), f"{root}/latest",
                               f"{root}/history", f"{root}/ckpt", trigger=jobs.AVAILABLE_NOW)
    _run(q)
    return root


@register("latest_price_stream", f"""WITH {_ticks_sql()}
SELECT symbol, arg_max(price, "offset") AS price FROM ticks GROUP BY symbol""")
def latest_price_stream(spark, sf_dir):
    """K2: latest price per symbol kept as a versioned snapshot across batches."""
    root = _fanout(spark, sf_dir)
    return _snapshot(spark, f"{root}/latest", TICK_SCHEMA).select("symbol", "price")


@register("history_stream", _history_sql(100))
def history_stream(spark, sf_dir):
    """K3: newest 100 ticks per symbol, bounded snapshot rebuilt per batch."""
    root = _fanout(spark, sf_dir)
    return _snapshot(spark, f"{root}/history", HISTORY_SCHEMA).select(
        "symbol", "offset", "timestamp", "price", "rank")


@register("rolling_alerts_stream", _rolling_sql("event_type") + _ROLLING_SELECT)
def rolling_alerts_stream(spark, sf_dir):
    """T5: stateful rolling mean + alerts (transformWithStateInPandas, RocksDB state)."""
    root = work_dir(spark, "rolling_alerts_stream")
    q = jobs.start_rolling_state(stream_ticks(spark, sf_dir), f"{root}/out", f"{root}/ckpt")
    _run(q)
    out = read_table(spark, f"{root}/out", StructType.fromDDL(ROLLING_OUTPUT))
    return out.select("symbol", "offset", "price", F.col("sma4").alias("sma"), "alert_type")


@register("rolling_alerts_stream_halo", _rolling_sql("event_type") + _ROLLING_SELECT)
def rolling_alerts_stream_halo(spark, sf_dir):
    """T5 on the chunked batch operator: tails snapshot carries the last 9 ticks."""
    root = work_dir(spark, "rolling_alerts_halo")
    q = jobs.start_rolling_halo(stream_ticks(spark, sf_dir), f"{root}/out", f"{root}/tails",
                                f"{root}/ckpt", chunk_size=64)
    _run(q)
    out = _appended(spark, f"{root}/out", ROLLING_OUTPUT)
    return out.select("symbol", "offset", "price", F.col("sma4").alias("sma"), "alert_type")


@register("session_stats_stream", _rolling_sql("event_type") + """
SELECT symbol, count(*) AS ticks, min(price) AS min_price, max(price) AS max_price,
       count(alert_type) AS alerts
FROM a GROUP BY symbol""")
def session_stats_stream(spark, sf_dir):
    """A2 in streaming: running stats merged batch by batch into a snapshot."""
    root = work_dir(spark, "session_stats_stream")
    q = jobs.start_rolling_halo(stream_ticks(spark, sf_dir), f"{root}/out", f"{root}/tails",
                                f"{root}/ckpt", stats_path=f"{root}/stats")
    _run(q)
    return _snapshot(spark, f"{root}/stats", STATS_SCHEMA).select(
        "symbol", "ticks", "min_price", "max_price", "alerts")


@register("archive_replay", _WINDOW_SQL.format(d="1 hour", sym="event_type", avg=_AVG_EXACT))
def archive_replay(spark, sf_dir):
    """K8 + S9: archive raw ticks (date-partitioned file sink), replay them into windows."""
    root = work_dir(spark, "archive")
    q = start_archive(stream_ticks(spark, sf_dir), f"{root}/ticks", f"{root}/ckpt",
                      trigger=jobs.AVAILABLE_NOW)
    _run(q)
    return window_aggregates(archive_read(spark, f"{root}/ticks"), "1 hour", mode="exact")


@register("archive_stream_replay", _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT))
def archive_stream_replay(spark, sf_dir):
    """The archive streamed through its commit log into the upserted window table."""
    root = work_dir(spark, "archive_stream")
    _run(start_archive(stream_ticks(spark, sf_dir), f"{root}/ticks", f"{root}/ckpt", trigger=jobs.AVAILABLE_NOW))
    # one batch: files of one date come in no order of event time, which later batches could call late
    _run(jobs.start_window_upsert(archive_stream(spark, f"{root}/ticks"), f"{root}/table", f"{root}/ckpt2",
                                  trigger=jobs.AVAILABLE_NOW, mode="exact"))
    return _stored_windows(read_window_table(spark, f"{root}/table"))


_CHANNEL_SQL = f"""
SELECT symbol, arg_max(value, event_id) AS price,
       arg_max(CAST(json_extract_string(props, '$.k') AS BIGINT) * 20000, event_id) AS volume,
       arg_max({_TS_TEXT}, event_id) AS timestamp,
       'synthetic' AS source, max(ts) AS last_update
FROM (SELECT *, event_type AS symbol FROM events) e
GROUP BY symbol"""
_LIVE_COLUMNS = ["symbol", "price", "volume", "timestamp", "source", "last_update"]
LIVE_FILES = 256


@register("channel_stream", _CHANNEL_SQL)
def channel_stream(spark, sf_dir):
    """K4 + S8: ticks published per symbol channel, read back by a channel reader."""
    from ..operators.latest import channel_latest
    root = work_dir(spark, "channel")
    q = start_channel_publish(stream_ticks(spark, sf_dir), f"{root}/chan", f"{root}/ckpt",
                              trigger=jobs.AVAILABLE_NOW)
    _run(q)
    return channel_latest(read_channel(spark, f"{root}/chan")).select(*_LIVE_COLUMNS)


@register("channel_live_stream", _CHANNEL_SQL)
def channel_live_stream(spark, sf_dir):
    """The channel reader as a stream, several batches into one live table."""
    root = work_dir(spark, "channel_live")
    _run(start_channel_publish(stream_ticks(spark, sf_dir), f"{root}/chan", f"{root}/ckpt",
                               trigger=jobs.AVAILABLE_NOW))
    messages = (spark.readStream.schema(CHANNEL_SCHEMA).option("maxFilesPerTrigger", LIVE_FILES)
                .parquet(f"{root}/chan"))
    _run(jobs.start_channel_reader(messages, f"{root}/live", f"{root}/ckpt2", trigger=jobs.AVAILABLE_NOW))
    return _snapshot(spark, f"{root}/live", "symbol string, price double, volume bigint, timestamp string, "
                                            "source string, last_update timestamp").select(*_LIVE_COLUMNS)


def _batches(df, n: int = 4):
    """Split a table into ``n`` delivery batches by offset range (each one a DataFrame)."""
    lo, hi = df.select(F.min("offset"), F.max("offset")).first()
    if lo is None:
        return []
    step = (hi - lo) // n + 1
    return [df.where((F.col("offset") >= lo + i * step) & (F.col("offset") < lo + (i + 1) * step))
            for i in range(n)]


@register("alert_sink_replay", _VOLUME_ALERTS_SQL)
def alert_sink_replay(spark, sf_dir):
    """K6 replay: every batch of alerts delivered twice with the same batch id."""
    from ..operators.alerts import volume_alerts
    path = work_dir(spark, "alert_replay")
    sink = AlertAppendSink(path)
    for i, b in enumerate(_batches(event_ticks(spark, sf_dir))):
        sink(volume_alerts(b), i)
        sink(volume_alerts(b), i)
    return _appended(spark, path).select(
        "symbol", "price", "volume", "alert_type", "timestamp", "partition", "offset")


@register("history_sink", _history_sql(100))
def history_sink(spark, sf_dir):
    """K3 replay: the bounded history snapshot fed batch by batch, each batch twice."""
    from ..schema import TICK_COLUMNS
    path = work_dir(spark, "history_replay")
    sink = SnapshotSink(path, history_fold(list(TICK_COLUMNS), 100))
    for i, b in enumerate(_batches(event_ticks(spark, sf_dir))):
        sink(b, i)
        sink(b, i)
    return _snapshot(spark, path, HISTORY_SCHEMA).select("symbol", "offset", "timestamp", "price", "rank")


def _tick_state(spark, sf_dir):
    root = work_dir(spark, "tick_state")
    q = jobs.start_tick_state(stream_ticks(spark, sf_dir), f"{root}/changes", f"{root}/ckpt")
    _run(q)
    return jobs.read_tick_state(spark, f"{root}/ckpt")


@register("latest_price_state", f"""WITH {_ticks_sql()}
SELECT symbol, arg_max(price, "offset") AS price FROM ticks GROUP BY symbol""")
def latest_price_state(spark, sf_dir):
    """K2 as keyed state: latest tick per symbol read from the state store."""
    latest, _ = _tick_state(spark, sf_dir)
    return latest.select("symbol", "price")


@register("history_state", _history_sql(100))
def history_state(spark, sf_dir):
    """K3 as keyed state: newest 100 ticks per symbol read from the state store."""
    _, hist = _tick_state(spark, sf_dir)
    return hist.select("symbol", "offset", "timestamp", "price", "rank")


@register("session_stats_state", _rolling_sql("event_type") + """
SELECT symbol, count(*) AS ticks, min(price) AS min_price, max(price) AS max_price,
       count(alert_type) AS alerts
FROM a GROUP BY symbol""")
def session_stats_state(spark, sf_dir):
    """A2 as keyed state of the stateful rolling mean, read from its state store."""
    root = work_dir(spark, "rolling_state_stats")
    q = jobs.start_rolling_state(stream_ticks(spark, sf_dir), f"{root}/out", f"{root}/ckpt")
    _run(q)
    return jobs.read_rolling_state(spark, f"{root}/ckpt").select(
        "symbol", "ticks", "min_price", "max_price", "alerts")
