"""Restart-safe sinks for ``foreachBatch`` and the native file sink.

K5  WindowUpsertSink   keyed upsert of window aggregates on (window_start, symbol)
K6  AlertAppendSink    append, idempotent per batch id
K2  SnapshotSink(latest_fold)   latest tick per symbol
K3  SnapshotSink(history_fold)  newest N ticks per symbol
A2  SnapshotSink(stats_fold)    running session stats per symbol
K7  every sink skips an empty batch
K8  start_archive      raw ticks → parquet partitioned by event_date (exactly-once file sink)
K4  start_channel_publish  channels of tick JSON messages, by date and bucket of symbols
K1/K4 kafka_sink_options / start_kafka_publish  keyed JSON records to a topic

Every write is set-based and runs on the executors; nothing is collected to
the driver except directory listings. Rows are keyed by the stream's id (kept
in its checkpoint) and the batch id: a batch re-delivered after a crash rewrites
only its own folder or finds its snapshot version committed, and a stream that
starts again at batch 0 with a new checkpoint touches nothing written before.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.history import last_n_ticks
from ..operators.latest import latest_tick
from ..schema import CHANNEL_SCHEMA, PRICE_DECIMAL, STORED_WINDOW_SCHEMA


def query_id(spark: SparkSession) -> str:
    """Id of the stream that runs this batch; ``direct`` for a sink called by hand."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


# ---------------------------------------------------------------------------
# File-system helpers (Hadoop FileSystem of the path: local, HDFS, object store)
# ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def committed_versions(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(number, folder, commit time in ms) of the snapshot versions whose job committed."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version="):
            mark = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(mark):
                out.append((int(name.split("=", 1)[1].split(".")[0]), name,
                            fs.getFileStatus(mark).getModificationTime()))
    return sorted(out)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def _skip(batch_df: DataFrame) -> bool:
    """K7: an empty micro-batch writes nothing."""
    return batch_df.isEmpty()


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A sink table, empty where no batch has written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> bool:
    """Write a small file; False where it exists and ``overwrite`` is off."""
    fs, p, _ = _fs(spark, path)
    try:
        out = fs.create(p, overwrite)
    except Py4JJavaError:
        if overwrite or not fs.exists(p):
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


# ---------------------------------------------------------------------------
# K5 keyed upsert
# ---------------------------------------------------------------------------

BATCH_BITS = 40             # seq = epoch of the stream, then its batch id
COMPACT_AFTER = 64          # changes of one date before they are folded


def stream_epoch(spark: SparkSession, path: str, query: str) -> int:
    """Number of a stream among those that ever wrote to the table: later ones are higher.

    A stream claims the next number when it first writes, as a file that only one
    can create, so the order of streams does not hang on any clock.
    """
    folder = f"{path}/_streams"
    while True:
        names = _names(spark, folder)
        for name in names[::-1]:
            if _read_text(spark, f"{folder}/{name}") == query:
                return int(name)
        new = int(names[-1]) + 1 if names else 0
        if _write_text(spark, f"{folder}/{new:06d}", query, overwrite=False):
            return new


class WindowUpsertSink:
    """Upsert window rows keyed by (window_start, symbol), kept as a log of changes.

    A batch writes only its own rows, under (``window_date``, ``change``), where a
    change is named by the stream's epoch and the batch id; no earlier row is read
    or moved, so a crash loses nothing and the batch that is delivered again
    rewrites its own folders. Changes are ordered by epoch and batch id (``seq``),
    never by a clock: ``read_window_table`` takes each key's highest.

    A date with ``compact_after`` changes is folded by the batch that finds it so
    (``compact_window_date``), so readers of a date open at most about twice as
    many folders however many batches a day has. Prices are stored as decimal(12,4); one that
    does not fit is stored as null.
    """

    def __init__(self, path: str, time_col: str = "window_start", query: str | None = None,
                 compact_after: int = COMPACT_AFTER):
        self.path = path
        self.time_col = time_col
        self.query = query
        self.compact_after = compact_after
        self._epochs: dict[str, int] = {}

    def epoch(self, spark: SparkSession) -> int:
        query = self.query or query_id(spark)
        if query not in self._epochs:
            self._epochs[query] = stream_epoch(spark, self.path, query)
        return self._epochs[query]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if _skip(batch_df):
            return
        spark = batch_df.sparkSession
        epoch = self.epoch(spark)
        change = f"{epoch:06d}-{batch_id:012d}"
        prices = {c: F.col(c).try_cast(PRICE_DECIMAL) for c in ("avg_price", "min_price", "max_price") if c in batch_df.columns}
        rows = (batch_df.withColumns(prices)
                .withColumn("created_at", F.current_timestamp())
                .withColumn("changed_at", F.current_timestamp())
                .withColumn("seq", F.lit((epoch << BATCH_BITS) + batch_id).cast("bigint"))
                .withColumn("window_date", F.to_date(self.time_col))
                .withColumn("change", F.lit(change)))
        _write_changes(rows, self.path)
        if self.compact_after:
            for r in rows.select("window_date").distinct().collect():    # dates of one micro-batch
                if len(_changes(spark, self.path, r.window_date)) >= self.compact_after:
                    compact_window_date(spark, self.path, str(r.window_date), change)


def _write_changes(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("window_date", "change").parquet(path))


def _changes(spark: SparkSession, path: str, day) -> list[str]:
    """Names of a date's change folders."""
    return [n.split("=", 1)[1] for n in _names(spark, f"{path}/window_date={day}") if n.startswith("change=")]


def _since(df: DataFrame, since, time_col: str, date_col: str) -> DataFrame:
    """Rows at or after ``since``; the bound on the partition date prunes the scan."""
    if since is None:
        return df
    at = F.lit(since).cast("timestamp")
    return df.where((F.col(date_col) >= F.to_date(at)) & (F.col(time_col) >= at))


def _newest_changes(log: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per key: the values of its highest ``seq`` and its first ``created_at`` (a hash aggregate).

    A key occurs once in a change, and rows that were folded keep their ``seq``, so
    rows of equal ``seq`` are equal.
    """
    keys = ["window_date", *key]
    rest = [c for c in log.columns if c not in [*keys, "change", "created_at", "seq"]]
    return log.groupBy(*keys).agg(*[F.max_by(c, "seq").alias(c) for c in rest],
                                  F.min("created_at").alias("created_at"), F.max("seq").alias("seq"))


def read_window_table(spark: SparkSession, path: str, since=None, symbol: str | None = None,
                      key: tuple[str, ...] = ("window_start", "symbol")) -> DataFrame:
    """The upserted window table, one row per window and symbol.

    ``since`` and ``symbol`` are looked up before changes are folded (W7): the time bound
    prunes dates, the symbol is pushed to the scan.
    """
    log = _since(read_table(spark, path, STORED_WINDOW_SCHEMA), since, "window_start", "window_date")
    if symbol is not None:
        log = log.where(F.col("symbol") == F.lit(symbol))
    return _newest_changes(log, key)


def compact_window_date(spark: SparkSession, path: str, day: str, change: str,
                        key: tuple[str, ...] = ("window_start", "symbol")) -> None:
    """Fold the changes of a date into one, named after the change that asks for it.

    What a fold covers is listed beside the table after the fold is written, and is
    deleted by the next fold of the date only: readers in flight keep their files for
    that long, a crash or a second delivery folds again, and a change written
    meanwhile is in no list, so it stays.
    """
    own = f"folded-{change}"
    names = [n for n in _changes(spark, path, day) if n != own]
    lists = f"{path}/_folded/{day}"
    done = [n for n in _names(spark, lists) if n != own]
    log = read_table(spark, path, STORED_WINDOW_SCHEMA).where(
        (F.col("window_date") == F.lit(day).cast("date")) & F.col("change").isin(names))
    _write_changes(_newest_changes(log, key).withColumn("change", F.lit(own)), path)
    _write_text(spark, f"{lists}/{own}", "\n".join(names), overwrite=True)
    for fold in done:
        for name in _read_text(spark, f"{lists}/{fold}").split("\n"):
            _delete(spark, f"{path}/window_date={day}/change={name}")
        _delete(spark, f"{lists}/{fold}")


# ---------------------------------------------------------------------------
# K6 idempotent append
# ---------------------------------------------------------------------------

class AlertAppendSink:
    """Append each batch under its own ``batch_id`` (re-delivery replaces exactly it).

    Partitioned by (``<time_col>`` date, query_id, batch_id): a replayed batch rewrites
    only its own folders, and readers of recent alerts prune by date instead of
    listing every batch ever written. With ``reject_path``, rows whose time is
    null (an alert table keyed by time cannot hold them) go to that table.
    """

    def __init__(self, path: str, reject_path: str | None = None,
                 time_col: str = "timestamp", query: str | None = None):
        self.path = path
        self.reject_path = reject_path
        self.time_col = time_col
        self.query = query

    def _write(self, df: DataFrame, path: str, batch_id: int) -> None:
        parts = ["query_id", "batch_id"]
        if self.time_col in df.columns:
            df = df.withColumn("alert_date", F.to_date(self.time_col))
            parts = ["alert_date", *parts]
        (df.withColumn("created_at", F.current_timestamp())
         .withColumn("query_id", F.lit(self.query or query_id(df.sparkSession)))
         .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(path))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if not _skip(batch_df):
            self.append(batch_df, batch_id)

    def append(self, batch_df: DataFrame, batch_id: int) -> None:
        if self.reject_path is None or self.time_col not in batch_df.columns:
            self._write(batch_df, self.path, batch_id)
            return
        self._write(batch_df.where(F.col(self.time_col).isNotNull()), self.path, batch_id)
        bad = batch_df.where(F.col(self.time_col).isNull())
        if not bad.isEmpty():
            self._write(bad, self.reject_path, batch_id)


def read_appended(spark: SparkSession, path: str, since=None,
                  time_col: str = "timestamp") -> DataFrame:
    """All appended rows, or those at or after ``since`` (other dates are not read)."""
    return _since(spark.read.parquet(path), since, time_col, "alert_date")


# ---------------------------------------------------------------------------
# Versioned snapshots (K2 latest price, K3 history, A2 session stats)
# ---------------------------------------------------------------------------

Fold = Callable[[DataFrame | None, DataFrame], DataFrame]


class SnapshotSink:
    """Keep a small per-symbol state table as numbered versions.

    A batch's version = ``fold(newest version, batch)``; its folder is named by a
    running number, the stream's id and the batch id, so a batch delivered again
    is found committed and a stream with a new checkpoint goes on from the newest
    version. The state is bounded per symbol (latest tick, N ticks, one stats
    row), so a version is small. Versions go when they are older than ``keep_s``
    seconds, for readers in flight, and never the two newest.
    """

    def __init__(self, path: str, fold: Fold, keep_s: float = 600.0, query: str | None = None):
        self.path = path
        self.fold = fold
        self.keep_s = keep_s
        self.query = query

    def _mark(self, spark: SparkSession, batch_id: int) -> str:
        return f".{self.query or query_id(spark)}.{batch_id}"

    def previous(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The version that ``batch_id`` is folded into."""
        older, mark = [], self._mark(spark, batch_id)
        for _, name, _ in committed_versions(spark, self.path):
            if name.endswith(mark):
                break
            older.append(name)
        return spark.read.parquet(f"{self.path}/{older[-1]}") if older else None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if _skip(batch_df):
            return
        spark = batch_df.sparkSession
        versions, mark = committed_versions(spark, self.path), self._mark(spark, batch_id)
        if any(name.endswith(mark) for _, name, _ in versions):
            return
        number = versions[-1][0] + 1 if versions else 0
        snap = self.fold(self.previous(spark, batch_id), batch_df)
        snap.write.mode("overwrite").parquet(f"{self.path}/version={number:010d}{mark}")
        for _, name, committed in versions[:-1]:
            if committed < (time.time() - self.keep_s) * 1000:
                _delete(spark, f"{self.path}/{name}")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest committed version of a snapshot table (None before the first batch)."""
    versions = committed_versions(spark, path)
    return spark.read.parquet(f"{path}/{versions[-1][1]}") if versions else None


def _union(prev: DataFrame | None, batch: DataFrame, cols: list[str]) -> DataFrame:
    b = batch.select(*cols)
    return b if prev is None else prev.select(*cols).unionByName(b)


def latest_fold(cols: list[str]) -> Fold:
    """K2: last-arrived tick per symbol over stored ∪ batch."""
    return lambda prev, batch: latest_tick(_union(prev, batch, cols))


def history_fold(cols: list[str], n: int = 100) -> Fold:
    """K3: newest ``n`` ticks per symbol over stored ∪ batch (with ``rank``)."""
    return lambda prev, batch: last_n_ticks(_union(prev, batch, cols), n)


def replace_fold(key: str = "symbol") -> Fold:
    """Rows of the batch take the place of stored rows of the same key (an update-mode result)."""
    return lambda prev, batch: batch if prev is None else prev.join(batch, key, "left_anti").unionByName(batch)


def stats_fold() -> Fold:
    """A2 in streaming: merge running stats with the batch's partial stats.

    Input batches are rolling-alert rows (symbol, price, alert_type, ...).
    """
    def fold(prev, batch):
        part = (batch.groupBy("symbol")
                .agg(F.count(F.lit(1)).alias("ticks"), F.min("price").alias("min_price"),
                     F.max("price").alias("max_price"), F.count("alert_type").alias("alerts")))
        both = part if prev is None else prev.select(*part.columns).unionByName(part)
        return (both.groupBy("symbol")
                .agg(F.sum("ticks").alias("ticks"), F.min("min_price").alias("min_price"),
                     F.max("max_price").alias("max_price"), F.sum("alerts").alias("alerts")))
    return fold


# ---------------------------------------------------------------------------
# Fan-out: one scan and parse feeding several sinks
# ---------------------------------------------------------------------------

def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` function calling several sinks on a persisted batch."""
    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for sink in sinks:
                sink(batch_df, batch_id)
        finally:
            batch_df.unpersist()
    return run


# ---------------------------------------------------------------------------
# Native sinks: archive (K8), Kafka publish (K1, K4), JDBC (K5/K6 on a database)
# ---------------------------------------------------------------------------

def start_archive(ticks: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  name: str = "tick_archive"):
    """K8: append raw ticks to parquet partitioned by event date (exactly-once file sink).

    Prices are stored as decimal(12,4) (null where one does not fit), with the time the batch
    was written.
    """
    out = ticks.select("symbol", F.col("price").try_cast(PRICE_DECIMAL).alias("price"), "volume", "source",
                       F.col("timestamp").alias("event_time"), F.current_timestamp().alias("created_at"),
                       "partition", "offset", F.to_date("timestamp").alias("event_date"))
    w = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("event_date")
         .outputMode("append").queryName(name))
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


CHANNEL_BUCKETS = 16


def channel_bucket(symbol: Column, buckets: int = CHANNEL_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def start_channel_publish(ticks: DataFrame, path: str, checkpoint: str,
                          trigger: dict | None = None, name: str = "tick_channel",
                          buckets: int = CHANNEL_BUCKETS):
    """K4: every tick as a JSON message on its symbol's channel.

    The channels are an append table partitioned by (received date, bucket of the
    symbol) with the symbol as a column (exactly-once file sink): a task of a batch
    writes at most ``buckets`` files a date, however many symbols there are, and a
    reader of one channel opens one bucket (``read_channel``). Rows: type='message',
    data (tick JSON), received_at, partition, offset, channel — the shape
    ``latest.channel_latest`` reads. With a broker, ``start_kafka_publish`` over
    ``ingest.to_kafka_records`` is the same fan-out keyed by symbol.
    """
    from ..functions.parse import tick_json, timestamp_text
    out = ticks.select(
        F.lit("message").alias("type"),
        tick_json(F.col("symbol"), F.col("price"), F.col("volume"),
                  timestamp_text(F.col("timestamp")), F.col("source")).alias("data"),
        F.col("kafka_timestamp").alias("received_at"), "partition", "offset",
        F.col("symbol").alias("channel"), F.to_date("kafka_timestamp").alias("received_date"),
        channel_bucket(F.col("symbol"), buckets).alias("bucket"))
    w = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("received_date", "bucket")
         .outputMode("append").queryName(name))
    return w.trigger(**(trigger or {"processingTime": "3 seconds"})).start()


def read_channel(spark: SparkSession, path: str, symbol: str | None = None, since=None,
                 buckets: int = CHANNEL_BUCKETS) -> DataFrame:
    """Messages of all channels, or of one symbol's and from a time on (one bucket, those dates)."""
    out = _since(read_table(spark, path, CHANNEL_SCHEMA), since, "received_at", "received_date")
    if symbol is None:
        return out
    return out.where((F.col("bucket") == channel_bucket(F.lit(symbol), buckets)) & (F.col("channel") == F.lit(symbol)))


def kafka_sink_options(bootstrap: str, topic: str, acks: str = "1", retries: int = 3,
                       linger_ms: int = 50) -> dict[str, str]:
    """Producer settings of the keyed tick topic (acks=1, 3 retries, 50 ms linger)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks,
            "kafka.retries": str(retries), "kafka.linger.ms": str(linger_ms)}


def start_kafka_publish(records: DataFrame, options: dict[str, str], checkpoint: str,
                        name: str = "tick_publish"):
    """K1/K4: write (key, value) records to Kafka; the key routes a symbol to one partition."""
    w = records.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    return w.queryName(name).start()


def jdbc_append(batch_df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Executor-side append into a database table (driver jar must be on the classpath)."""
    if _skip(batch_df):
        return
    batch_df.write.jdbc(url=url, table=table, mode="append", properties=properties)
