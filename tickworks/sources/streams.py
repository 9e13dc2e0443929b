"""Streaming and batch tick sources.

S1  kafka_stream        subscribe a topic (default: start at latest, tolerate lost data)
S2  kafka_batch         bounded read earliest → latest (replay)
    replay_stream       the same record shape from parquet files, one part per trigger
    write_replay_files  split a record table into ordered parts for ``replay_stream``
S9  archive_stream/read the raw-tick archive as a source

The Kafka connector jar is not bundled; the Kafka readers are plain
``format("kafka")`` configuration. File replay gives the identical record
shape (key, value, topic, partition, offset, timestamp, timestampType), so
everything downstream (parsing, windows, sinks) is the code a Kafka job runs.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ARCHIVE_SCHEMA, KAFKA_RECORD_SCHEMA


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def kafka_batch(spark: SparkSession, bootstrap: str, topic: str,
                starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load())


def write_replay_files(records: DataFrame, out_dir: str, n_parts: int,
                       order_col: str = "offset", min_gap_s: float = 1.05,
                       first_index: int = 0, files_per_part: int = 1) -> tuple[str, int]:
    """Write ``records`` as up to ``n_parts`` parts of several files, split by ranges of ``order_col``.

    A file stream takes files oldest first, so the parts are written by
    separate jobs at least ``min_gap_s`` apart: part i holds the i-th range and
    is older than part i+1. Ranges without a record give no part. Within a part
    records are dealt over the files by a hash of their offset, and each file is
    written by a task of its own. All parts have the same number of files:
    ``files_per_part``, or the largest halving of it that leaves no file empty
    (small or gappy inputs). Returns (glob to stream from, files per part), so that
    ``replay_stream(max_files_per_trigger=files)`` takes one part per batch. An
    empty table writes nothing; its glob is an empty stream.
    """
    glob = f"{out_dir}/part*.parquet"
    lo, hi = records.select(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return glob, files_per_part
    step = (hi - lo) // n_parts + 1
    dealt = (records.withColumn("_part", F.expr(f"(`{order_col}` - {lo}) div {step}"))
             .withColumn("_hash", F.xxhash64(order_col, "offset")))
    files = files_per_part
    while True:
        slices = dealt.withColumn("_slice", F.pmod("_hash", F.lit(files)).cast("int"))
        met = {r["_part"]: r["n"] for r in slices.groupBy("_part").agg(F.count_distinct("_slice").alias("n")).collect()}
        if files == 1 or all(n == files for n in met.values()):
            break
        files //= 2
    parts = sorted(p for p in met if p is not None)     # at most n_parts numbers
    for i, p in enumerate(parts):
        start = time.time()
        (slices.where(F.col("_part") == p).repartitionById(files, "_slice").select(*records.columns)
         .write.mode("overwrite").parquet(f"{out_dir}/part{first_index + i:04d}.parquet"))
        wait = min_gap_s - (time.time() - start)
        if i + 1 < len(parts) and wait > 0:
            time.sleep(wait)
    return glob, files


def replay_stream(spark: SparkSession, path_glob: str, schema=KAFKA_RECORD_SCHEMA,
                  max_files_per_trigger: int = 1) -> DataFrame:
    """A streaming DataFrame over replay files, ``max_files_per_trigger`` per batch."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .option("recursiveFileLookup", "true")
            .parquet(path_glob))


def _archived_ticks(rows: DataFrame) -> DataFrame:
    """Stored rows as ticks: the stored decimal prices become doubles again."""
    return rows.withColumnRenamed("event_time", "timestamp").withColumn("price", F.col("price").cast("double"))


def archive_read(spark: SparkSession, path: str) -> DataFrame:
    """The raw-tick archive (partitioned by event_date) as ticks, ready for every tick operator."""
    return _archived_ticks(spark.read.schema(ARCHIVE_SCHEMA).parquet(path))


def archive_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The archive as a stream of ticks.

    The archive's file sink keeps a commit log; the stream reads it, so files of a
    batch that did not commit are never seen, and a stream that runs on follows the
    archive as it grows.
    """
    reader = spark.readStream.schema(ARCHIVE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _archived_ticks(reader.parquet(path))
