"""Latest values per symbol and freshness.

A3  latest_price   last price per symbol in arrival order (last write wins)
    latest_tick    the whole last tick per symbol
A5  freshness      newest broker timestamp and its age at ``as_of``
P5  ingest_lag     broker time minus event time, per tick
S8  channel_latest latest tick per symbol from channel messages (bad ones skipped), batch or stream

``max_by`` is an ordinary aggregate: each map task reduces its rows to one
per symbol before the shuffle, so a hot symbol costs nothing extra.
``latest_tick`` finds the last (partition, offset) per symbol with hash
aggregates over those three columns, then takes the matching rows by a semi
join with that one row per symbol; no task sorts its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def latest_price(ticks: DataFrame) -> DataFrame:
    """symbol, price of the last-arrived tick (its price may be null).

    Two hash aggregates instead of one ``max_by(price, struct(partition, offset))``:
    a struct ordering key is not a fixed-width aggregation buffer, which forces
    a sort-based aggregate (every map task sorting its whole input). Per
    (symbol, partition) the ordering key is the plain offset; the second step
    picks the highest partition per symbol over at most one row per partition.
    """
    per_part = (ticks.groupBy("symbol", "partition")
                .agg(F.max_by("price", "offset").alias("price")))
    return per_part.groupBy("symbol").agg(F.max_by("price", "partition").alias("price"))


def latest_tick(ticks: DataFrame) -> DataFrame:
    """The last-arrived tick per symbol, all columns."""
    per_part = ticks.groupBy("symbol", "partition").agg(F.max("offset").alias("offset"))
    best = (per_part.groupBy("symbol").agg(F.max_by("offset", F.coalesce("partition", F.lit(-1))).alias("_offset"),
                                           F.max("partition").alias("_partition"))
            .withColumnRenamed("symbol", "_symbol"))
    rows = ticks.join(best, F.col("symbol").eqNullSafe(F.col("_symbol"))
                      & F.col("partition").eqNullSafe(F.col("_partition"))
                      & F.col("offset").eqNullSafe(F.col("_offset")), "left_semi")
    # a record delivered twice has two such rows
    nth = F.row_number().over(Window.partitionBy("symbol").orderBy("partition"))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def freshness(ticks: DataFrame, as_of: Column | str, by_symbol: bool = False) -> DataFrame:
    """Newest ``kafka_timestamp`` and its age in seconds at ``as_of``.

    ``as_of`` is passed in (a timestamp literal or column) so results are
    reproducible; use ``F.current_timestamp()`` for a live reading.
    """
    as_of_c = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    keys = ["symbol"] if by_symbol else []
    agg = ticks.groupBy(*keys).agg(F.max("kafka_timestamp").alias("last_update"))
    age = (F.unix_micros(as_of_c) - F.unix_micros(F.col("last_update"))) / F.lit(1e6)
    return agg.withColumn("age_seconds", age)


def ingest_lag(ticks: DataFrame) -> DataFrame:
    """Add ``lag_seconds`` = kafka_timestamp - timestamp (null when either is null)."""
    lag = (F.unix_micros("kafka_timestamp") - F.unix_micros("timestamp")) / F.lit(1e6)
    return ticks.withColumn("lag_seconds", lag)


_CHANNEL_SCHEMA = "symbol string, price double, volume bigint, timestamp string, source string"


def channel_ticks(messages: DataFrame) -> DataFrame:
    """Messages (type, data JSON text, received_at, partition, offset) → ticks, each parsed once.

    Frames whose type is not ``message`` are ignored; a message that does not
    parse or has a null or empty symbol is skipped.
    """
    m = F.from_json(F.col("data"), _CHANNEL_SCHEMA)
    ok = F.filter(F.array(m), lambda x: x["symbol"].isNotNull() & (x["symbol"] != F.lit("")))
    return (messages.where(F.col("type") == F.lit("message"))
            .select("received_at", "partition", "offset", F.inline(ok)))


def channel_latest(messages: DataFrame) -> DataFrame:
    """The last message per symbol (by arrival) and when the reader last got any message of it.

    One aggregate over one scan, so it is also the streaming reader in update mode
    (``jobs.start_channel_reader``). Arrival order is (partition, offset), as one number:
    topics have fewer than 2^15 partitions and 2^48 records in one.
    """
    order = F.call_function("shiftleft", F.coalesce("partition", F.lit(0)).cast("bigint"), F.lit(48)) + F.col("offset")
    cols = ["price", "volume", "timestamp", "source", "partition", "offset"]
    return (channel_ticks(messages).groupBy("symbol")
            .agg(F.max_by(F.struct(*cols), order).alias("_last"), F.max("received_at").alias("last_update"))
            .select("symbol", "_last.*", "last_update"))
