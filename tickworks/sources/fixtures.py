"""Driver tables seen as tick streams.

The fixture tables carry no market data; these mappings give them the tick
shape so every operator runs over whole tables:

  events:  symbol = event_type (few hot symbols) or user_id (many sparse ones),
           timestamp = ts, price = value,
           volume = props.k * 20000 (k > 50 is a volume spike, k = 50 is exactly
           the threshold and is not), arrival order = (0, event_id).
  orders:  symbol = o_orderpriority, timestamp = o_orderdate,
           price = o_totalprice, arrival order = (0, o_orderkey).
  lineitem: symbol = l_returnflag || l_linestatus, timestamp = l_shipdate,
           price = l_extendedprice, volume = l_quantity. It has no arrival
           order (its line key is not unique), so it feeds window aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import timestamp_to_iso
from ..operators.ingest import to_kafka_records

VOLUME_SCALE = 20000


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tick(symbol: Column, ts: Column, price: Column, volume: Column,
          offset: Column, source: str = "synthetic") -> list[Column]:
    event_time = ts.cast("timestamp")
    return [
        symbol.alias("symbol"),
        event_time.alias("timestamp"),
        price.cast("double").alias("price"),
        volume.cast("bigint").alias("volume"),
        F.lit(source).alias("source"),
        event_time.alias("kafka_timestamp"),
        F.lit(0).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
    ]


def events_volume(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint") * F.lit(VOLUME_SCALE)


def ticks_from_events(events: DataFrame, symbol: str = "event_type") -> DataFrame:
    """Canonical ticks from ``events``; ``symbol`` is ``event_type`` or ``user_id``."""
    if symbol == "event_type":
        sym = F.col("event_type")
    elif symbol == "user_id":
        sym = F.col("user_id").cast("string")
    else:
        raise ValueError(f"unknown symbol mapping {symbol!r}")
    return events.select(*_tick(sym, F.col("ts"), F.col("value"),
                                events_volume(F.col("props")), F.col("event_id")))


def ticks_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*_tick(F.col("o_orderpriority"), F.col("o_orderdate"),
                                F.col("o_totalprice"), F.lit(None), F.col("o_orderkey")))


def ticks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Scale input for window aggregates only (no arrival order: offset is null)."""
    return lineitem.select(*_tick(F.concat("l_returnflag", "l_linestatus"),
                                  F.col("l_shipdate"), F.col("l_extendedprice"),
                                  F.col("l_quantity"), F.lit(None)))


def kafka_records_from_ticks(ticks: DataFrame, topic: str = "ticks") -> DataFrame:
    """The records a keyed producer would have written for these ticks.

    key = symbol, value = the wire JSON (ISO-8601 timestamp with offset).
    """
    wire = ticks.withColumn("timestamp", timestamp_to_iso(F.col("timestamp")))
    records = to_kafka_records(wire, keep=("partition", "offset", "kafka_timestamp"))
    return records.select(
        "key", "value", F.lit(topic).alias("topic"), "partition", "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def envelopes_from_events(events: DataFrame, per_envelope: int = 4) -> DataFrame:
    """Vendor trade envelopes (JSON text) built from ``events``.

    Consecutive event ids are packed ``per_envelope`` to a message; each
    element carries s, p, v and t (epoch milliseconds). The grouping key is
    ``event_id div per_envelope`` so a group never exceeds ``per_envelope`` rows.
    """
    elem = F.struct(
        F.col("event_id").alias("_id"),
        F.col("event_type").alias("s"),
        F.col("value").alias("p"),
        events_volume(F.col("props")).alias("v"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
    )
    grouped = (events
               .groupBy(F.floor(F.col("event_id") / per_envelope).alias("envelope_id"))
               .agg(F.array_sort(F.collect_list(elem)).alias("data")))
    data = F.transform("data", lambda x: x.dropFields("_id"))
    return grouped.select(
        "envelope_id",
        F.to_json(F.struct(F.lit("trade").alias("type"), data.alias("data"))).alias("raw"),
    )


__all__ = [
    "load_table", "ticks_from_events", "ticks_from_orders", "ticks_from_lineitem",
    "kafka_records_from_ticks", "envelopes_from_events", "events_volume",
]
