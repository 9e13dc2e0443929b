"""Ingest: Kafka-shaped records and vendor envelopes → canonical ticks.

S3   unpack_envelopes   trade envelopes → one wire tick per element
K1   to_kafka_records   ticks → (key = symbol, value = wire JSON) records
P1-P6 parse_ticks       records → canonical ticks; unparsable rows dropped
      parse_rejects     the dropped records (for a reject table)
P11  live_ticks         skip null *or empty* symbols (channel reader)
P13  key_audit          records whose key differs from the payload symbol

All of it is row-local (no shuffle) and stays inside whole-stage codegen.
``parse_ticks`` parses each payload once: the parsed struct is wrapped in a
one-element array, filtered and inlined, so the optimizer neither pushes the
``symbol is not null`` test below the projection (a second parse) nor splits
the parse into one pruned parse per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import (decode_text, epoch_ms_to_timestamp, iso_to_timestamp,
                               parse_envelope, parse_tick_json, timestamp_to_iso)
from ..schema import (DEFAULT_LIVE_SOURCE, TICK_WIRE_SCHEMA, TICK_WIRE_SCHEMA_LENIENT,
                      TRADE_TYPE)


def _parsed(records: DataFrame, lenient_volume: bool) -> Column:
    return parse_tick_json(decode_text(F.col("value")), lenient_volume)


def parse_ticks(records: DataFrame, symbol_from: str = "value",
                lenient_volume: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka records (key, value, partition, offset, timestamp) → canonical ticks.

    symbol_from="value": symbol from the JSON payload (streaming job);
    symbol_from="key":   symbol from the record key (stand-alone consumer).
    Rows whose symbol is null (malformed, truncated, empty or null payload,
    missing symbol) are dropped; a bad timestamp becomes null, not an error.
    By key, a payload must hold at least one wire field (it may lack the symbol)
    and the key must not be null.
    ``keep`` names record columns to carry along (e.g. "key", "topic").
    The whole parsed struct goes through the generator and its fields are read
    only after it: a field read directly on ``from_json`` is rewritten by the
    optimizer into one single-field parse per field (five parses per record).
    """
    schema = TICK_WIRE_SCHEMA_LENIENT if lenient_volume else TICK_WIRE_SCHEMA
    p = F.from_json(decode_text(F.col("value")), schema)
    by_key = _by_key(symbol_from)
    kept = F.filter(F.array(p), _any_field if by_key else lambda x: x["symbol"].isNotNull())
    if by_key:
        records = records.where(decode_text(F.col("key")).isNotNull())
    exploded = records.select(F.col("timestamp").alias("kafka_timestamp"),
                              F.col("partition").cast("int").alias("partition"),
                              F.col("offset").cast("bigint").alias("offset"),
                              *[F.col(c).alias(f"_keep_{c}") for c in keep],
                              *([decode_text(F.col("key")).alias("_key")] if by_key else []),
                              F.inline(kept))
    volume = F.col("volume").try_cast("bigint") if lenient_volume else F.col("volume")
    return exploded.select(
        F.col("_key" if by_key else "symbol").alias("symbol"),
        iso_to_timestamp(F.col("timestamp")).alias("timestamp"), "price",
        volume.alias("volume"), "source", "kafka_timestamp", "partition", "offset",
        *[F.col(f"_keep_{c}").alias(c) for c in keep])


def _by_key(symbol_from: str) -> bool:
    if symbol_from not in ("value", "key"):
        raise ValueError(f"symbol_from must be 'value' or 'key', not {symbol_from!r}")
    return symbol_from == "key"


def _any_field(tick: Column) -> Column:
    return F.coalesce(*[tick[f.name].cast("string") for f in TICK_WIRE_SCHEMA.fields]).isNotNull()


def parse_rejects(records: DataFrame, symbol_from: str = "value") -> DataFrame:
    """Records that ``parse_ticks`` drops, with their raw text (for a reject table)."""
    p = _parsed(records, False)
    kept = (_any_field(p) & decode_text(F.col("key")).isNotNull() if _by_key(symbol_from)
            else p["symbol"].isNotNull())
    return (records
            .where(~kept)
            .select("topic", "partition", "offset",
                    F.col("timestamp").alias("kafka_timestamp"),
                    decode_text(F.col("value")).alias("raw")))


def live_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks a channel reader accepts: symbol neither null nor empty."""
    return ticks.where(F.col("symbol").isNotNull() & (F.col("symbol") != F.lit("")))


def key_audit(records: DataFrame) -> DataFrame:
    """Per topic-partition: records, parsed records, and key ≠ payload symbol counts."""
    p = _parsed(records, False)
    key = decode_text(F.col("key"))
    parsed = p["symbol"].isNotNull()
    mismatch = parsed & ~key.eqNullSafe(p["symbol"])
    return (records.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count(F.when(parsed, 1)).alias("n_parsed"),
                 F.count(F.when(mismatch, 1)).alias("n_key_mismatch")))


def unpack_envelopes(envelopes: DataFrame, raw_col: str = "raw",
                     source: str = DEFAULT_LIVE_SOURCE) -> DataFrame:
    """Vendor envelopes (JSON text) → wire ticks, one per element of ``data``.

    Only ``type == "trade"`` is kept; a trade without ``data`` gives no rows.
    Output: symbol, timestamp (ISO-8601 text, UTC), price, volume, source.
    """
    env = parse_envelope(F.col(raw_col))
    trades = F.filter(F.array(env), lambda m: m["type"] == F.lit(TRADE_TYPE))
    elems = (envelopes.select(F.inline(trades))          # one parse per message
             .select(F.inline(F.col("data"))))
    return elems.select(
        F.col("s").alias("symbol"),
        timestamp_to_iso(epoch_ms_to_timestamp(F.col("t"))).alias("timestamp"),
        F.col("p").alias("price"),
        F.col("v").alias("volume"),
        F.lit(source).alias("source"),
    )


def to_kafka_records(wire: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wire ticks → producer records: key = symbol bytes, value = JSON bytes.

    The result is what ``write.format("kafka")`` expects (key, value columns),
    plus the columns named by ``keep``. Null fields are written as ``null``.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in
                                 ("symbol", "timestamp", "price", "volume", "source")]),
                      {"ignoreNullFields": "false"})
    return wire.select(F.col("symbol").cast("binary").alias("key"),
                       value.cast("binary").alias("value"), *keep)
