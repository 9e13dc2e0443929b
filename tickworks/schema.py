"""Schemas and fixed values of the tick data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference behaviour for equal results.
#   symbol dimension, in display order: AAPL, GOOGL, MSFT, TSLA, AMZN, NVDA
#   rolling mean length: 10 ticks; a mean needs at least 2 ticks
#   price alert: deviation from the mean strictly greater than 0.005
#   volume alert: volume strictly greater than 1,000,000
#   retained history: 100 ticks per symbol
#   tumbling window: 5 minutes; watermark delay: 1 minute
#   alert type names: VOLUME_SPIKE, PRICE_SURGE, PRICE_DROP
#   envelope message type kept: trade
# ---------------------------------------------------------------------------
SYMBOLS = ["AAPL", "GOOGL", "MSFT", "TSLA", "AMZN", "NVDA"]
SMA_WINDOW = 10
SMA_MIN_TICKS = 2
ALERT_THRESHOLD = 0.005
VOLUME_SPIKE_THRESHOLD = 1_000_000
HISTORY_LEN = 100
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "1 minute"
VOLUME_SPIKE = "VOLUME_SPIKE"
PRICE_SURGE = "PRICE_SURGE"
PRICE_DROP = "PRICE_DROP"
TRADE_TYPE = "trade"

# Source label written on ticks unpacked from vendor envelopes (a parameter).
DEFAULT_LIVE_SOURCE = "live_feed"

# Vendor envelope: {type, data: [{s, p, v, t}]}; t is epoch milliseconds.
ENVELOPE_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("data", ArrayType(StructType([
        StructField("s", StringType()),
        StructField("p", DoubleType()),
        StructField("v", LongType()),
        StructField("t", LongType()),
    ]))),
])

# Tick message on the wire (JSON text); every field nullable.
TICK_WIRE_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("timestamp", StringType()),
    StructField("price", DoubleType()),
    StructField("volume", LongType()),
    StructField("source", StringType()),
])

# Same, volume read as double so fractional vendor volumes survive (lenient mode).
TICK_WIRE_SCHEMA_LENIENT = StructType([
    f if f.name != "volume" else StructField("volume", DoubleType())
    for f in TICK_WIRE_SCHEMA.fields
])

# Rows as a Kafka source delivers them.
KAFKA_RECORD_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

# Canonical parsed tick. (partition, offset) is the arrival order ("seq"):
# ticks are keyed by symbol, so one symbol lives in one partition.
TICK_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("price", DoubleType()),
    StructField("volume", LongType()),
    StructField("source", StringType()),
    StructField("kafka_timestamp", TimestampType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
])
TICK_COLUMNS = [f.name for f in TICK_SCHEMA.fields]
SEQ = ["partition", "offset"]

PRICE_DECIMAL = DecimalType(12, 4)

# Stored tables: prices are decimal(12,4), rows carry the time they were first written.
STORED_WINDOW_SCHEMA = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("symbol", StringType()),
    StructField("avg_price", PRICE_DECIMAL),
    StructField("min_price", PRICE_DECIMAL),
    StructField("max_price", PRICE_DECIMAL),
    StructField("tick_count", LongType()),
    StructField("created_at", TimestampType()),
    StructField("changed_at", TimestampType()),
    StructField("seq", LongType()),
    StructField("window_date", DateType()),
    StructField("change", StringType()),
])
ARCHIVE_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("price", PRICE_DECIMAL),
    StructField("volume", LongType()),
    StructField("source", StringType()),
    StructField("event_time", TimestampType()),
    StructField("created_at", TimestampType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("event_date", DateType()),
])
CHANNEL_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("data", StringType()),
    StructField("received_at", TimestampType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("channel", StringType()),
    StructField("received_date", DateType()),
    StructField("bucket", IntegerType()),
])

WINDOW_AGG_SCHEMA = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("symbol", StringType()),
    StructField("avg_price", DoubleType()),
    StructField("min_price", DoubleType()),
    StructField("max_price", DoubleType()),
    StructField("tick_count", LongType()),
])

ALERT_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("volume", LongType()),
    StructField("alert_type", StringType()),
    StructField("timestamp", TimestampType()),
])
