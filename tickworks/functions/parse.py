"""Column expressions for decoding and encoding ticks (all JVM-side).

Every cast that may meet bad input is a ``try_`` form: under ANSI mode a plain
cast of a garbage timestamp raises and would stop a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ENVELOPE_SCHEMA, TICK_WIRE_SCHEMA, TICK_WIRE_SCHEMA_LENIENT

# ISO-8601 text with a +HH:MM offset; six fraction digits unless
# the microseconds are zero (then none), as Python's isoformat() writes it.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_FORMAT_WHOLE = "yyyy-MM-dd'T'HH:mm:ssxxx"


def decode_text(c: Column | str) -> Column:
    """bytes → UTF-8 string."""
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def parse_tick_json(text: Column, lenient_volume: bool = False) -> Column:
    """Wire JSON → struct(symbol, timestamp, price, volume, source).

    Malformed input gives a struct of nulls; a single mistyped field nulls
    only that field. With ``lenient_volume`` a fractional volume is read as
    double and cast to bigint instead of becoming null.
    """
    if not lenient_volume:
        return F.from_json(text, TICK_WIRE_SCHEMA)
    s = F.from_json(text, TICK_WIRE_SCHEMA_LENIENT)
    return s.withField("volume", s["volume"].try_cast("bigint"))


def parse_envelope(text: Column) -> Column:
    return F.from_json(text, ENVELOPE_SCHEMA)


def iso_to_timestamp(c: Column) -> Column:
    """ISO-8601 text (any offset) → timestamp; unparsable → null."""
    return c.try_cast("timestamp")


def epoch_ms_to_timestamp(c: Column) -> Column:
    """epoch milliseconds → timestamp (F1)."""
    return F.timestamp_millis(c)


def timestamp_to_iso(c: Column) -> Column:
    """timestamp → ISO-8601 text in UTC (F2), e.g. 2024-01-01T00:00:07.179575+00:00,
    or 2024-01-01T00:00:07+00:00 when the microseconds are zero."""
    whole = F.unix_micros(c) % 1000000 == 0
    return F.when(whole, F.date_format(c, ISO_FORMAT_WHOLE)).otherwise(
        F.date_format(c, ISO_FORMAT))


def timestamp_text(c: Column) -> Column:
    """timestamp → plain text as Python's ``str(datetime)`` writes it (F4):
    'yyyy-MM-dd HH:mm:ss', plus '.ffffff' only when the microseconds are not zero."""
    whole = F.unix_micros(c) % 1000000 == 0
    return F.when(whole, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def tick_json(symbol: Column, price: Column, volume: Column, timestamp: Column,
              source: Column) -> Column:
    """One tick as JSON text; null fields are written as ``null``."""
    return F.to_json(
        F.struct(symbol.alias("symbol"), price.alias("price"), volume.alias("volume"),
                 timestamp.alias("timestamp"), source.alias("source")),
        {"ignoreNullFields": "false"},
    )


def text_to_double(c: Column) -> Column:
    """text → double; bad text → null."""
    return c.try_cast("double")
