"""Registered queries: each runs a library operator over whole driver tables.

Every entry is ``fn(spark, sf_dir) -> DataFrame`` plus, where the result is
expressible in plain SQL, the equivalent DuckDB query over the same parquet
tables. Timestamp outputs are cast to ``timestamp_ntz`` so they compare with
DuckDB's zone-less ``TIMESTAMP``; computed columns carry the same alias on
both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..operators import windows as win
from ..session import ensure_utc
from ..sources.fixtures import load_table, ticks_from_events, ticks_from_lineitem

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return to_ntz(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql.strip()
        return run
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp`` column to ``timestamp_ntz`` (UTC wall clock)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def event_ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return ticks_from_events(load_table(spark, sf_dir, "events"), symbol)


# ---------------------------------------------------------------------------
# A1 tumbling windows
# ---------------------------------------------------------------------------

_WINDOW_SQL = """
SELECT time_bucket(INTERVAL '{d}', ts) AS window_start,
       time_bucket(INTERVAL '{d}', ts) + INTERVAL '{d}' AS window_end,
       {sym} AS symbol,
       {avg} AS avg_price,
       round(min(value), 4) AS min_price,
       round(max(value), 4) AS max_price,
       count(value) AS tick_count
FROM events
WHERE ts IS NOT NULL AND {sym} IS NOT NULL
GROUP BY 1, 2, 3
"""
_AVG_DOUBLE = "round(avg(value), 4)"
_AVG_EXACT = ("CASE WHEN count(value) > 0 THEN "
              "floor((2 * sum(CAST(round(value * 10000) AS BIGINT)) + count(value)) "
              "/ (2 * count(value))) / 10000.0 END")


@register("window_agg_5m", _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT))
def window_agg_5m(spark, sf_dir):
    """A1: 5-minute tumbling aggregates per (window, event type)."""
    return win.window_aggregates(event_ticks(spark, sf_dir), "5 minutes", mode="exact")


@register("window_agg_5m_double",
          _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_DOUBLE))
def window_agg_5m_double(spark, sf_dir):
    """A1 with the original double expression round(avg(price), 4).

    Equal to the exact form except where the exact mean sits on a rounding tie
    (none at sf0.01; 1 of 38,913 rows at sf0.1, where engines round differently).
    """
    return win.window_aggregates(event_ticks(spark, sf_dir), "5 minutes", mode="double")


@register("window_agg_fraction", _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_DOUBLE)
          .replace("value", "(value / 7.0::DOUBLE)"))
def window_agg_fraction(spark, sf_dir):
    """A1 in its default form on prices with many decimals (value / 7)."""
    ticks = event_ticks(spark, sf_dir)
    return win.window_aggregates(ticks.withColumn("price", F.col("price") / F.lit(7.0)), "5 minutes")


@register("window_agg_1h", _WINDOW_SQL.format(d="1 hour", sym="event_type", avg=_AVG_EXACT))
def window_agg_1h(spark, sf_dir):
    """A1 with a one-hour window."""
    return win.window_aggregates(event_ticks(spark, sf_dir), "1 hour", mode="exact")


@register("window_agg_users_5m",
          _WINDOW_SQL.format(d="5 minutes", sym="CAST(user_id AS VARCHAR)", avg=_AVG_EXACT))
def window_agg_users_5m(spark, sf_dir):
    """A1 over many sparse symbols (user ids)."""
    return win.window_aggregates(event_ticks(spark, sf_dir, "user_id"), "5 minutes", mode="exact")


@register("window_agg_lineitem_1d", """
SELECT time_bucket(INTERVAL '1 day', l_shipdate) AS window_start,
       time_bucket(INTERVAL '1 day', l_shipdate) + INTERVAL '1 day' AS window_end,
       l_returnflag || l_linestatus AS symbol,
       CASE WHEN count(l_extendedprice) > 0 THEN
            floor((2 * sum(CAST(round(l_extendedprice * 10000) AS BIGINT)) + count(l_extendedprice))
                  / (2 * count(l_extendedprice))) / 10000.0 END AS avg_price,
       round(min(l_extendedprice), 4) AS min_price,
       round(max(l_extendedprice), 4) AS max_price,
       count(l_extendedprice) AS tick_count
FROM lineitem
WHERE l_shipdate IS NOT NULL AND (l_returnflag || l_linestatus) IS NOT NULL
GROUP BY 1, 2, 3
""")
def window_agg_lineitem_1d(spark, sf_dir):
    """A1 on the largest table (lineitem as ticks), one-day windows."""
    ticks = ticks_from_lineitem(load_table(spark, sf_dir, "lineitem"))
    return win.window_aggregates(ticks, "1 day", mode="exact")


# ---------------------------------------------------------------------------
# Shared SQL pieces: the events table as ticks (FIXTURES mapping)
# ---------------------------------------------------------------------------

def _ticks_sql(symbol: str = "event_type") -> str:
    return f"""ticks AS (
  SELECT {symbol} AS symbol, ts AS timestamp, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 20000 AS volume,
         'synthetic' AS source, ts AS kafka_timestamp, 0 AS partition, event_id AS "offset"
  FROM events)"""


_USER = "CAST(user_id AS VARCHAR)"

# Small chunks make the chunked operators (halo, two-level top-N) do real work
# on the test scales; results must not depend on the chunk size.
SMALL_CHUNK = 64
USER_CHUNK = 256            # ticks: only users with more are cut into pieces


# ---------------------------------------------------------------------------
# Ingest: parse, rejects, key audit, envelopes
# ---------------------------------------------------------------------------

def mixed_topic(spark, sf_dir):
    """Producer records for every event, plus every raw web page as junk on partition 1."""
    from ..sources.fixtures import kafka_records_from_ticks
    good = kafka_records_from_ticks(event_ticks(spark, sf_dir))
    pages = load_table(spark, sf_dir, "pages")
    junk = pages.select(F.lit(None).cast("binary").alias("key"),
                        F.col("html").cast("binary").alias("value"),
                        F.lit("ticks").alias("topic"), F.lit(1).alias("partition"),
                        F.col("page_id").cast("bigint").alias("offset"),
                        F.lit(None).cast("timestamp").alias("timestamp"),
                        F.lit(0).alias("timestampType"))
    return good.unionByName(junk)


_TICK_OUT = "symbol, timestamp, price, volume, source, kafka_timestamp, partition, \"offset\""


@register("parse_roundtrip", f"WITH {_ticks_sql()} SELECT {_TICK_OUT} FROM ticks")
def parse_roundtrip(spark, sf_dir):
    """Ticks → keyed JSON records → parsed ticks, all columns equal."""
    from ..operators.ingest import parse_ticks
    from ..sources.fixtures import kafka_records_from_ticks
    return parse_ticks(kafka_records_from_ticks(event_ticks(spark, sf_dir)))


@register("parse_mixed_topic", f"WITH {_ticks_sql()} SELECT {_TICK_OUT} FROM ticks")
def parse_mixed_topic(spark, sf_dir):
    """A topic with junk records (raw HTML pages); only the valid ticks survive."""
    from ..operators.ingest import parse_ticks
    return parse_ticks(mixed_topic(spark, sf_dir))


@register("parse_key_symbol", f"WITH {_ticks_sql()} SELECT {_TICK_OUT} FROM ticks")
def parse_key_symbol(spark, sf_dir):
    """Symbol taken from the record key (stand-alone consumer form)."""
    from ..operators.ingest import parse_ticks
    from ..sources.fixtures import kafka_records_from_ticks
    return parse_ticks(kafka_records_from_ticks(event_ticks(spark, sf_dir)), symbol_from="key")


@register("parse_key_mixed", f"WITH {_ticks_sql()} SELECT {_TICK_OUT} FROM ticks")
def parse_key_mixed(spark, sf_dir):
    """P13 on the mixed topic, every record keyed: junk payloads are dropped whatever their key."""
    from ..operators.ingest import parse_ticks
    keyed = mixed_topic(spark, sf_dir).withColumn(
        "key", F.coalesce("key", F.lit("junk").cast("binary")))
    return parse_ticks(keyed, symbol_from="key")


@register("kafka_key_value", f"""WITH {_ticks_sql()}
SELECT symbol AS key, symbol, timestamp, price, volume, source, partition, "offset" FROM ticks""")
def kafka_key_value(spark, sf_dir):
    """K1: producer records (key = symbol bytes, value = JSON); key and parsed value compared."""
    from ..operators.ingest import parse_ticks
    from ..sources.fixtures import kafka_records_from_ticks
    recs = kafka_records_from_ticks(event_ticks(spark, sf_dir))
    parsed = parse_ticks(recs, keep=("key",))
    return parsed.select(F.col("key").cast("string").alias("key"), "symbol", "timestamp",
                         "price", "volume", "source", "partition", "offset")


@register("parse_rejects", """
SELECT 'ticks' AS topic, 1 AS partition, CAST(page_id AS BIGINT) AS "offset"
FROM pages
WHERE NOT coalesce(json_valid(html), false) OR json_extract_string(html, '$.symbol') IS NULL
""")
def parse_rejects(spark, sf_dir):
    """Reject table of the mixed topic: every record whose payload has no symbol."""
    from ..operators.ingest import parse_rejects as rejects
    return rejects(mixed_topic(spark, sf_dir)).select("topic", "partition", "offset")


@register("key_audit", """
SELECT 'ticks' AS topic, 0 AS partition, count(*) AS n_records, count(*) AS n_parsed,
       CAST(0 AS BIGINT) AS n_key_mismatch FROM events
UNION ALL
SELECT 'ticks', 1, count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM pages
""")
def key_audit(spark, sf_dir):
    """P13 audit per topic-partition: records, parsed, key ≠ payload symbol."""
    from ..operators.ingest import key_audit as audit
    return audit(mixed_topic(spark, sf_dir))


@register("envelope_unpack", """
SELECT event_type AS symbol,
       CASE WHEN (epoch_us(ts) // 1000) % 1000 = 0
            THEN strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%f')
       END || '+00:00' AS timestamp,
       value AS price,
       CAST(json_extract_string(props, '$.k') AS BIGINT) * 20000 AS volume,
       'live_feed' AS source
FROM events
""")
def envelope_unpack(spark, sf_dir):
    """Trade envelopes (4 ticks each) → one wire tick per element."""
    from ..operators.ingest import unpack_envelopes
    from ..sources.fixtures import envelopes_from_events
    return unpack_envelopes(envelopes_from_events(load_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------------------
# Alerts
# ---------------------------------------------------------------------------

_VOLUME_ALERTS_SQL = f"""WITH {_ticks_sql()}
SELECT symbol, price, volume, 'VOLUME_SPIKE' AS alert_type, timestamp, partition, "offset"
FROM ticks WHERE volume > 1000000"""


@register("volume_alerts", _VOLUME_ALERTS_SQL)
def volume_alerts(spark, sf_dir):
    """Volume strictly above 1,000,000 (exactly 1,000,000 does not alert)."""
    from ..operators.alerts import volume_alerts as va
    return va(event_ticks(spark, sf_dir))


@register("alerts_top10", f"""
SELECT * FROM ({_VOLUME_ALERTS_SQL}) a
ORDER BY timestamp DESC NULLS LAST, partition DESC, "offset" DESC LIMIT 10""")
def alerts_top10(spark, sf_dir):
    """O1: the 10 newest alerts."""
    from ..operators.alerts import latest_alerts, volume_alerts as va
    return latest_alerts(va(event_ticks(spark, sf_dir)), 10)


@register("alert_lines", f"""
SELECT symbol, price, volume, alert_type, timestamp, partition, "offset",
       printf('**%s** | %s | Price: %s | Volume: %s | Time: %s', symbol, alert_type,
              printf('$%.4f', price), format('{{:,}}', volume),
              strftime(timestamp, '%Y-%m-%d %H:%M:%S')) AS line
FROM ({_VOLUME_ALERTS_SQL}) a
ORDER BY timestamp DESC NULLS LAST, partition DESC, "offset" DESC LIMIT 10""")
def alert_lines(spark, sf_dir):
    """Recent-alert display lines (F10-F12 on O1)."""
    from ..operators.alerts import latest_alerts, volume_alerts as va
    from ..operators.serving import alert_rows
    return alert_rows(latest_alerts(va(event_ticks(spark, sf_dir)), 10))


# ---------------------------------------------------------------------------
# Rolling mean, deviation alerts, session stats
# ---------------------------------------------------------------------------

def _rolling_sql(symbol: str) -> str:
    return f"""WITH {_ticks_sql(symbol)},
w AS (
  SELECT symbol, "offset", price,
         row_number() OVER (PARTITION BY symbol ORDER BY partition, "offset") >= 2 AS ok,
         avg(price) OVER f AS mean,
         sum(CAST(round(price * 10000) AS BIGINT)) OVER f AS su,
         count(price) OVER f AS sc
  FROM ticks WHERE price IS NOT NULL
  WINDOW f AS (PARTITION BY symbol ORDER BY partition, "offset"
               ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
a AS (
  SELECT symbol, "offset", price,
         CASE WHEN ok THEN mean END AS sma,
         CASE WHEN ok THEN floor((2 * su + sc) / (2 * sc)) / 10000.0 END AS sma4,
         CASE WHEN abs(price - sma) / nullif(sma, 0) > 0.005
              THEN CASE WHEN price > sma THEN 'PRICE_SURGE' ELSE 'PRICE_DROP' END END AS alert_type
  FROM w)"""


def _rolling_out(df):
    """The mean is compared at 4 decimals, rounded exactly (see ``rolling_mean(exact4=)``)."""
    return df.select("symbol", "offset", "price", F.col("sma4").alias("sma"), "alert_type")


_ROLLING_SELECT = 'SELECT symbol, "offset", price, sma4 AS sma, alert_type FROM a'


@register("rolling_mean_alerts", _rolling_sql("event_type") + _ROLLING_SELECT)
def rolling_mean_alerts(spark, sf_dir):
    """10-tick rolling mean per symbol in arrival order and deviation alerts."""
    from ..operators.rolling import rolling_alerts
    return _rolling_out(rolling_alerts(event_ticks(spark, sf_dir), exact4=True))


@register("rolling_mean_alerts_chunked", _rolling_sql("event_type") + _ROLLING_SELECT)
def rolling_mean_alerts_chunked(spark, sf_dir):
    """W1-W3 with 64-offset chunks: hot symbols split over many tasks, halo rows join them."""
    from ..operators.rolling import rolling_alerts
    return _rolling_out(rolling_alerts(event_ticks(spark, sf_dir), chunk_size=SMALL_CHUNK,
                                       exact4=True))


@register("rolling_alerts_users", _rolling_sql(_USER) + _ROLLING_SELECT)
def rolling_alerts_users(spark, sf_dir):
    """W1-W3 over sparse symbols with small chunks (halo gathered across empty chunks)."""
    from ..operators.rolling import rolling_alerts
    return _rolling_out(rolling_alerts(event_ticks(spark, sf_dir, "user_id"),
                                       chunk_size=USER_CHUNK, exact4=True))


_ORDERS_TICKS = """ticks AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS timestamp, o_totalprice AS price,
         0 AS partition, o_orderkey AS "offset"
  FROM orders)"""


@register("rolling_alerts_orders",
          _rolling_sql("event_type").replace(_ticks_sql("event_type"), _ORDERS_TICKS)
          + _ROLLING_SELECT)
def rolling_alerts_orders(spark, sf_dir):
    """W1-W3 on the orders table (priorities as symbols, order key as arrival order)."""
    from ..operators.rolling import rolling_alerts
    from ..sources.fixtures import ticks_from_orders
    ticks = ticks_from_orders(load_table(spark, sf_dir, "orders"))
    return _rolling_out(rolling_alerts(ticks, chunk_size=256, exact4=True))


@register("session_stats", _rolling_sql("event_type") + """
SELECT symbol, count(*) AS ticks, min(price) AS min_price, max(price) AS max_price,
       count(alert_type) AS alerts
FROM a GROUP BY symbol""")
def session_stats(spark, sf_dir):
    """A2: per-symbol ticks, min, max and price-alert count."""
    from ..operators.rolling import rolling_alerts, session_stats as stats
    return stats(rolling_alerts(event_ticks(spark, sf_dir)))


@register("session_summary", _rolling_sql("event_type") + """
SELECT symbol, count(*) AS ticks, printf('$%.4f', min(price)) AS min_text,
       printf('$%.4f', max(price)) AS max_text, count(alert_type) AS alerts
FROM a GROUP BY symbol""")
def session_summary(spark, sf_dir):
    """K9, F8: the session summary rows, sorted by symbol."""
    from ..operators.rolling import rolling_alerts, session_stats as stats
    from ..operators.serving import session_summary as summary
    return summary(stats(rolling_alerts(event_ticks(spark, sf_dir))))


@register("tick_display", _rolling_sql("event_type") + """
SELECT symbol, "offset", printf('$%.4f', price) AS price_text,
       CASE WHEN sma IS NULL OR sma = 0 THEN 'SMA=building...' ELSE printf('SMA=$%.4f', sma) END
         AS sma_text,
       CASE WHEN alert_type IS NOT NULL THEN
         printf('%s %.3f%% from SMA $%.4f',
                CASE WHEN alert_type = 'PRICE_SURGE' THEN '⬆ SURGE' ELSE '⬇ DROP' END,
                abs(price - sma) / sma * 100, sma) END AS alert_text
FROM a""")
def tick_display(spark, sf_dir):
    """per-tick price, mean and alert texts."""
    from ..functions import format as fmt
    from ..operators.rolling import rolling_alerts
    a = rolling_alerts(event_ticks(spark, sf_dir))
    return a.select("symbol", "offset", fmt.dollars("price").alias("price_text"),
                    fmt.sma_text("sma").alias("sma_text"),
                    fmt.alert_text("alert_type", "deviation", "sma").alias("alert_text"))


# ---------------------------------------------------------------------------
# Latest price, freshness, history, % change
# ---------------------------------------------------------------------------

@register("latest_price", f"""WITH {_ticks_sql(_USER)}
SELECT symbol, arg_max(price, "offset") AS price FROM ticks GROUP BY symbol""")
def latest_price(spark, sf_dir):
    """A3: last price per symbol in arrival order (150 user symbols)."""
    from ..operators.latest import latest_price as lp
    return lp(event_ticks(spark, sf_dir, "user_id"))


@register("freshness", f"""WITH {_ticks_sql(_USER)},
s AS (SELECT symbol, max(kafka_timestamp) AS last_update,
             (SELECT max(kafka_timestamp) FROM ticks) AS as_of
      FROM ticks GROUP BY symbol)
SELECT symbol, last_update,
       (epoch_us(as_of) - epoch_us(last_update)) / 1e6 AS age_seconds,
       printf('%.1f', (epoch_us(as_of) - epoch_us(last_update)) / 1e6) AS age_text
FROM s""")
def freshness(spark, sf_dir):
    """Per-symbol last update and its age at the newest broker time."""
    from ..functions.format import age_text
    from ..operators.latest import freshness as fr
    ticks = event_ticks(spark, sf_dir, "user_id")
    as_of = ticks.select(F.max("kafka_timestamp")).scalar()
    return fr(ticks, as_of, by_symbol=True).withColumn("age_text", age_text("age_seconds"))


def _history_sql(n: int, symbol: str = "event_type") -> str:
    return f"""WITH {_ticks_sql(symbol)},
h AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY partition DESC, "offset" DESC)
              AS rank FROM ticks)
SELECT symbol, "offset", timestamp, price, rank FROM h WHERE rank <= {n}"""


def _history_out(df):
    return df.select("symbol", "offset", "timestamp", "price", "rank")


@register("history_100", _history_sql(100))
def history_100(spark, sf_dir):
    """Newest 100 ticks per symbol."""
    from ..operators.history import last_n_ticks
    return _history_out(last_n_ticks(event_ticks(spark, sf_dir), 100))


@register("history_100_chunked", _history_sql(100))
def history_100_chunked(spark, sf_dir):
    """W4 with 64-offset chunks (two-level top-N doing real work)."""
    from ..operators.history import last_n_ticks
    return _history_out(last_n_ticks(event_ticks(spark, sf_dir), 100, chunk_size=SMALL_CHUNK))


@register("history_5", _history_sql(5, _USER))
def history_5(spark, sf_dir):
    """Newest 5 ticks of every user symbol."""
    from ..operators.history import last_n_ticks
    return _history_out(last_n_ticks(event_ticks(spark, sf_dir, "user_id"), 5,
                                     chunk_size=SMALL_CHUNK))


@register("pct_change", _history_sql(100).replace(
    'SELECT symbol, "offset", timestamp, price, rank FROM h WHERE rank <= 100', """,
k AS (SELECT * FROM h WHERE rank <= 100),
b AS (SELECT *, arg_min(price, "offset") OVER (PARTITION BY symbol) AS base_price FROM k)
SELECT symbol, "offset", price, base_price,
       round((price - base_price) / nullif(base_price, 0) * 100, 4) AS pct_change FROM b"""))
def pct_change(spark, sf_dir):
    """% change from the oldest retained tick, per symbol."""
    from ..operators.history import last_n_ticks, pct_change as pc
    h = pc(last_n_ticks(event_ticks(spark, sf_dir), 100))
    return h.select("symbol", "offset", "price", "base_price", "pct_change")


_TS_TEXT = ("CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') "
            "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END")


@register("history_json_roundtrip", f"""
SELECT symbol, rank, {_TS_TEXT} AS timestamp, value AS price
FROM (SELECT *, event_type AS symbol,
             row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rank
      FROM events) h
WHERE rank <= 100 AND value IS NOT NULL""")
def history_json_roundtrip(spark, sf_dir):
    """K3 + S7, F4: history stored as JSON entries and read back oldest-first."""
    from ..operators.history import history_entries, last_n_ticks, read_history
    return read_history(history_entries(last_n_ticks(event_ticks(spark, sf_dir), 100)))


@register("live_channel", f"""
SELECT symbol, arg_max(value, event_id) AS price,
       arg_max(CAST(json_extract_string(props, '$.k') AS BIGINT) * 20000, event_id) AS volume,
       arg_max({_TS_TEXT}, event_id) AS timestamp,
       'synthetic' AS source, max(ts) AS last_update
FROM (SELECT *, CAST(user_id AS VARCHAR) AS symbol FROM events) e
GROUP BY symbol""")
def live_channel(spark, sf_dir):
    """Channel messages (one per tick, plus every raw page as a bad message)
    → latest live tick per symbol; unparsable messages skipped."""
    from ..functions.parse import tick_json, timestamp_text
    from ..operators.latest import channel_latest
    t = event_ticks(spark, sf_dir, "user_id")
    good = t.select(F.lit("message").alias("type"),
                    tick_json(F.col("symbol"), F.col("price"), F.col("volume"),
                              timestamp_text(F.col("timestamp")), F.col("source")).alias("data"),
                    F.col("kafka_timestamp").alias("received_at"), "partition", "offset")
    bad = load_table(spark, sf_dir, "pages").select(
        F.lit("message").alias("type"), F.col("html").alias("data"),
        F.lit(None).cast("timestamp").alias("received_at"), F.lit(1).alias("partition"),
        F.col("page_id").cast("bigint").alias("offset"))
    out = channel_latest(good.unionByName(bad))
    return out.select("symbol", "price", "volume", "timestamp", "source", "last_update")


# ---------------------------------------------------------------------------
# Serving queries on the window table
# ---------------------------------------------------------------------------

_W5 = _WINDOW_SQL.format(d="5 minutes", sym="event_type", avg=_AVG_EXACT)


@register("latest_window", f"""
SELECT DISTINCT ON (symbol) symbol, window_start, window_end, avg_price, min_price,
       max_price, tick_count
FROM ({_W5}) w ORDER BY symbol, window_start DESC""")
def latest_window(spark, sf_dir):
    """Newest 5-minute window per symbol."""
    return win.latest_window(win.window_aggregates(event_ticks(spark, sf_dir), mode="exact"))


@register("windows_last_hour", f"""
SELECT * FROM ({_W5}) w
WHERE window_start > (SELECT max(ts) FROM events) - INTERVAL '1 hour'""")
def windows_last_hour(spark, sf_dir):
    """All windows that started in the hour before the newest tick."""
    ticks = event_ticks(spark, sf_dir)
    as_of = ticks.select(F.max("timestamp")).scalar()
    since = F.lit(as_of) - F.expr("INTERVAL 1 HOUR")
    return win.windows_since(win.window_aggregates(ticks, mode="exact"), since)


@register("windows_top10", f"""
SELECT * FROM ({_W5}) w ORDER BY window_start DESC, symbol LIMIT 10""")
def windows_top10(spark, sf_dir):
    """Newest 10 window rows overall."""
    return win.top_windows(win.window_aggregates(event_ticks(spark, sf_dir), mode="exact"), 10)


@register("window_display", f"""
SELECT symbol, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start_text,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end_text,
       printf('$%.4f', avg_price) AS avg_text, printf('$%.4f', min_price) AS min_text,
       printf('$%.4f', max_price) AS max_text, tick_count
FROM (SELECT DISTINCT ON (symbol) * FROM ({_W5}) w ORDER BY symbol, window_start DESC) x""")
def window_display(spark, sf_dir):
    """Dashboard table: latest window per symbol as display texts."""
    from ..operators.serving import window_rows
    return window_rows(win.latest_window(win.window_aggregates(event_ticks(spark, sf_dir), mode="exact")))


# ---------------------------------------------------------------------------
# Overlay, cards, live detail (joins)
# ---------------------------------------------------------------------------

# Fixture watchlist for the event-type symbols, in display order; 'refund'
# never occurs, so its card shows the missing-price text.
EVENT_WATCHLIST = ["view", "click", "purchase", "signup", "error", "refund"]


def _stored_live(ticks):
    """Split at one day before the newest tick: stored = latest before, live = after."""
    from ..operators.latest import latest_price as lp, latest_tick
    cut = F.lit(ticks.select(F.max("timestamp")).scalar()) - F.expr("INTERVAL 1 DAY")
    stored = lp(ticks.where(F.col("timestamp") < cut))
    live = latest_tick(ticks.where(F.col("timestamp") >= cut))
    return stored, live


def _overlay_sql(symbol: str) -> str:
    return f"""WITH {_ticks_sql(symbol)},
stored AS (SELECT symbol, arg_max(price, "offset") AS price FROM ticks
           WHERE timestamp < (SELECT max(ts) - INTERVAL '1 day' FROM events) GROUP BY symbol),
live AS (SELECT symbol, arg_max(price, "offset") AS price,
                arg_max(volume, "offset") AS volume, arg_max(timestamp, "offset") AS timestamp
         FROM ticks WHERE timestamp >= (SELECT max(ts) - INTERVAL '1 day' FROM events)
         GROUP BY symbol),
overlay AS (
  SELECT coalesce(l.symbol, s.symbol) AS symbol,
         CASE WHEN l.symbol IS NOT NULL THEN l.price ELSE s.price END AS price,
         l.symbol IS NOT NULL AS is_live
  FROM stored s FULL OUTER JOIN live l ON s.symbol = l.symbol)"""


@register("price_overlay", _overlay_sql(_USER) + " SELECT * FROM overlay")
def price_overlay(spark, sf_dir):
    """Stored latest prices overridden by the live ones (150 user symbols)."""
    from ..operators.serving import price_overlay as po
    stored, live = _stored_live(event_ticks(spark, sf_dir, "user_id"))
    return po(stored, live)


_WATCH_VALUES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(EVENT_WATCHLIST))


@register("price_cards", _overlay_sql("event_type") + f"""
SELECT d.ord, d.symbol, o.price, coalesce(o.is_live, false) AS is_live,
       CASE WHEN o.price IS NULL OR o.price = 0 THEN '—' ELSE printf('$%.4f', o.price) END
         AS price_text
FROM (VALUES {_WATCH_VALUES}) d(ord, symbol) LEFT JOIN overlay o ON d.symbol = o.symbol""")
def price_cards(spark, sf_dir):
    """One card per watchlist symbol in order; missing shown as '—'."""
    from ..operators.serving import price_overlay as po, symbol_cards, symbol_dim
    stored, live = _stored_live(event_ticks(spark, sf_dir))
    return symbol_cards(symbol_dim(spark, EVENT_WATCHLIST), po(stored, live))


@register("live_detail", _overlay_sql("event_type") + f"""
SELECT d.ord, l.symbol, l.price, l.volume, l.timestamp, printf('$%.4f', l.price) AS price_text,
       format('{{:,}}', l.volume) AS volume_text,
       strftime(l.timestamp, '%Y-%m-%d %H:%M:%S') AS time_text
FROM (VALUES {_WATCH_VALUES}) d(ord, symbol) JOIN live l ON d.symbol = l.symbol""")
def live_detail(spark, sf_dir):
    """Live tick details of the watchlist symbols that have one."""
    from ..operators.serving import live_detail as ld, symbol_dim
    _, live = _stored_live(event_ticks(spark, sf_dir))
    return ld(symbol_dim(spark, EVENT_WATCHLIST), live)


# Streaming queries register themselves into the same catalog.
from . import stream_queries  # noqa: E402,F401
