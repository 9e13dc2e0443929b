import json

from pyspark.sql import functions as F

from tickworks.functions.parse import timestamp_to_iso
from tickworks.operators.ingest import (key_audit, live_ticks, parse_rejects, parse_ticks,
                                        to_kafka_records, unpack_envelopes)

TS = "2024-01-01T00:00:07.179575+00:00"


def records(spark, payloads, keys=None):
    keys = keys or ["AAPL"] * len(payloads)
    rows = [(k.encode() if k is not None else None, p.encode() if p is not None else None,
             "ticks", 0, i) for i, (k, p) in enumerate(zip(keys, payloads))]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, "
                                     "offset bigint")
    return df.withColumn("timestamp", F.lit("2024-01-01 00:00:08").cast("timestamp"))


PARSE_MIXED = [
    json.dumps({"symbol": "AAPL", "timestamp": TS, "price": 1.5, "volume": 10, "source": "x"}),
    json.dumps({"symbol": "AAPL", "timestamp": TS, "price": 1.5, "volume": 100.0}),
    json.dumps({"symbol": "AAPL", "timestamp": TS, "price": 1.5, "volume": 0.5}),
    json.dumps({"symbol": "AAPL", "timestamp": "garbage", "price": "abc", "volume": 1}),
    json.dumps({"symbol": "AAPL", "timestamp": TS, "price": "2.5", "volume": "10"}),
    '{"symbol": "AAPL", "timestamp": "2024-01-01T00:00',
    "",
    None,
    json.dumps({"timestamp": TS, "price": 1.0}),
    json.dumps([{"symbol": "AAPL", "price": 1.0}]),
    json.dumps({"symbol": None, "price": 1.0}),
    json.dumps({"symbol": 5, "timestamp": TS, "price": 1.0}),
    "null",
    json.dumps({"symbol": "", "timestamp": TS, "price": 1.0}),
]


def test_parse_mixed(spark):
    out = parse_ticks(records(spark, PARSE_MIXED)).orderBy("offset").collect()
    assert [r.offset for r in out] == [0, 1, 2, 3, 4, 11, 13]
    by = {r.offset: r for r in out}
    assert by[0].price == 1.5 and by[0].volume == 10 and by[0].source == "x"
    assert str(by[0].timestamp) == "2024-01-01 00:00:07.179575"
    assert by[1].volume is None and by[2].volume is None
    assert by[3].timestamp is None and by[3].price is None and by[3].volume == 1
    assert by[4].price is None and by[4].volume is None
    assert by[11].symbol == "5"
    assert by[13].symbol == ""
    rej = parse_rejects(records(spark, PARSE_MIXED)).collect()
    assert sorted(r.offset for r in rej) == [5, 6, 7, 8, 9, 10, 12]


def test_lenient_volume(spark):
    out = parse_ticks(records(spark, PARSE_MIXED[:3]), lenient_volume=True).orderBy("offset")
    assert [r.volume for r in out.collect()] == [10, 100, 0]


def test_single_parse_plan(spark):
    plan = parse_ticks(records(spark, PARSE_MIXED))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_live_ticks_skips_empty_symbol(spark):
    out = live_ticks(parse_ticks(records(spark, PARSE_MIXED))).collect()
    assert all(r.symbol for r in out) and len(out) == 6


def test_symbol_from_key_and_audit(spark):
    payloads = [json.dumps({"symbol": "MSFT", "timestamp": TS, "price": 2.0}),
                json.dumps({"symbol": "AAPL", "timestamp": TS, "price": 3.0})]
    recs = records(spark, payloads, keys=["AAPL", "AAPL"])
    assert [r.symbol for r in parse_ticks(recs).orderBy("offset").collect()] == ["MSFT", "AAPL"]
    assert [r.symbol for r in parse_ticks(recs, symbol_from="key").collect()] == ["AAPL"] * 2
    a = key_audit(recs).collect()[0]
    assert (a.n_records, a.n_parsed, a.n_key_mismatch) == (2, 2, 1)


def test_envelope_mixed(spark):
    env = [json.dumps({"type": "trade", "data": [
               {"s": "AAPL", "p": 189.5, "v": 100, "t": 1704067207123},
               {"s": "MSFT", "p": 370.25, "v": 5, "t": 1704067208000}]}),
           json.dumps({"type": "ping"}),
           json.dumps({"type": "trade"})]
    df = spark.createDataFrame([(e,) for e in env], "raw string")
    out = unpack_envelopes(df, source="vendor").orderBy("symbol").collect()
    assert [(r.symbol, r.timestamp, r.price, r.volume, r.source) for r in out] == [
        ("AAPL", "2024-01-01T00:00:07.123000+00:00", 189.5, 100, "vendor"),
        ("MSFT", "2024-01-01T00:00:08+00:00", 370.25, 5, "vendor")]
    # wire records parse back into the same ticks
    recs = (to_kafka_records(unpack_envelopes(df))
            .withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0))
            .withColumn("offset", F.monotonically_increasing_id())
            .withColumn("timestamp", F.current_timestamp()))
    back = parse_ticks(recs).orderBy("symbol").collect()
    assert [(r.symbol, str(r.timestamp), r.price) for r in back] == [
        ("AAPL", "2024-01-01 00:00:07.123000", 189.5), ("MSFT", "2024-01-01 00:00:08", 370.25)]


def test_iso_format(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07",)], "s string")
    r = df.select(timestamp_to_iso(F.col("s").cast("timestamp")).alias("t")).first()
    assert r.t == "2024-01-01T00:00:07+00:00"
    from datetime import datetime, timezone
    for ms in (1704067207123, 1704067207000, 1704067207001):
        want = datetime.fromtimestamp(ms / 1000, tz=timezone.utc).isoformat()
        got = spark.createDataFrame([(ms,)], "t bigint").select(
            timestamp_to_iso(F.timestamp_millis("t")).alias("t")).first().t
        assert got == want


def test_envelope_single_parse(spark):
    df = spark.createDataFrame([('{"type":"trade","data":[]}',)], "raw string")
    plan = unpack_envelopes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1, plan
