from tickworks.operators.history import history_entries, last_n_ticks, oldest_first, pct_change
from tickworks.operators.latest import freshness, latest_price, latest_tick
from tests.conftest import tick_rows


def rows_for(counts):
    rows, off = [], 0
    for s, c in counts.items():
        for i in range(c):
            rows.append((s, "2024-01-01 00:00:00", float(i + 1), 1, off))
            off += 1
    return rows


def test_history_edges(spark):
    t = tick_rows(spark, rows_for({"A": 99, "B": 100, "C": 101}))
    for chunk in (7, 1 << 20):
        h = last_n_ticks(t, 100, chunk_size=chunk)
        n = {r.symbol: r.c for r in h.groupBy("symbol").count().withColumnRenamed(
            "count", "c").collect()}
        assert n == {"A": 99, "B": 100, "C": 100}
        c = pct_change(h).where("symbol = 'C'").orderBy("offset").collect()
        assert c[0].price == 2.0 and c[0].base_price == 2.0      # oldest (1.0) gone
        assert c[-1].rank == 1 and c[-1].pct_change == round((101 - 2) / 2 * 100, 4)


def test_pct_zero_base(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 0.0, 1, 0),
                          ("A", "2024-01-01 00:00:01", 5.0, 1, 1)])
    out = [r.pct_change for r in pct_change(last_n_ticks(t, 100)).collect()]
    assert out == [None, None]


def test_time_ties_by_seq(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 7),
                          ("A", "2024-01-01 00:00:00", 2.0, 1, 8)])
    h = {r.rank: r.offset for r in last_n_ticks(t, 100).collect()}
    assert h == {1: 8, 2: 7}
    assert latest_price(t).first().price == 2.0
    assert [r.offset for r in oldest_first(last_n_ticks(t, 100)).collect()] == [7, 8]


def test_latest_tick_and_freshness(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 1),
                          ("A", "2024-01-01 00:00:09", 2.0, 1, 2),
                          ("B", "2024-01-01 00:00:05", 3.0, 1, 3)])
    lt = {r.symbol: r.price for r in latest_tick(t).collect()}
    assert lt == {"A": 2.0, "B": 3.0}
    f = {r.symbol: r.age_seconds for r in
         freshness(t, "2024-01-01 00:00:10", by_symbol=True).collect()}
    assert f == {"A": 1.0, "B": 5.0}


def test_history_entries_json(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.5, None, 1)])
    j = history_entries(last_n_ticks(t, 100)).first().tick_json
    assert j == ('{"symbol":"A","price":1.5,"volume":null,'
                 '"timestamp":"2024-01-01 00:00:00","source":"test"}')


def test_read_history_skips_malformed(spark):
    from tickworks.operators.history import read_history
    entries = spark.createDataFrame(
        [("A", 1, '{"price": 2.5, "timestamp": "2024-01-01 00:00:02"}'),
         ("A", 2, '{"price": "1.5", "timestamp": "2024-01-01 00:00:01"}'),
         ("A", 3, '{"price": null, "timestamp": "2024-01-01 00:00:00"}'),
         ("A", 4, '{"price": 9.0}'),
         ("A", 5, 'not json')], "symbol string, rank bigint, tick_json string")
    out = [(r.rank, r.price) for r in read_history(entries).collect()]
    assert out == [(2, 1.5), (1, 2.5)]


def test_timestamp_text_like_python(spark):
    from datetime import datetime
    from pyspark.sql import functions as F
    from tickworks.functions.parse import timestamp_text
    vals = ["2024-01-01 00:00:07", "2024-01-01 00:00:07.1", "2024-01-01 00:00:07.000123"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.t for r in df.select(timestamp_text(F.col("s").cast("timestamp")).alias("t")).collect()]
    assert got == [str(datetime.fromisoformat(v)) for v in vals]


def test_channel_latest_and_lag(spark):
    from pyspark.sql import functions as F
    from tickworks.operators.latest import channel_latest, ingest_lag
    msgs = spark.createDataFrame(
        [("subscribe", '{"symbol": "A", "price": 9}', 0),
         ("message", '{"symbol": "A", "price": 1.0}', 1),
         ("message", '{"symbol": "A", "price": 2.0}', 2),
         ("message", 'garbage', 3),
         ("message", '{"symbol": "", "price": 5.0}', 4),
         ("message", '{"price": 5.0}', 5)], "type string, data string, offset bigint")
    msgs = msgs.withColumn("partition", F.lit(0)).withColumn("received_at", F.current_timestamp())
    out = [(r.symbol, r.price) for r in channel_latest(msgs).collect()]
    assert out == [("A", 2.0)]
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 0)]).withColumn(
        "kafka_timestamp", F.lit("2024-01-01 00:00:01.5").cast("timestamp"))
    assert ingest_lag(t).first().lag_seconds == 1.5


def test_latest_tick_ties_nulls_and_plan(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 9, 0),
                          ("A", "2024-01-01 00:00:00", 2.0, 1, 3, 1),
                          ("A", "2024-01-01 00:00:00", 2.0, 1, 3, 1),     # delivered twice
                          (None, "2024-01-01 00:00:00", 4.0, 1, 5, 0),
                          (None, "2024-01-01 00:00:00", 5.0, 1, 6, 0)])
    out = latest_tick(t)
    assert sorted((r.symbol or "", r.price, r.offset) for r in out.collect()) == [("", 5.0, 6), ("A", 2.0, 3)]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_replay_parts_have_several_files(spark, tmpdir_fresh):
    import glob
    from tickworks.sources.fixtures import kafka_records_from_ticks
    from tickworks.sources.streams import replay_stream, write_replay_files
    recs = kafka_records_from_ticks(tick_rows(
        spark, [("A", "2024-01-01 00:00:00", float(i), 1, i) for i in range(40)]))
    path, n = write_replay_files(recs, f"{tmpdir_fresh}/in", 2, files_per_part=4)
    # a file of its own for each writing task
    assert n == 4 and [len(glob.glob(f"{p}/*.parquet")) for p in sorted(glob.glob(path))] == [4, 4]
    q = (replay_stream(spark, path, max_files_per_trigger=n).select("offset").writeStream
         .foreachBatch(lambda df, i: df.selectExpr(f"{i} AS batch", "offset").write.parquet(f"{tmpdir_fresh}/b{i}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    seen = [sorted(r.offset for r in spark.read.parquet(f"{tmpdir_fresh}/b{i}").collect()) for i in range(2)]
    assert seen == [list(range(20)), list(range(20, 40))]


def test_replay_of_few_gappy_or_no_records(spark, tmpdir_fresh):
    import glob
    from tickworks.sources.fixtures import kafka_records_from_ticks
    from tickworks.sources.streams import replay_stream, write_replay_files
    for k, offsets in enumerate(([0, 1, 2], [0, 1, 2, 1_000_000], [7], [])):
        recs = kafka_records_from_ticks(tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, i) for i in [*offsets, -1]])).where("offset >= 0")
        path, n = write_replay_files(recs, f"{tmpdir_fresh}/in{k}", 3, files_per_part=4, min_gap_s=0)
        parts = sorted(glob.glob(path))
        assert all(len(glob.glob(f"{p}/*.parquet")) == n for p in parts)
        q = (replay_stream(spark, path, max_files_per_trigger=n).select("offset").writeStream.format("parquet")
             .option("path", f"{tmpdir_fresh}/out{k}").option("checkpointLocation", f"{tmpdir_fresh}/c{k}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        if offsets:
            assert sorted(r.offset for r in spark.read.parquet(f"{tmpdir_fresh}/out{k}").collect()) == offsets
