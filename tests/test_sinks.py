from tickworks.operators.alerts import volume_alerts
from tickworks.operators.windows import window_aggregates
from tickworks.schema import TICK_COLUMNS
from tickworks.streaming.sinks import (AlertAppendSink, SnapshotSink, WindowUpsertSink,
                                       compact_window_date, history_fold, latest_fold,
                                       read_snapshot, read_window_table, stats_fold)
from tests.conftest import tick_rows


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_window_upsert_replay_and_update(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/w"
    sink = WindowUpsertSink(path)
    b0 = window_aggregates(tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 1, 0),
                                             ("B", "2024-01-02 00:01:00", 4.0, 1, 1)]))
    sink(b0, 0)
    first = _rows(read_window_table(spark, path).drop("created_at", "changed_at"))
    sink(b0, 0)                                   # replay: same batch id
    assert _rows(read_window_table(spark, path).drop("created_at", "changed_at")) == first
    b1 = window_aggregates(tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 1, 0),
                                             ("A", "2024-01-01 00:02:00", 3.0, 1, 2)]))
    created = read_window_table(spark, path).where("symbol = 'A'").first().created_at
    sink(b1, 1)
    t = {r.symbol: r for r in read_window_table(spark, path).collect()}
    compact_window_date(spark, path, "2024-01-01", "000000-000000000001")
    assert {r.symbol: r for r in read_window_table(spark, path).collect()} == t
    late = read_window_table(spark, path, since="2024-01-02")
    assert [r.symbol for r in late.collect()] == ["B"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "window_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(t) == 2 and t["A"].avg_price == 2.0 and t["A"].tick_count == 2
    assert t["A"].created_at == created           # created_at untouched on update
    assert t["B"].avg_price == 4.0                # other dates untouched


def test_alert_append_idempotent_and_empty(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/a"
    sink = AlertAppendSink(path)
    t = tick_rows(spark, [("A", "2024-01-01 00:00:01", 1.0, 2_000_000, 1)])
    sink(volume_alerts(t.where("false")), 0)     # empty batch: no write, no failure
    sink(volume_alerts(t), 1)
    sink(volume_alerts(t), 1)
    assert spark.read.parquet(path).count() == 1


def test_snapshots_replay(spark, tmpdir_fresh):
    cols = list(TICK_COLUMNS)
    latest = SnapshotSink(f"{tmpdir_fresh}/l", latest_fold(cols))
    hist = SnapshotSink(f"{tmpdir_fresh}/h", history_fold(cols, 2))
    b0 = tick_rows(spark, [("A", "2024-01-01 00:00:01", 1.0, 1, 1),
                           ("A", "2024-01-01 00:00:02", 2.0, 1, 2)])
    b1 = tick_rows(spark, [("A", "2024-01-01 00:00:03", 3.0, 1, 3)])
    for b, i in ((b0, 0), (b1, 1), (b1, 1)):      # batch 1 delivered twice
        latest(b, i)
        hist(b, i)
    assert read_snapshot(spark, f"{tmpdir_fresh}/l").first().price == 3.0
    h = sorted((r.rank, r.price) for r in read_snapshot(spark, f"{tmpdir_fresh}/h").collect())
    assert h == [(1, 3.0), (2, 2.0)]


def test_stats_fold(spark, tmpdir_fresh):
    s = SnapshotSink(f"{tmpdir_fresh}/s", stats_fold())
    mk = lambda rows: spark.createDataFrame(rows, "symbol string, price double, alert_type string")
    s(mk([("A", 2.0, None), ("A", 5.0, "PRICE_SURGE")]), 0)
    s(mk([("A", 1.0, None)]), 1)
    s(mk([("A", 1.0, None)]), 1)
    r = read_snapshot(spark, f"{tmpdir_fresh}/s").first()
    assert (r.ticks, r.min_price, r.max_price, r.alerts) == (3, 1.0, 5.0, 1)


def test_alert_rejects_null_timestamp(spark, tmpdir_fresh):
    sink = AlertAppendSink(f"{tmpdir_fresh}/a", reject_path=f"{tmpdir_fresh}/r")
    t = tick_rows(spark, [("A", "2024-01-01 00:00:01", 1.0, 2_000_000, 1),
                          ("A", "garbage", 1.0, 2_000_000, 2)])
    sink(volume_alerts(t), 0)
    assert [r.offset for r in spark.read.parquet(f"{tmpdir_fresh}/a").collect()] == [1]
    assert [r.offset for r in spark.read.parquet(f"{tmpdir_fresh}/r").collect()] == [2]


def test_empty_batches_write_nothing(spark, tmpdir_fresh):
    from tickworks.streaming.sinks import path_exists
    t = tick_rows(spark, [("A", "2024-01-01 00:00:01", 1.0, 1, 1)]).where("false")
    WindowUpsertSink(f"{tmpdir_fresh}/w")(window_aggregates(t), 0)
    SnapshotSink(f"{tmpdir_fresh}/s", latest_fold(list(TICK_COLUMNS)))(t, 0)
    assert not path_exists(spark, f"{tmpdir_fresh}/w")
    assert not path_exists(spark, f"{tmpdir_fresh}/s")


def test_new_checkpoint_keeps_what_was_written(spark, tmpdir_fresh):
    """Two streams that both start at batch 0, and a batch delivered again."""
    cols = list(TICK_COLUMNS)
    b = [tick_rows(spark, [("A", f"2024-01-01 00:0{i + 1}:00", 1.0 + i, 2_000_000, i)]) for i in range(2)]
    for query, batch in zip("xy", b):
        for _ in range(2):
            AlertAppendSink(f"{tmpdir_fresh}/a", query=query)(volume_alerts(batch), 0)
            WindowUpsertSink(f"{tmpdir_fresh}/w", query=query)(window_aggregates(batch, "1 minute"), 0)
            SnapshotSink(f"{tmpdir_fresh}/l", latest_fold(cols), query=query)(batch, 0)
            SnapshotSink(f"{tmpdir_fresh}/h", history_fold(cols, 5), query=query)(batch, 0)
    assert spark.read.parquet(f"{tmpdir_fresh}/a").count() == 2
    assert read_window_table(spark, f"{tmpdir_fresh}/w").count() == 2
    assert read_snapshot(spark, f"{tmpdir_fresh}/l").first().price == 2.0
    assert read_snapshot(spark, f"{tmpdir_fresh}/h").count() == 2


def test_streams_write_under_their_own_id(spark, tmpdir_fresh):
    from tickworks.streaming import jobs
    tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 2_000_000, 0)]).write.parquet(f"{tmpdir_fresh}/in")
    schema = spark.read.parquet(f"{tmpdir_fresh}/in").schema
    for i in range(2):
        ticks = spark.readStream.schema(schema).parquet(f"{tmpdir_fresh}/in")
        jobs.start_volume_alerts(ticks, f"{tmpdir_fresh}/a", f"{tmpdir_fresh}/c{i}",
                                 trigger=jobs.AVAILABLE_NOW).awaitTermination()
    ids = {r.query_id for r in spark.read.parquet(f"{tmpdir_fresh}/a").collect()}
    assert len(ids) == 2 and "direct" not in ids


def test_fixed_text_of_any_double(spark):
    from tickworks.functions.format import fixed
    values = [37.8125, 0.5, 1.5, 2.5, -0.00005, 0.99999, 123456789012345.678, 4503599627370497.5, 1e16,
              float("nan"), float("inf"), float("-inf"), 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for k in (0, 3, 4):
        got = [r.t for r in df.select("i", fixed("v", k).alias("t")).orderBy("i").collect()]
        assert got[:-1] == [f"%.{k}f" % v for v in values[:-1]]
        assert got[-1].startswith("1")


def test_key_mode_splits_records(spark):
    from tickworks.operators.ingest import parse_rejects, parse_ticks
    rows = [(b"A", b"<html>"), (b"A", b'{"price": 1.0}'), (None, b'{"symbol": "A"}'), (b"A", None)]
    recs = spark.createDataFrame([(k, v, "t", 0, i) for i, (k, v) in enumerate(rows)],
                                 "key binary, value binary, topic string, partition int, offset bigint")
    recs = recs.selectExpr("*", "current_timestamp() AS timestamp")
    for mode, kept in (("key", [1]), ("value", [2])):
        assert [r.offset for r in parse_ticks(recs, symbol_from=mode).collect()] == kept
        gone = {r.offset for r in parse_rejects(recs, symbol_from=mode).collect()}
        assert gone == {0, 1, 2, 3} - set(kept)


def window_batch(spark, price, symbol="A", day=1):
    return window_aggregates(tick_rows(spark, [(symbol, f"2024-01-{day:02d} 00:01:00", price, 1, 0)]))


def test_newest_stream_wins_whatever_the_clock(spark, tmpdir_fresh, monkeypatch):
    """Order is (epoch of the stream, batch id): a clock set back changes nothing."""
    from pyspark.sql import functions as F
    path = f"{tmpdir_fresh}/w"
    first, second = WindowUpsertSink(path, query="x"), WindowUpsertSink(path, query="y")
    first(window_batch(spark, 1.0), 7)
    # the driver restarts on a host whose clock is a day behind, with a new checkpoint
    back = F.lit("2001-01-01 00:00:00").cast("timestamp")
    monkeypatch.setattr("tickworks.streaming.sinks.F.current_timestamp", lambda: back)
    second(window_batch(spark, 2.0), 0)
    second(window_batch(spark, 3.0), 1)
    second(window_batch(spark, 2.0), 0)           # delivered again: still older than batch 1
    first(window_batch(spark, 1.0), 7)
    row = read_window_table(spark, path).first()
    assert row.avg_price == 3 and row.seq >> 40 == 1 and row.seq % (1 << 40) == 1
    assert WindowUpsertSink(path, query="x").epoch(spark) == 0 and WindowUpsertSink(path, query="z").epoch(spark) == 2
    assert WindowUpsertSink(path, query="y").epoch(spark) == 1


def test_a_day_of_batches_reads_few_folders(spark, tmpdir_fresh):
    import glob
    path = f"{tmpdir_fresh}/w"
    sink = WindowUpsertSink(path, query="x", compact_after=4)
    most = 0
    for i in range(30):
        sink(window_batch(spark, float(i), symbol="ABC"[i % 3]), i)
        if i % 7 == 3:
            sink(window_batch(spark, float(i), symbol="ABC"[i % 3]), i)      # delivered again
        most = max(most, len(glob.glob(f"{path}/window_date=2024-01-01/change=*")))
    assert most <= 9
    got = {r.symbol: (float(r.avg_price), r.seq) for r in read_window_table(spark, path).collect()}
    assert got == {"A": (27.0, 27), "B": (28.0, 28), "C": (29.0, 29)}


def test_fold_loses_nothing_that_is_written_meanwhile(spark, tmpdir_fresh):
    """A crash at any step, a second delivery, and a change that comes after the listing."""
    path = f"{tmpdir_fresh}/w"
    a, b = WindowUpsertSink(path, query="x", compact_after=0), WindowUpsertSink(path, query="y", compact_after=0)
    rows = lambda: {r.symbol: float(r.avg_price) for r in read_window_table(spark, path).collect()}
    for i, s in enumerate("AB"):
        a(window_batch(spark, float(i), s), i)
    compact_window_date(spark, path, "2024-01-01", "000000-000000000001")
    created = read_window_table(spark, path).where("symbol = 'A'").first().created_at
    b(window_batch(spark, 9.0, "C"), 0)            # in no list yet
    a(window_batch(spark, 5.0, "A"), 2)
    want = {"A": 5.0, "B": 1.0, "C": 9.0}
    for _ in range(2):
        compact_window_date(spark, path, "2024-01-01", "000000-000000000002")
        assert rows() == want
    b(window_batch(spark, 8.0, "B"), 1)
    compact_window_date(spark, path, "2024-01-01", "000001-000000000001")
    assert rows() == want | {"B": 8.0}
    assert read_window_table(spark, path).where("symbol = 'A'").first().created_at == created


def test_stored_types(spark, tmpdir_fresh):
    from tickworks.sources.streams import archive_read, archive_stream
    from tickworks.streaming.sinks import start_archive
    WindowUpsertSink(f"{tmpdir_fresh}/w")(window_batch(spark, 1.23456), 0)
    assert dict(spark.read.parquet(f"{tmpdir_fresh}/w").dtypes)["max_price"] == "decimal(12,4)"
    ticks = tick_rows(spark, [("A", "2024-01-01 00:00:01", 10.123456, 5, 1), ("A", None, 1.0, 5, 2), ("B", "2024-01-02 00:00:01", 1e12, 5, 3)])
    ticks.write.parquet(f"{tmpdir_fresh}/in/part0.parquet")
    src = spark.readStream.schema(ticks.schema).parquet(f"{tmpdir_fresh}/in/part*.parquet")
    start_archive(src, f"{tmpdir_fresh}/a", f"{tmpdir_fresh}/c", trigger={"availableNow": True}).awaitTermination()
    raw = spark.read.parquet(f"{tmpdir_fresh}/a")
    types = dict(raw.dtypes)
    assert types["price"] == "decimal(12,4)" and types["created_at"] == "timestamp" and raw.where("created_at is null").isEmpty()
    got = {r.offset: (r.symbol, r.price, r.volume) for r in archive_read(spark, f"{tmpdir_fresh}/a").collect()}
    assert got == {1: ("A", 10.1235, 5), 2: ("A", 1.0, 5), 3: ("B", None, 5)}
    q = (archive_stream(spark, f"{tmpdir_fresh}/a", max_files_per_trigger=1).writeStream.format("parquet")
         .option("path", f"{tmpdir_fresh}/o").option("checkpointLocation", f"{tmpdir_fresh}/c2").trigger(availableNow=True).start())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) > 1
    assert {r.offset: (r.symbol, r.price, r.volume) for r in spark.read.parquet(f"{tmpdir_fresh}/o").collect()} == got


def test_stored_windows_of_a_symbol_prune(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/w"
    sink = WindowUpsertSink(path)
    for i, day in enumerate((1, 2, 3)):
        for j, s in enumerate("AB"):
            sink(window_batch(spark, float(i), s, day), 2 * i + j)
    out = read_window_table(spark, path, since="2024-01-02 12:00:00", symbol="B")
    assert [(r.symbol, float(r.avg_price)) for r in out.collect()] == [("B", 2.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "window_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "IsNotNull(symbol)" in plan.split("PushedFilters: [")[1].split("]")[0]      # the text is cut after it


def test_channel_files_do_not_grow_with_symbols(spark, tmpdir_fresh):
    import glob
    from tickworks.streaming.sinks import CHANNEL_BUCKETS, read_channel, start_channel_publish
    n = 100_000
    ticks = spark.range(n).selectExpr(
        "concat('s', id) AS symbol", "timestamp '2024-01-01 00:00:00' AS timestamp", "1.0D AS price", "id AS volume",
        "'t' AS source", "timestamp '2024-01-01 00:00:00' AS kafka_timestamp", "0 AS partition", "id AS offset")
    ticks.repartition(3).write.parquet(f"{tmpdir_fresh}/in/part0.parquet")
    src = spark.readStream.schema(ticks.schema).parquet(f"{tmpdir_fresh}/in/part*.parquet")
    start_channel_publish(src, f"{tmpdir_fresh}/chan", f"{tmpdir_fresh}/c", trigger={"availableNow": True}).awaitTermination()
    assert len(glob.glob(f"{tmpdir_fresh}/chan/*/*/*.parquet")) <= 4 * CHANNEL_BUCKETS
    assert read_channel(spark, f"{tmpdir_fresh}/chan").count() == n
    one = read_channel(spark, f"{tmpdir_fresh}/chan", "s77", since="2024-01-01")
    assert [r.offset for r in one.collect()] == [77]
    filters = one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("DataFilters")[0].split("PushedFilters")[0]
    assert "bucket" in filters and "received_date" in filters
    assert read_channel(spark, f"{tmpdir_fresh}/none").count() == 0


def test_channel_reader_stream_and_batch(spark, tmpdir_fresh):
    """A live table over several batches: bad and non-message frames skipped, late arrivals lose, last update kept."""
    import json
    from tickworks.operators.latest import channel_latest
    from tickworks.streaming import jobs
    msg = lambda s, p: json.dumps({"symbol": s, "price": p, "volume": 1, "timestamp": "x", "source": "t"})
    schema = "type string, data string, received_at timestamp, partition int, offset bigint"
    batches = [[("subscribe", msg("A", 9.0), "2024-01-01 00:00:00", 0, 0), ("message", msg("A", 1.0), "2024-01-01 00:00:01", 0, 1),
                ("message", "{bad", "2024-01-01 00:00:02", 0, 2), ("message", msg("", 3.0), "2024-01-01 00:00:03", 0, 3)],
               [("message", msg("B", 5.0), "2024-01-01 00:00:09", 0, 5), ("message", msg("A", 4.0), "2024-01-01 00:00:04", 0, 4)],
               [("message", msg("B", 2.0), "2024-01-01 00:00:11", 0, 4), ("message", None, "2024-01-01 00:00:12", 0, 9)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, schema.replace("received_at timestamp", "received_at string"))
        df.selectExpr("type", "data", "CAST(received_at AS timestamp) AS received_at", "partition", "offset").coalesce(1).write.parquet(f"{tmpdir_fresh}/in/part{i}.parquet")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_fresh}/in/part*.parquet")
    q = jobs.start_channel_reader(src, f"{tmpdir_fresh}/live", f"{tmpdir_fresh}/c", trigger=jobs.AVAILABLE_NOW)
    q.awaitTermination()
    live = {r.symbol: (r.price, r.offset, str(r.last_update)) for r in read_snapshot(spark, f"{tmpdir_fresh}/live").collect()}
    assert live == {"A": (4.0, 4, "2024-01-01 00:00:04"), "B": (5.0, 5, "2024-01-01 00:00:11")}
    whole = channel_latest(spark.read.schema(schema).parquet(f"{tmpdir_fresh}/in/part*.parquet"))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("FileScan") == 1
    assert {r.symbol: (r.price, r.offset, str(r.last_update)) for r in whole.collect()} == live
