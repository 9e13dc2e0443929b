import pytest

from tickworks.operators.ingest import parse_ticks
from tickworks.sources.fixtures import kafka_records_from_ticks
from tickworks.sources.streams import replay_stream, write_replay_files
from tickworks.streaming import jobs
from tickworks.streaming.sinks import read_appended, read_snapshot, read_window_table
from tests.conftest import tick_rows


@pytest.mark.parametrize("state", ["snapshot", "keyed"])
def test_three_named_queries(spark, tmpdir_fresh, state):
    rows = [("A", "2024-01-01 00:01:00", 1.0, 10, 0), ("B", "2024-01-01 00:02:00", 2.0, 2_000_000, 1),
            ("A", "2024-01-01 00:03:00", 3.0, 10, 2), ("A", "2024-01-01 00:06:00", 5.0, 3_000_000, 3)]
    glob, _ = write_replay_files(kafka_records_from_ticks(tick_rows(spark, rows)),
                              f"{tmpdir_fresh}/in", 2)
    log = jobs.ProgressLog()
    spark.streams.addListener(log)
    ticks = parse_ticks(replay_stream(spark, glob))
    qs = jobs.start_tick_jobs(ticks, f"{tmpdir_fresh}/out", trigger=jobs.AVAILABLE_NOW, state=state)
    assert sorted(q.name for q in qs.values()) == ["raw_ticks", "tick_channel", "volume_alerts",
                                                   "window_aggregates"]
    for q in qs.values():
        q.awaitTermination()
        assert q.exception() is None
    if state == "keyed":
        newest, history = jobs.read_tick_jobs(spark, f"{tmpdir_fresh}/out")
    else:
        newest, history = (read_snapshot(spark, f"{tmpdir_fresh}/out/{t}") for t in ("latest", "history"))
    latest = {r.symbol: r.price for r in newest.collect()}
    assert latest == {"A": 5.0, "B": 2.0}
    assert sorted((r.symbol, r["rank"], r.price) for r in history.collect()) == [("A", 1, 5.0), ("A", 2, 3.0), ("A", 3, 1.0), ("B", 1, 2.0)]
    w = {(str(r.window_start)[11:16], r.symbol): (r.avg_price, r.tick_count)
         for r in read_window_table(spark, f"{tmpdir_fresh}/out/windows").collect()}
    assert w == {("00:00", "A"): (2.0, 2), ("00:00", "B"): (2.0, 1), ("00:05", "A"): (5.0, 1)}
    assert read_appended(spark, f"{tmpdir_fresh}/out/alerts").count() == 2
    q = qs["raw_ticks"]
    seen = sum(p["observedMetrics"]["raw_ticks_rows"]["rows"] for p in q.recentProgress
               if p.get("observedMetrics"))
    assert seen == (4 if state == "snapshot" else 3)     # ticks, or symbols touched by each of two batches
    assert spark.read.parquet(f"{tmpdir_fresh}/out/channel").count() == 4
    assert jobs.partition_lag(spark, q).count() == 0     # file source
    lag = jobs.source_lag(spark, q).collect()
    assert len(lag) == 1 and lag[0].query == "raw_ticks"
    spark.streams.removeListener(log)
    events = [r for r in log.to_df(spark).collect() if r.query == "volume_alerts"]
    assert sum(r.input_rows for r in events) == 4
    assert sum(r.output_rows or 0 for r in events) == 2


def test_windows_since_symbol_and_kafka_options(spark):
    from tickworks.operators.windows import window_aggregates, windows_since
    from tickworks.streaming.sinks import kafka_sink_options
    t = tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 1, 0),
                          ("A", "2024-01-01 01:01:00", 2.0, 1, 1),
                          ("B", "2024-01-01 01:02:00", 3.0, 1, 2)])
    w = windows_since(window_aggregates(t), "2024-01-01 00:30:00", symbol="A").collect()
    assert [(r.symbol, str(r.window_start)) for r in w] == [("A", "2024-01-01 01:00:00")]
    opts = kafka_sink_options("broker:9092", "ticks")
    assert opts["kafka.acks"] == "1" and opts["kafka.retries"] == "3"
    assert opts["kafka.linger.ms"] == "50" and opts["topic"] == "ticks"


def test_processing_time_life_cycle(spark, tmpdir_fresh):
    """The four jobs on a real trigger: data that comes later is taken, one wait ends with any query, a drain loses nothing."""
    import time
    rows = [("A", f"2024-01-01 00:{i:02d}:00", float(i), 2_000_000, i) for i in range(12)]
    recs = kafka_records_from_ticks(tick_rows(spark, rows))
    d = f"{tmpdir_fresh}/in"
    glob, _ = write_replay_files(recs.where("offset < 6"), d, 2)
    qs = jobs.start_tick_jobs(parse_ticks(replay_stream(spark, glob)), f"{tmpdir_fresh}/out", trigger={"processingTime": "1 second"})
    try:
        assert not jobs.await_any(spark, 3, reset=True)            # all of them go on
        assert all(q.isActive for q in qs.values())
        time.sleep(1.05)
        write_replay_files(recs.where("offset >= 6"), d, 2, first_index=2)
        jobs.drain_and_stop(qs["volume_alerts"])
        assert jobs.await_any(spark, 30)                           # one has ended
        assert not qs["volume_alerts"].isActive and qs["raw_ticks"].isActive
        assert qs["volume_alerts"].exception() is None
        for name in ("raw_ticks", "window_aggregates", "tick_channel"):
            jobs.drain_and_stop(qs[name])
    finally:
        for q in qs.values():
            q.stop()
        spark.streams.resetTerminated()
    out = f"{tmpdir_fresh}/out"
    assert sorted(r.offset for r in read_appended(spark, f"{out}/alerts").collect()) == list(range(12))
    newest, history = jobs.read_tick_jobs(spark, out)
    assert [r.price for r in newest.collect()] == [11.0] and history.count() == 12
    assert sum(r.tick_count for r in read_window_table(spark, f"{out}/windows").collect()) == 12
    gaps = [p["timestamp"] for p in qs["raw_ticks"].recentProgress if p["numInputRows"]]
    assert len(gaps) >= 3                                          # separate triggers


def test_lag_of_a_source_that_is_behind(spark):
    """Numbers per topic partition from a progress whose latest offsets are ahead of its end."""
    import json

    class Behind:
        name = "raw_ticks"
        lastProgress = type("P", (), {"json": json.dumps({"sources": [
            {"endOffset": {"ticks": {"0": 10, "1": 4}}, "latestOffset": {"ticks": {"0": 25, "1": 4, "2": 7}}},
            {"endOffset": {"logOffset": 3}, "latestOffset": None}]})})

    got = {(r.topic, r.partition): r.lag for r in jobs.partition_lag(spark, Behind()).collect()}
    assert got == {("ticks", 0): 15, ("ticks", 1): 0, ("ticks", 2): 7}


def test_stream_queries_over_an_empty_table(spark, tmpdir_fresh):
    """Every stream and sink query ends with no rows and its own columns."""
    from tickworks.plans import catalog, stream_queries
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(0).write.parquet(f"{tmpdir_fresh}/events.parquet")
    full = catalog.queries()
    names = [n for n in full if n.endswith(("_stream", "_stream_final", "_state", "_halo", "_replay", "_sink", "_late", "_stored"))]
    assert len(names) >= 17 and stream_queries.LATE_PARTS
    for name in names:
        out = full[name](spark, tmpdir_fresh)
        assert out.count() == 0 and out.columns, name
