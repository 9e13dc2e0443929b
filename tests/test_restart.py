"""Stop a stream, add data, restart from the same checkpoint: results equal the batch form."""
import random
import time

from tickworks.operators.ingest import parse_ticks
from tickworks.operators.rolling import rolling_alerts
from tickworks.operators.windows import window_aggregates
from tickworks.sources.fixtures import kafka_records_from_ticks
from tickworks.sources.streams import replay_stream, write_replay_files
from tickworks.streaming import jobs
from tickworks.streaming.sinks import read_appended, read_window_table
from tests.conftest import tick_rows


def _rows(n=80, seed=5):
    rnd = random.Random(seed)
    return [(rnd.choice("ABC"), f"2024-01-01 00:{i // 2:02d}:{(i * 7) % 60:02d}",
             round(rnd.uniform(10, 20), 2), 1, i) for i in range(n)]


def test_restart_from_checkpoint(spark, tmpdir_fresh):
    rows = _rows()
    recs = kafka_records_from_ticks(tick_rows(spark, rows))
    d = f"{tmpdir_fresh}/in"
    glob, _ = write_replay_files(recs.where("offset < 40"), d, 2)
    root = f"{tmpdir_fresh}/out"

    def run_all():
        ticks = parse_ticks(replay_stream(spark, glob))
        qs = [jobs.start_rolling_state(ticks, f"{root}/state_out", f"{root}/c1"),
              jobs.start_rolling_halo(ticks, f"{root}/halo_out", f"{root}/tails", f"{root}/c2",
                                      chunk_size=4),
              jobs.start_window_upsert(ticks, f"{root}/win", f"{root}/c3",
                                       trigger=jobs.AVAILABLE_NOW),
              jobs.start_tick_state(ticks, f"{root}/changes", f"{root}/c4", history_len=5)]
        for q in qs:
            q.awaitTermination()
            assert q.exception() is None

    run_all()
    time.sleep(1.05)
    write_replay_files(recs.where("offset >= 40"), d, 2, first_index=2)
    run_all()                                     # restart: same checkpoints, new files

    batch = {r.offset: (r.sma4, r.alert_type) for r in
             rolling_alerts(tick_rows(spark, rows), exact4=True).collect()}
    state = {r.offset: (r.sma4, r.alert_type) for r in spark.read.parquet(f"{root}/state_out").collect()}
    halo = {r.offset: (r.sma4, r.alert_type) for r in read_appended(spark, f"{root}/halo_out").collect()}
    assert state == batch
    assert halo == batch
    win = sorted((str(r.window_start), r.symbol, float(r.avg_price), r.tick_count)
                 for r in read_window_table(spark, f"{root}/win").collect())
    want = sorted((str(r.window_start), r.symbol, r.avg_price, r.tick_count)
                  for r in window_aggregates(tick_rows(spark, rows)).collect())
    assert win == want
    # keyed state after the restart: latest tick, bounded history, session stats
    from tickworks.operators.history import last_n_ticks
    from tickworks.operators.latest import latest_price
    from tickworks.operators.rolling import session_stats
    latest, hist = jobs.read_tick_state(spark, f"{root}/c4")
    t = tick_rows(spark, rows)
    assert sorted(map(tuple, latest.select("symbol", "price").collect())) == \
        sorted(map(tuple, latest_price(t).collect()))
    assert sorted((r.symbol, r.rank, r.offset) for r in hist.collect()) == \
        sorted((r.symbol, r.rank, r.offset) for r in last_n_ticks(t, 5).collect())
    stats = sorted(map(tuple, jobs.read_rolling_state(spark, f"{root}/c1").select(
        "symbol", "ticks", "min_price", "max_price", "alerts").collect()))
    assert stats == sorted(map(tuple, session_stats(rolling_alerts(t)).collect()))


def test_sma_carry_stateful_stream(spark, tmpdir_fresh):
    """FIXTURES sma_carry through the keyed state processor: 5 micro-batches."""
    import pytest
    batches = [[1, 3], [5], [7, 9], [11], [99, 1]]
    rows, off = [], 0
    for b in batches:
        for p in b:
            rows.append(("A", "2024-01-01 00:00:00", float(p), 1, off))
            off += 1
    recs = kafka_records_from_ticks(tick_rows(spark, rows))
    d = f"{tmpdir_fresh}/in"
    start = 0
    for i, b in enumerate(batches):
        write_replay_files(recs.where(f"offset >= {start} and offset < {start + len(b)}"),
                           d, 1, first_index=i)
        start += len(b)
        time.sleep(1.05)
    ticks = parse_ticks(replay_stream(spark, f"{d}/part*.parquet"))
    q = jobs.start_rolling_state(ticks, f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ckpt")
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 5
    out = [r.sma for r in spark.read.parquet(f"{tmpdir_fresh}/out").orderBy("offset").collect()]
    assert out[0] is None
    assert out[1:] == pytest.approx([2, 3, 4, 5, 6, 135 / 7, 17])


def test_hot_symbol_runs_in_several_tasks(spark, tmpdir_fresh):
    """A symbol with half of every micro-batch: many groups and tasks, and the batch result."""
    rnd = random.Random(11)
    rows = [("HOT" if i % 2 else rnd.choice("ABCDEFGH"), "2024-01-01 00:00:00", round(rnd.uniform(10, 20), 2), 1, i)
            for i in range(1200)]
    rows += [("HOT", "2024-01-01 00:00:00", None, 1, 1200), ("LATE", "2024-01-01 00:00:00", 3.0, 1, 1201)]
    recs = kafka_records_from_ticks(tick_rows(spark, rows))
    glob, files = write_replay_files(recs, f"{tmpdir_fresh}/in", 3, files_per_part=2)
    ticks = parse_ticks(replay_stream(spark, glob, max_files_per_trigger=files))
    q = jobs.start_rolling_state(ticks, f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/c", segment=50)
    q.awaitTermination()
    assert q.exception() is None
    batch = {r.offset: (r.symbol, r.sma, r.sma4, r.deviation, r.alert_type) for r in
             rolling_alerts(tick_rows(spark, rows), exact4=True).collect()}
    out = spark.read.parquet(f"{tmpdir_fresh}/out")
    got = {r.offset: (r.symbol, r.sma, r.sma4, r.deviation, r.alert_type) for r in out.collect()}
    assert out.count() == len(got) and got == batch
    # a micro-batch of 400 ticks has 200 of HOT in 8 segments; their finished rows were written by several tasks
    from pyspark.sql import functions as F
    tasks = out.where("symbol = 'HOT'").select(F.input_file_name().alias("file")).distinct().count()
    assert tasks >= 3 * 3
    from tickworks.operators.rolling import session_stats
    stats = sorted(map(tuple, jobs.read_rolling_state(spark, f"{tmpdir_fresh}/c").select(
        "symbol", "ticks", "min_price", "max_price", "alerts").collect()))
    assert stats == sorted(map(tuple, session_stats(rolling_alerts(tick_rows(spark, rows))).collect()))


def test_segments_of_any_size_equal_the_batch(spark):
    """The functions of a segment and of the boundaries, on random cuts, against the frame of all ticks."""
    import numpy as np
    import pandas as pd
    from tickworks.streaming.stateful import BOUNDARY, RollingMeanProcessor, rolling_frame, segment_means

    class Held:
        def __init__(self): self.x = None
        def exists(self): return self.x is not None
        def get(self): return self.x
        put = update = lambda self, x: setattr(self, "x", x)

    rnd = random.Random(4)
    for size in (1, 2, 9, 10, 11, 18, 19, 30):
        prices = [round(rnd.uniform(1, 9), 2) for _ in range(97)]
        p = RollingMeanProcessor()
        p.prices, p.stats = Held(), Held()
        got = {}
        for batch in (range(0, 40), range(40, 41), range(41, 97)):       # three micro-batches
            cut = [pd.DataFrame({"symbol": "A", "partition": 0, "offset": [i], "timestamp": pd.Timestamp(0), "price": [prices[i]]}) for i in batch]
            df = pd.concat(cut).sample(frac=1, random_state=1)
            rows = pd.concat([segment_means()(("A", 0, k), g) for k, g in df.groupby(df["offset"] // size)])
            for lane, g in rows.groupby("lane"):
                for out in p.handleInputRows(("A", lane), iter([g.iloc[::2], g.iloc[1::2]]), None):
                    got |= {int(r.offset): r.sma for r in out.itertuples()}
            assert sum(rows["lane"] == BOUNDARY) <= 19 * rows.groupby("lane").ngroups * len(batch) // size + 19
        want = rolling_frame(np.zeros(0), np.array(prices), 0, 10, 2, 0.005)["sma"]
        assert sorted(got) == list(range(97))
        assert all(got[i] == want[i] or np.isnan(got[i]) and np.isnan(want[i]) for i in got)
        assert p.stats.get()[:3] == (97, min(prices), max(prices))
