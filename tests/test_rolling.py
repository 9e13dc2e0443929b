import random
from collections import deque

import numpy as np
import pytest

from tickworks.operators.rolling import (HEAVY, Pieces, halo_rows, price_alerts, rolling_alerts,
                                         rolling_mean, session_stats)
from tickworks.streaming.stateful import rolling_frame
from tests.conftest import tick_rows
from tests.plain import rolling_mean_plain


def deque_model(rows, n=10, thr=0.005):
    """Plain-Python model of the per-record consumer: deque of the last n prices."""
    win, out = {}, {}
    for sym, _, price, _, off in sorted(rows, key=lambda r: r[4]):
        d = win.setdefault(sym, deque(maxlen=n))
        d.append(price)
        sma = sum(d) / len(d) if len(d) >= 2 else None
        alert = None
        if sma is not None and sma != 0:
            dev = abs(price - sma) / sma
            if dev > thr:
                alert = "PRICE_SURGE" if price > sma else "PRICE_DROP"
        out[off] = (sma, alert)
    return out


def make_rows(counts, spread=1, seed=0):
    rnd = random.Random(seed)
    rows, off = [], 0
    pending = [(s, c) for s, c in counts.items()]
    seq = [s for s, c in pending for _ in range(c)]
    rnd.shuffle(seq)
    for s in seq:
        off += rnd.randint(1, spread)
        rows.append((s, "2024-01-01 00:00:00", round(rnd.uniform(1, 100), 2), 1, off))
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, 1 << 20])
def test_sma_edges_all_chunk_sizes(spark, chunk):
    rows = make_rows({"A": 1, "B": 2, "C": 9, "D": 10, "E": 11, "F": 12}, spread=5)
    want = deque_model(rows)
    got = {r.offset: (r.sma, r.alert_type)
           for r in rolling_alerts(tick_rows(spark, rows), chunk_size=chunk).collect()}
    assert set(got) == set(want)
    for off, (sma, alert) in want.items():
        gs, ga = got[off]
        assert (gs is None) == (sma is None)
        if sma is not None:
            assert gs == pytest.approx(sma, rel=1e-12)
        assert ga == alert


def test_first_null_and_eleventh_excludes_first(spark):
    rows = [("A", "2024-01-01 00:00:00", float(p), 1, i) for i, p in enumerate(
        [100, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1])]
    out = {r.offset: r.sma for r in rolling_mean(tick_rows(spark, rows), chunk_size=4).collect()}
    assert out[0] is None
    assert out[9] == pytest.approx(109 / 10)
    assert out[10] == 1.0


def test_random_sparse_symbols_vs_model(spark):
    counts = {f"s{i}": random.Random(i).randint(1, 40) for i in range(40)}
    rows = make_rows(counts, spread=7, seed=3)
    want = deque_model(rows)
    t = tick_rows(spark, rows)
    for chunk in (3, 16):
        got = {r.offset: r.sma for r in rolling_mean(t, chunk_size=chunk).collect()}
        for off, (sma, _) in want.items():
            assert (got[off] is None) == (sma is None)
            if sma is not None:
                assert got[off] == pytest.approx(sma, rel=1e-12)
    plain = {r.offset: r.sma for r in rolling_mean_plain(t).collect()}
    halo = {r.offset: r.sma for r in rolling_mean(t, chunk_size=5).collect()}
    assert plain == halo          # identical bits: same frame summation order


def test_multiple_partitions_order(spark):
    # one symbol spread over two topic partitions: order is (partition, offset)
    rows = [("A", "2024-01-01 00:00:00", 1.0, 1, 5, 0), ("A", "2024-01-01 00:00:00", 3.0, 1, 1, 1),
            ("A", "2024-01-01 00:00:00", 5.0, 1, 2, 1)]
    out = {(r.partition, r.offset): r.sma for r in rolling_mean(tick_rows(spark, rows),
                                                                   chunk_size=2).collect()}
    assert out == {(0, 5): None, (1, 1): 2.0, (1, 2): 3.0}


def test_sma_carry_prior(spark):
    """sma_carry across 5 batches via the ``prior`` rows (the halo stream form)."""
    batches = [[1, 3], [5], [7, 9], [11], [99, 1]]
    seen, off, got = [], 0, []
    for b in batches:
        rows = []
        for p in b:
            rows.append(("A", "2024-01-01 00:00:00", float(p), 1, off))
            off += 1
        prior = tick_rows(spark, seen[-9:]) if seen else None
        res = rolling_mean(tick_rows(spark, rows), chunk_size=2, prior=prior).orderBy("offset")
        got += [r.sma for r in res.collect()]
        seen += rows
    assert got[:7] == [None, 2, 3, 4, 5, 6, pytest.approx(135 / 7)]
    assert got[7] == pytest.approx(17.0)


def test_rolling_frame_carry():
    prev, seen, out = np.zeros(0), 0, []
    for b in [[1, 3], [5], [7, 9], [11], [99, 1]]:
        p = np.array(b, dtype=float)
        r = rolling_frame(prev, p, seen, 10, 2, 0.005)
        out += list(r["sma"])
        prev = np.concatenate([prev, p])[-9:]
        seen += len(p)
    assert np.isnan(out[0])
    assert out[1:] == pytest.approx([2, 3, 4, 5, 6, 135 / 7, 17])


def test_deviation_edges(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 100.4999), (2, 100.0, 100.5001), (3, 100.0, 100.5), (4, 0.0, 1.0),
         (5, 100.0, 99.4)], "id int, sma double, price double")
    out = {r.id: (r.deviation, r.alert_type) for r in price_alerts(df).collect()}
    assert out[1][1] is None
    assert out[2][1] == "PRICE_SURGE"
    assert out[3][1] is None           # exactly 0.005 is not greater
    assert out[4] == (None, None)      # zero mean: null deviation, no error
    assert out[5][1] == "PRICE_DROP"


def test_session_stats(spark):
    rows = make_rows({"A": 15, "B": 3}, seed=9)
    out = {r.symbol: r for r in session_stats(rolling_alerts(tick_rows(spark, rows))).collect()}
    want = deque_model(rows)
    a_alerts = sum(1 for r in rows if r[0] == "A" and want[r[4]][1] is not None)
    assert out["A"].ticks == 15 and out["A"].alerts == a_alerts
    assert out["B"].min_price == min(r[2] for r in rows if r[0] == "B")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_halo_plan_shuffles_full_data_once(spark):
    rows = make_rows({"A": 50, "B": 50}, seed=1)
    assert "WindowGroupLimit" in plan_of(rolling_mean(tick_rows(spark, rows), chunk_size=8))   # tails cut before their shuffle


def test_plan_without_busy_symbols(spark):
    """One scan, one exchange, no join and no halo; with busy symbols the halo takes a second scan."""
    from tickworks.plans import catalog
    plan = plan_of(catalog.queries()["rolling_mean_alerts"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    assert "Join" not in plan and "Union" not in plan
    plan = plan_of(catalog.queries()["rolling_mean_alerts_chunked"](spark, "/root/testdata/sf0.001"))
    assert plan.count("events.parquet") == 2


def halo_share(ticks, chunk_size, n=10):
    pieces = Pieces(ticks, chunk_size)
    return halo_rows(ticks, n - 1, pieces).count() / ticks.count(), pieces


def test_halo_stays_small(spark):
    from tickworks.plans import catalog
    for sf in ("sf0.01", "sf0.1"):
        share, _ = halo_share(catalog.event_ticks(spark, f"/root/testdata/{sf}", "user_id"), catalog.USER_CHUNK)
        assert share <= 0.1
    # 50,000 sparse symbols far apart, alone and beside one that holds a third of all ticks
    sparse = spark.range(200_000).selectExpr(
        "concat('s', id % 50000) AS symbol", "0 AS partition", "id * 100000 AS offset", "CAST(id % 97 AS double) AS price")
    share, pieces = halo_share(sparse, 128)
    assert share == 0 and not pieces.levels
    hot = spark.range(100_000).selectExpr("'hot' AS symbol", "0 AS partition", "id * 3 + 1 AS offset", "CAST(id % 89 AS double) AS price")
    both = sparse.unionByName(hot)
    share, pieces = halo_share(both, 1_000)
    assert 0 < share <= 0.01
    sizes = [r["count"] for r in pieces.of(both).where("_piece is not null").groupBy("_piece").count().collect()]
    assert len(sizes) >= 90 and max(sizes) <= HEAVY * 1_000
    assert both.count() == rolling_mean(both, chunk_size=1_000).count()


def test_burst_is_cut_again(spark):
    """A symbol that is sparse but for one dense range: no piece keeps more than a few chunks."""
    sparse = [("A", "2024-01-01 00:00:00", float(k % 7), 1, k * 1_000_000) for k in range(200)]
    burst = [("A", "2024-01-01 00:00:00", float(k % 5), 1, 50_000_001 + k) for k in range(600)]
    t = tick_rows(spark, sparse + burst)
    pieces = Pieces(t, 20)
    assert len(pieces.levels) > 1
    sizes = [r["count"] for r in pieces.of(t).groupBy("_piece").count().collect()]
    assert max(sizes) <= HEAVY * 20
    got = {r.offset: r.sma for r in rolling_mean(t, chunk_size=20).collect()}
    assert got == {r.offset: r.sma for r in rolling_mean_plain(t).collect()}


def test_same_offset_delivered_many_times(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 5)] * 50 + [("A", "2024-01-01 00:00:00", 1.0, 1, 6)])
    assert [r.sma for r in rolling_mean(t, chunk_size=4).where("sma is not null").collect()] == [1.0] * 50


def test_null_symbol_and_partition_are_a_symbol(spark):
    t = spark.range(60).selectExpr("CAST(NULL AS string) AS symbol", "CAST(NULL AS int) AS partition", "id AS offset", "CAST(id AS double) AS price")
    got = {r.offset: r.sma for r in rolling_mean(t, chunk_size=8).collect()}
    assert got == {k: None if k == 0 else sum(range(max(0, k - 9), k + 1)) / min(10, k + 1) for k in range(60)}
