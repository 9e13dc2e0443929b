import time

from tickworks.operators.windows import latest_window, top_windows, window_aggregates
from tests.conftest import tick_rows


def test_window_edges(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:04:59.999999", 1.0, 1, 0),
                          ("A", "2024-01-01 00:05:00", 3.0, 1, 1)])
    out = window_aggregates(t).orderBy("window_start").collect()
    assert [(str(r.window_start), r.tick_count) for r in out] == [
        ("2024-01-01 00:00:00", 1), ("2024-01-01 00:05:00", 1)]


def test_null_price_window(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:01:00", None, 1, 0),
                          ("A", "2024-01-01 00:02:00", None, 1, 1)])
    r = window_aggregates(t).first()
    assert r.avg_price is None and r.min_price is None and r.tick_count == 0


def test_exact_vs_double_tie(spark):
    # 8 prices whose exact mean is 30084.98625 (a tie at the 4th decimal)
    prices = [30084.98] * 7 + [30085.03]
    t = tick_rows(spark, [("A", "2024-01-01 00:01:00", p, 1, i) for i, p in enumerate(prices)])
    exact = window_aggregates(t, mode="exact").first().avg_price
    assert exact == 30084.9863


def test_latest_and_top(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 1, 0),
                          ("A", "2024-01-01 00:11:00", 2.0, 1, 1),
                          ("B", "2024-01-01 00:06:00", 5.0, 1, 2)])
    w = window_aggregates(t)
    lw = {r.symbol: str(r.window_start) for r in latest_window(w).collect()}
    assert lw == {"A": "2024-01-01 00:10:00", "B": "2024-01-01 00:05:00"}
    assert [r.symbol for r in top_windows(w, 2).collect()] == ["A", "B"]


def test_late_rows_stream(spark, tmpdir_fresh):
    """Watermark 1 min, update mode, upsert: late row in an open window merged, in a
    closed window (two batches after the watermark moved) dropped."""
    from tickworks.streaming.jobs import AVAILABLE_NOW, start_window_upsert
    from tickworks.streaming.sinks import read_window_table
    batches = [[("00:01:00", 1.0), ("00:02:00", 3.0)], [("00:07:00", 5.0)],
               [("00:04:59", 7.0), ("00:05:30", 9.0)], [("00:05:10", 11.0)],
               [("00:04:58", 99.0), ("00:05:11", 1.0)]]
    off = 0
    for i, b in enumerate(batches):
        rows = []
        for ts, p in b:
            rows.append(("A", f"2024-01-01 {ts}", p, 1, off))
            off += 1
        tick_rows(spark, rows).coalesce(1).write.parquet(f"{tmpdir_fresh}/in/b{i}.parquet")
        time.sleep(1.05)
    schema = tick_rows(spark, [("A", "2024-01-01 00:00:00", 1.0, 1, 0)]).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .parquet(f"{tmpdir_fresh}/in/b*.parquet"))
    q = start_window_upsert(stream, f"{tmpdir_fresh}/table", f"{tmpdir_fresh}/ckpt",
                            trigger=AVAILABLE_NOW)
    q.awaitTermination()
    out = read_window_table(spark, f"{tmpdir_fresh}/table").orderBy("window_start").collect()
    assert [(str(r.window_start)[11:], float(r.avg_price), r.tick_count) for r in out] == [
        ("00:00:00", 3.6667, 3), ("00:05:00", 6.5, 4)]


def test_latest_window_keeps_null_values(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.0, 1, 0),
                          ("A", "2024-01-01 00:11:00", None, 1, 1)])
    r = latest_window(window_aggregates(t)).first()
    assert str(r.window_start) == "2024-01-01 00:10:00"
    assert r.avg_price is None and r.tick_count == 0


def test_bad_prices_never_stop_a_query(spark):
    """NaN, Infinity and 1e300 pass every average; the default is the plain double mean."""
    from tickworks.operators.rolling import rolling_mean
    bad = [("A", "2024-01-01 00:01:00", x, 1, i) for i, x in enumerate([1.0, float("nan"), float("inf"), 1e300, 2.0])]
    t = tick_rows(spark, bad)
    assert window_aggregates(t).count() == 1
    assert window_aggregates(t, mode="exact").first().avg_price == 1.5
    assert rolling_mean(t, exact4=True).count() == 5
    two = tick_rows(spark, [("A", "2024-01-01 00:01:00", 1.00006, 1, 0), ("A", "2024-01-01 00:02:00", 1.0, 1, 1)])
    assert window_aggregates(two).first().avg_price == 1.0


def test_exact_mean_of_negative_and_large_prices(spark):
    """Half away from zero on either side, and exact where doubles are not."""
    import numpy as np
    from tickworks.operators.rolling import rolling_mean
    from tickworks.streaming.stateful import rolling_frame
    cases = {"up": [0.0001, 0.0002], "down": [-0.0001, -0.0002], "mixed": [-0.0003, 0.0002, 0.0002],
             "large": [900_000_000_000.0001] * 2 + [900_000_000_000.0003], "none": [0.0]}
    want = {"up": 0.0002, "down": -0.0002, "mixed": 0.0, "none": 0.0}
    rows = [(s, "2024-01-01 00:01:00", p, 1, i) for s, ps in cases.items() for i, p in enumerate(ps)]
    got = {r.symbol: r.avg_price for r in window_aggregates(tick_rows(spark, rows), mode="exact").collect()}
    units = [round(p * 10000) for p in cases["large"]]
    want["large"] = ((2 * sum(units) + 3) // 6) / 10000
    assert got == want
    last = {r.symbol: r.sma4 for r in rolling_mean(tick_rows(spark, rows), exact4=True).orderBy("offset").collect()}
    for s, ps in cases.items():
        stream = rolling_frame(np.zeros(0), np.array(ps), 0, 10, 2, 0.005)["sma4"][-1]
        assert (last[s] is None and np.isnan(stream)) if len(ps) < 2 else last[s] == stream == want[s]
    huge = tick_rows(spark, [("A", "2024-01-01 00:01:00", 9e14, 1, i) for i in range(3)])
    assert window_aggregates(huge, mode="exact").first().avg_price is None     # the sum of units passes a long
