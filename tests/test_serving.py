import random

from tickworks.functions import format as fmt
from tickworks.operators.alerts import latest_alerts, volume_alerts
from tickworks.operators.serving import (live_detail, price_overlay, session_summary,
                                         symbol_cards, symbol_dim)
from tests.conftest import tick_rows


def test_overlay_and_cards(spark):
    stored = spark.createDataFrame([("AAPL", 1.0), ("MSFT", 2.0), ("ZZZ", 9.0)],
                                   "symbol string, price double")
    live = spark.createDataFrame([("MSFT", 2.5), ("TSLA", 3.5)], "symbol string, price double")
    ov = {r.symbol: (r.price, r.is_live) for r in price_overlay(stored, live).collect()}
    assert ov == {"AAPL": (1.0, False), "MSFT": (2.5, True), "TSLA": (3.5, True),
                  "ZZZ": (9.0, False)}
    cards = symbol_cards(symbol_dim(spark), price_overlay(stored, live)).orderBy("ord").collect()
    assert [(c.symbol, c.price_text, c.is_live) for c in cards] == [
        ("AAPL", "$1.0000", False), ("GOOGL", "—", False), ("MSFT", "$2.5000", True),
        ("TSLA", "$3.5000", True), ("AMZN", "—", False), ("NVDA", "—", False)]


def test_live_detail_skips_missing(spark):
    live = tick_rows(spark, [("NVDA", "2024-01-01 10:11:12.5", 950.5, 1234567, 1),
                             ("ZZZ", "2024-01-01 10:11:12", 1.0, 1, 2)])
    out = live_detail(symbol_dim(spark), live).collect()
    assert [(r.symbol, r.price_text, r.volume_text, r.time_text) for r in out] == [
        ("NVDA", "$950.5000", "1,234,567", "2024-01-01 10:11:12")]


def test_volume_edges_and_top(spark):
    t = tick_rows(spark, [("A", "2024-01-01 00:00:01", 1.0, 999_999, 1),
                          ("A", "2024-01-01 00:00:02", 1.0, 1_000_000, 2),
                          ("A", "2024-01-01 00:00:03", 1.0, 1_000_001, 3),
                          ("A", "2024-01-01 00:00:04", 1.0, None, 4),
                          ("A", "2024-01-01 00:00:03", 1.0, 2_000_000, 5)])
    va = volume_alerts(t)
    assert sorted(r.offset for r in va.collect()) == [3, 5]
    assert [r.offset for r in latest_alerts(va, 10).collect()] == [5, 3]


def test_texts(spark):
    df = spark.createDataFrame([(None, None), (0.0, 0.0), (1234.56789, 12.5)],
                               "p double, s double")
    out = df.select(fmt.price_text("p").alias("p"), fmt.sma_text("s").alias("s"),
                    fmt.or_na("p").alias("n")).collect()
    assert [tuple(r) for r in out] == [("—", "SMA=building...", "N/A"),
                                       ("—", "SMA=building...", "$0.0000"),
                                       ("$1234.5679", "SMA=$12.5000", "$1234.5679")]
    a = spark.createDataFrame([("PRICE_SURGE", 0.01234, 1.23456), (None, 0.1, 1.0)],
                              "a string, d double, s double")
    assert [r.t for r in a.select(fmt.alert_text("a", "d", "s").alias("t")).collect()] == [
        "⬆ SURGE 1.234% from SMA $1.2346", None]


def test_fixed_matches_python(spark):
    rnd = random.Random(7)
    vals = [37.8125, 2.675, 0.03125, 1.0005, 2.00005, 0.0, 99.99995, 0.5, 1.5, 2.5]
    vals += [round(rnd.uniform(0, 1000), rnd.randint(1, 6)) for _ in range(3000)]
    vals += [rnd.randint(0, 10 ** 6) / 2 ** rnd.randint(1, 12) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for k in (1, 3, 4):
        got = [r[0] for r in df.select(fmt.fixed("x", k)).collect()]
        assert got == ["%.*f" % (k, v) for v in vals]


def test_session_summary(spark):
    stats = spark.createDataFrame([("B", 3, 1.0, 2.0, 1), ("A", 0, None, None, 0)],
                                  "symbol string, ticks bigint, min_price double, "
                                  "max_price double, alerts bigint")
    out = [tuple(r) for r in session_summary(stats).collect()]
    assert out == [("A", 0, "N/A", "N/A", 0), ("B", 3, "$1.0000", "$2.0000", 1)]
