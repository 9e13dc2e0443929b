"""Randomised: chunked operators equal their plain forms for any chunk size and sparsity."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickworks.operators.history import last_n_ticks
from tickworks.operators.rolling import rolling_mean
from tests.conftest import tick_rows
from tests.plain import rolling_mean_plain
from tests.test_rolling import deque_model

ticks_strategy = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.integers(1, 9),
              st.decimals(min_value=1, max_value=500, places=2)),
    min_size=1, max_size=60)


def _rows(draw_rows):
    rows, off = [], 0
    for sym, gap, price in draw_rows:
        off += gap
        rows.append((sym, "2024-01-01 00:00:00", float(price), 1, off))
    return rows


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ticks_strategy, st.integers(1, 40), st.integers(1, 12))
def test_rolling_chunked_equals_plain(spark, raw, chunk, n):
    rows = _rows(raw)
    t = tick_rows(spark, rows)
    got = {r.offset: r.sma for r in rolling_mean(t, n=n, min_ticks=min(2, n),
                                                 chunk_size=chunk).collect()}
    plain = {r.offset: r.sma for r in rolling_mean_plain(t, n=n, min_ticks=min(2, n)).collect()}
    assert got == plain
    if n == 10:
        want = deque_model(rows)
        assert {k: v[0] is None for k, v in want.items()} == {k: v is None for k, v in got.items()}


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ticks_strategy, st.integers(1, 40), st.integers(1, 15))
def test_last_n_chunked_equals_model(spark, raw, chunk, n):
    rows = _rows(raw)
    got = sorted((r.symbol, r.rank, r.offset) for r in
                 last_n_ticks(tick_rows(spark, rows), n, chunk_size=chunk).collect())
    want = []
    for sym in sorted({r[0] for r in rows}):
        offs = sorted((r[4] for r in rows if r[0] == sym), reverse=True)[:n]
        want += [(sym, i + 1, o) for i, o in enumerate(offs)]
    assert got == sorted(want)


multi_partition = st.lists(
    st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 2), st.integers(1, 5),
              st.decimals(min_value=1, max_value=500, places=2)),
    min_size=1, max_size=50)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(multi_partition, st.integers(1, 20))
def test_rolling_chunked_across_partitions(spark, raw, chunk):
    """A symbol spread over several topic partitions: order is (partition, offset)."""
    rows, offs = [], {}
    for sym, part, gap, price in raw:
        offs[part] = offs.get(part, 0) + gap
        rows.append((sym, "2024-01-01 00:00:00", float(price), 1, offs[part], part))
    t = tick_rows(spark, rows)
    got = {(r.partition, r.offset, r.symbol): r.sma
           for r in rolling_mean(t, chunk_size=chunk).collect()}
    plain = {(r.partition, r.offset, r.symbol): r.sma for r in rolling_mean_plain(t).collect()}
    assert got == plain
