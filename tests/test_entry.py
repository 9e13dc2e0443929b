import duckdb

import __spark_entry__ as entry_mod
from tickworks.plans import catalog

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["window_start", "window_end", "symbol", "avg_price", "min_price",
                          "max_price", "tick_count"]
    assert df.count() > 0


def test_oracle_keys_subset():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


STREAMING = ("_stream", "_halo", "_state", "_final", "archive_replay", "_sink", "_replay")


def _check(spark, streaming: bool):
    con = duckdb.connect()
    for t in ["events", "lineitem", "pages", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sqls = entry_mod.oracle_sql()
    for name, fn in catalog.queries().items():
        if any(name.endswith(x) for x in STREAMING) != streaming:
            continue
        df = fn(spark, SF)
        got = sorted(map(lambda r: tuple(sorted(r.asDict().items())), df.collect()), key=str)
        res = con.execute(sqls[name])
        cols = [d[0] for d in res.description]
        want = sorted((tuple(sorted(zip(cols, r))) for r in res.fetchall()), key=str)
        assert len(got) == len(want), name
        norm = lambda rows: [tuple((k, round(v, 9) if isinstance(v, float) else v)
                                   for k, v in r) for r in rows]
        assert norm(got) == norm(want), name


def test_batch_queries_match_duckdb_sf0001(spark):
    """Every batch query equals its DuckDB SQL on sf0.001."""
    _check(spark, streaming=False)


def test_streaming_queries_match_duckdb_sf0001(spark):
    """Every streaming / sink query (run to completion with availableNow) equals its SQL."""
    _check(spark, streaming=True)
