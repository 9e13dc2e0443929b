"""The pipeline's stages on sf0.001, and the SQL of the queries that have one."""
import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tickworks.llm import line_templates, mixing, ngram_join, quality_cnn, queries
from tickworks.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as key", "'x' as _keep")
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "bpe" and len(corpus_pipeline.STAGES) == 5
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] >= counts[3] < counts[4]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == counts[4]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, SF)
        assert empty_out.count() == 0


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def sql_rows(docs, sql):
    """Rows of DuckDB SQL over ``docs`` as the table documents, as dicts."""
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return [dict(zip(names, r)) for r in out.fetchall()]


def test_rows_of_each_stage(spark):
    """Every stage's rows worked out apart from it, from the rows it was given; the rows of run() at last.

    Line dedup and the join go by DuckDB SQL, the encoding by the tokenizers library; quality and mixing,
    which are fitted and drawn, by the report of their operator.
    """
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = docs.columns
    place = {c: i for i, c in enumerate(names)}

    good = stored(stages["quality_classifier"](spark, docs, SF), "good")
    keep = {r.doc_id for r in quality_cnn.scores(docs, labels).collect() if r.score >= quality_cnn.THRESHOLD}
    assert rows_of(good) == Counter({r: n for r, n in rows_of(docs).items() if r[place["doc_id"]] in keep})

    lined = stored(stages["line_dedup"](spark, good, SF), "lined")
    text = {r["doc_id"]: r["text"] for r in sql_rows(good, line_templates.ORACLE_SQL)}
    want = Counter()
    for r, n in rows_of(good).items():
        r = dict(zip(names, r))
        r["text"] = text[r["doc_id"]]
        r["n_chars"] = None if r["text"] is None else len(r["text"])
        want[tuple(r[c] for c in names)] += n
    assert rows_of(lined) == want != rows_of(good)

    apart = stored(stages["ngram_jaccard_join"](spark, lined, SF), "apart")
    keep = {r["doc_id"] for r in sql_rows(lined, ngram_join.ORACLE_SQL) if r["doc_id"] == r["component_id"]}
    assert rows_of(apart) == Counter({r: n for r, n in rows_of(lined).items() if r[place["doc_id"]] in keep})

    mixed = stored(stages["mixing"](spark, apart, SF), "mixed")
    copies = {r.doc_id: r.copies for r in mixing.mix(apart).collect()}
    assert rows_of(mixed) == Counter({r: n * copies[r[place["doc_id"]]] for r, n in rows_of(apart).items() if copies[r[place["doc_id"]]]})

    tok = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    tok.no_truncation(), tok.no_padding()
    want = Counter()
    for r in mixed.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(corpus_pipeline.run(spark, SF).select(*columns)) == want


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.fetchall(), key=str)
