"""Exact top-k search by distributed histogram selection.

Vectors become integer vectors floor(``SCALE`` * x). Queries (a stated share of
the rows) are hashed into blocks of about ``QUERY_BLOCK``, candidates are packed
into blocks of at most ``ROW_BLOCK``. Every query block has one or more slots; a
candidate block goes to one slot of each query block, a slot is one partition,
and a block pair's scores are one matrix product. A slot holds one query block
and one candidate block at a time. Nothing grows on the driver, and no score is
stored:

1. a pass scores everything and counts, for each query, scores by bin of the
   query's current range; a task sends only its bins from the top down to its own
   k-th score, at most k rows a query;
2. the summed histogram locates the bin that holds the k-th score over all; that
   bin becomes the next range, until it is one score wide;
3. a last pass keeps scores above the k-th and, of those equal to it, the
   smallest ids that are still needed; ties end in (score, id) order.

Products are exact: in double precision while the largest possible sum stays
under 2^53, else in Python integers. A score is a long: sums beyond +-(2^63 - 2^12)
are returned as that bound, and tie there.

Nulls: vectors that are null, or hold a null or non-finite component, take no
part, nor do those with a component that is not finite once scaled, or rows without
an id. Vectors of another length than a query's are no
candidates for it. Repeated ids: a query's own id is no candidate in any row;
rows with one id are separate candidates, while a query id asks once, with its
smallest vector. Other columns are ignored. Fewer than k candidates:
all are returned. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, stored

SCALE, K, EVERY = 256, 5, 50
QUERY_BLOCK, ROW_BLOCK = 512, 1_024
BINS = 1_024
MOST = (1 << 63) - (1 << 12)
SLOT = "slot int, kind int, ids binary, vecs binary, dim int, lo binary, hi binary, width binary, need binary"
RANGE = ("lo", "hi", "width", "need")  # scores in [lo, hi) are still in question, need of them are wanted


def valid(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the vectors that take part."""
    finite = F.coalesce(F.forall(F.col("vec"), lambda x: F.coalesce(F.abs(x * float(SCALE)) < float("inf"), F.lit(False))), F.lit(False))
    return (embeddings.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & finite))


def whole(vecs: pd.Series, dim: int) -> np.ndarray:
    return np.floor(SCALE * np.array([np.asarray(v, np.float64) for v in vecs]).reshape(len(vecs), dim))


def norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1))


def inner(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products (queries, candidates)."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    if norms(q).max() * norms(c).max() * 1.001 < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    big = [[int(x) for x in row] for row in c]
    return np.array([[max(-MOST, min(MOST, sum(int(a) * b for a, b in zip(row, col)))) for col in big] for row in q],
                    np.int64).reshape(len(q), len(c))


def packed_rows(rows: DataFrame, slots: int, n_blocks: int) -> DataFrame:
    """Candidate blocks, one row for each query block's slot they go to."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        turn = TaskContext.get().partitionId()
        for pdf in frames:
            for dim, part in pdf.groupby(pdf["vec"].str.len()):
                for i in range(0, len(part), ROW_BLOCK):
                    cut = part.iloc[i:i + ROW_BLOCK]
                    ids, vecs = cut["id"].to_numpy(np.int64).tobytes(), whole(cut["vec"], int(dim)).tobytes()
                    turn += 1
                    yield pd.DataFrame([(b * slots + turn % slots, 1, ids, vecs, int(dim), b"", b"", b"", b"")
                                        for b in range(n_blocks)], columns=[x.split()[0] for x in SLOT.split(", ")])

    return rows.mapInPandas(run, SLOT)


def packed_queries(state: DataFrame, slots: int) -> DataFrame:
    """Query blocks with their ranges, one row a slot. A block has about QUERY_BLOCK rows."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, dim = key
        pdf = pdf.sort_values("id")
        row = (pdf["id"].to_numpy(np.int64).tobytes(), whole(pdf["vec"], int(dim)).tobytes(), int(dim),
               *[pdf[c].to_numpy(np.int64).tobytes() for c in RANGE])
        return pd.DataFrame([(int(block) * slots + s, 0, *row) for s in range(slots)], columns=[x.split()[0] for x in SLOT.split(", ")])

    return state.groupBy("block", F.size("vec").alias("dim")).applyInPandas(run, SLOT)


def dealt(rows: DataFrame, state: DataFrame, slots: int, n_blocks: int) -> DataFrame:
    both = packed_rows(rows, slots, n_blocks).unionByName(packed_queries(state, slots))
    return both.repartitionById(slots * n_blocks, F.col("slot")).sortWithinPartitions("slot", "kind", "dim")


class Queries:
    """One slot's query blocks, by vector length."""

    def __init__(self) -> None:
        self.by_dim: dict[int, dict] = {}

    def add(self, r) -> None:
        ids = np.frombuffer(r.ids, np.int64)
        self.by_dim[r.dim] = {"ids": ids, "vecs": np.frombuffer(r.vecs).reshape(len(ids), r.dim),
                              **{c: np.frombuffer(getattr(r, c), np.int64) for c in RANGE}}


def histogram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each slot's scores by bin of the query's range, from the top to the slot's own k-th."""
    now, q, counts = None, Queries(), {}

    def flush() -> Iterator[pd.DataFrame]:
        for dim, own in counts.items():
            query = q.by_dim[dim]
            from_top = own[:, ::-1].cumsum(axis=1)[:, ::-1] - own  # in higher bins
            i, b = np.nonzero((own > 0) & (from_top < query["need"][:, None]))
            if len(i):
                yield pd.DataFrame({"id": query["ids"][i], "bin": b, "n": own[i, b]})

    for pdf in frames:
        for r in pdf.itertuples():
            if r.slot != now:
                yield from flush()
                now, q, counts = r.slot, Queries(), {}
            if r.kind == 0:
                q.add(r)
            elif r.dim in q.by_dim:
                query, ids = q.by_dim[r.dim], np.frombuffer(r.ids, np.int64)
                scores = inner(query["vecs"], np.frombuffer(r.vecs).reshape(len(ids), r.dim))
                # differences are taken without a sign: a range may be as wide as all longs
                bins = (scores.view(np.uint64) - query["lo"].view(np.uint64)[:, None]) // query["width"].view(np.uint64)[:, None]
                ok = (scores >= query["lo"][:, None]) & (scores < query["hi"][:, None]) & (ids[None] != query["ids"][:, None])
                flat = (np.arange(len(scores))[:, None] * BINS + bins.astype(np.int64))[ok]
                got = np.bincount(flat, minlength=len(scores) * BINS).reshape(-1, BINS)
                counts[r.dim] = counts.get(r.dim, 0) + got
    yield from flush()


def winners(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Scores above the k-th, and of those equal to it the slot's smallest ids that are needed."""
    now, q, kept = None, Queries(), []

    def flush() -> Iterator[pd.DataFrame]:
        if kept:
            yield smallest(pd.concat(kept))[["query_id", "vec_id", "score"]]

    def smallest(pdf: pd.DataFrame) -> pd.DataFrame:
        tie = pdf["tie"] > 0
        ties = pdf[tie].sort_values(["query_id", "vec_id"])
        return pd.concat([pdf[~tie], ties[ties.groupby("query_id").cumcount() < ties["tie"]]])

    for pdf in frames:
        for r in pdf.itertuples():
            if r.slot != now:
                yield from flush()
                now, q, kept = r.slot, Queries(), []
            if r.kind == 0:
                q.add(r)
            elif r.dim in q.by_dim:
                query, ids = q.by_dim[r.dim], np.frombuffer(r.ids, np.int64)
                scores = inner(query["vecs"], np.frombuffer(r.vecs).reshape(len(ids), r.dim))
                least = query["lo"][:, None] + (query["need"][:, None] == 0)
                i, c = np.nonzero((scores >= least) & (ids[None] != query["ids"][:, None]))
                if len(i):
                    score = scores[i, c]
                    kept = [smallest(pd.concat([*kept, pd.DataFrame({
                        "query_id": query["ids"][i], "vec_id": ids[c], "score": score,
                        "tie": np.where(score == query["lo"][i], query["need"][i], 0)})]))]
    yield from flush()


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each row whose id is divisible by ``every``."""
    rows = valid(embeddings, id_col, vec_col)
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"))
    length = F.sqrt(F.aggregate(F.col("vec"), F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * float(SCALE)).cast("double"), 2)))
    facts = rows.agg(F.count("*").alias("n"), F.max(length).alias("length")).first()
    n_queries = asked.count()
    if not n_queries:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    n_blocks = -(-n_queries // QUERY_BLOCK)
    slots = max(1, -(-partitions(embeddings) // n_blocks))
    # Cauchy-Schwarz bounds every score of a query
    bound = F.ceil(F.least(length * facts.length * 1.001 + 1, F.lit(float(MOST))))
    state = stored(asked.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"), (-bound).alias("lo"), (bound + 1).alias("hi"),
                                (F.floor(bound / (BINS // 2)) + 1).alias("width"),
                                F.lit(k).cast("bigint").alias("need")), "topk-state")
    last = False
    while not last:
        last = state.agg(F.max("width")).first()[0] == 1
        bins = dealt(rows, state, slots, n_blocks).mapInPandas(histogram, "id bigint, bin int, n bigint")
        down = Window.partitionBy("id").orderBy(F.col("bin").desc())
        at = (bins.groupBy("id", "bin").agg(F.sum("n").alias("n"))
              .withColumn("above", F.sum("n").over(down) - F.col("n"))
              .join(state.select("id", "need"), "id")
              .where((F.col("above") < F.col("need")) & (F.col("above") + F.col("n") >= F.col("need")))
              .select("id", "bin", "above"))
        # without such a bin a query has fewer candidates than k: all above its range's start are kept, and its range is empty
        found = F.col("bin").isNotNull()
        wide = {c: F.col(c).cast("decimal(38,0)") for c in ("lo", "hi", "bin", "width")}  # products may pass a long
        start = wide["lo"] + wide["bin"] * wide["width"]
        lo = F.when(found, start.cast("bigint")).otherwise(F.greatest(F.col("lo") - 1, F.lit(-MOST - 1)))
        state = stored(state.join(at, "id", "left").select(
            "id", "vec", "block", lo.alias("lo"), F.when(found, F.least(start + wide["width"], wide["hi"]).cast("bigint")).otherwise(lo).alias("hi"),
            F.when(found, F.ceil(F.col("width") / BINS)).otherwise(1).cast("bigint").alias("width"),
            F.when(found, F.col("need") - F.col("above")).otherwise(0).cast("bigint").alias("need")), "topk-state")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (dealt(rows, state, slots, n_blocks).mapInPandas(winners, "query_id bigint, vec_id bigint, score bigint")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: The same rows in SQL, for ids that do not repeat.
ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE}.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
