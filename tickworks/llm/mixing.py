"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; its documents share one expected
number of copies r = target / words (at most ``MAX_COPIES``). A document gets
floor(r) copies, and one more with probability p = r - floor(r). The extra
copies are rounded dependently: two fractional documents a, b trade mass so that
words(a) p(a) + words(b) p(b) stays the same, in one of the two directions in
which one of them becomes 0 or 1, drawn so that both keep their expectation.
One document stays fractional at last, so a source misses its target by less
than one document.

The work is a reduction tree: documents of a source are dealt by hash into
groups of about ``GROUP_ROWS``; each group is rounded on its own and leaves at
most one fractional residual; residuals of ``FAN_IN`` groups are rounded
together, and so on until one a source is left, which a last draw decides. Hot
sources have more groups, never larger ones. Draws are seeded by the group, and
rows are ordered by (id, size, text hash) within it, so reruns agree on any
number of partitions.

Nulls: a null or empty text has size 0 and takes 0 words (no copies); null
sources are one source, last; null ids are allowed. Equal rows are separate
documents. Other columns are ignored by ``mix``; ``mixed_documents`` carries
them through. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, empty_text, stored

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL, MAX_COPIES = 1.5, 2.0
GROUP_ROWS, FAN_IN = 16_384, 1_024
SEED = 41
TINY = 1e-12


def words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source_key, source_size, n, target, ratio): one row a source.

    ``sizes`` has source_key, has_source and size. The shares are the level at which the sources
    that are not stopped at their ceiling get weight times one common amount.
    Works on one row a source only.
    """
    per = sizes.groupBy("has_source", "source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by_name = Window.orderBy(F.col("has_source").desc(), "source_key")
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    # in the order in which rising water stops the sources
    order = Window.partitionBy(F.lit(0)).orderBy("stop", "rank").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("rank", F.row_number().over(by_name) - 1)
           .withColumn("weight", weight)
           .withColumn("ceiling", MAX_COPIES * F.col("source_size"))
           .withColumn("stop", F.col("ceiling") / F.col("weight"))
           .withColumn("left", TOTAL * F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(order), F.lit(0.0)))
           .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("left_weight")))
    # the first source that its level does not fill sets the level for itself and all after it
    level = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "rank", "level"))).over(everything)["level"]
    return (per.withColumn("water", level)
            .withColumn("target", F.least("ceiling", F.coalesce(F.col("weight") * F.col("water"), F.col("ceiling"))))
            .withColumn("ratio", F.when(F.col("source_size") > 0, F.least(F.lit(MAX_COPIES), F.col("target") / F.col("source_size"))).otherwise(0.0))
            .select("has_source", "source_key", "source_size", "n", "target", "ratio"))


def pivot(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round probabilities in order; at most one stays fractional. Sizes are positive."""
    p = p.copy()
    draws = rng.random(len(p)).tolist()
    s, q = size.tolist(), p.tolist()
    a = -1  # the fractional one so far
    for b in range(len(q)):
        if not TINY < q[b] < 1 - TINY:
            q[b] = float(round(q[b]))
            continue
        if a < 0:
            a = b
            continue
        wa, wb = s[a], s[b]
        up = min((1 - q[a]) * wa, q[b] * wb)     # words moved from b to a
        down = min(q[a] * wa, (1 - q[b]) * wb)   # words moved from a to b
        moved = up if draws[b] * (up + down) < down else -down
        q[a] += moved / wa
        q[b] -= moved / wb
        ends = [i for i in (a, b) if TINY < q[i] < 1 - TINY]
        for i in (a, b):
            if i not in ends:
                q[i] = float(round(q[i]))
        a = ends[0] if ends else -1
    return np.array(q)


def seeded(*parts: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.sha256(repr((SEED, *parts)).encode()).digest()[:16], "little"))


def round_groups(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """Round each (source, group) on its own; a residual keeps its fraction, unless ``last``."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["no_id", "doc_id", "size", "text_hash"], kind="stable")
        rng = seeded(level, bool(key[0]), str(key[1]), int(key[2]))
        p = pivot(pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(np.float64), rng)
        if last:
            p = np.where((p > 0) & (p < 1), (rng.random(len(p)) < p) * 1.0, p)
        return pdf.assign(p=p)

    return rows.groupBy("has_source", "source_key", "group").applyInPandas(run, rows.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, text_hash, source) of every document.

    ``copies`` is how often the mix repeats the document, ``taken`` = copies * size.
    """
    src = stored(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), words(text_col).alias("size"),
        F.xxhash64(empty_text(text_col)).alias("text_hash"),
        F.col(source_col).isNotNull().alias("has_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source_key")), "mix-sizes")
    goals = stored(targets(src), "mix-targets")
    n_groups = F.ceil(F.col("n") / GROUP_ROWS)
    rows = (src.join(goals, ["has_source", "source_key"])
            .withColumn("group", F.pmod(F.xxhash64("doc_id", "text_hash"), n_groups))
            .withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
            .withColumn("p", F.when(F.col("size") > 0, F.col("ratio") - F.floor("ratio")).otherwise(0.0))
            .withColumn("whole", F.when(F.col("size") > 0, F.floor("ratio")).otherwise(0).cast("bigint"))
            .drop("n", "ratio"))
    most = (goals.agg(F.max(n_groups)).first()[0]) or 0
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    level, done = 0, []
    while True:
        last = most <= 1
        rows = stored(round_groups(rows, level, last), f"mix-level{level}")
        done.append(rows.where(~fractional))
        if last:
            break
        rows = rows.where(fractional).withColumn("group", F.floor(F.col("group") / FAN_IN))
        most, level = -(-most // FAN_IN), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = F.col("whole") + F.col("p").cast("bigint")
    return out.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "size", "source_size", "target",
                      (copies * F.col("size")).alias("taken"), copies.alias("copies"), "text_hash",
                      F.when(F.col("has_source"), F.col("source_key")).alias("source"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each document (all columns) as often as it was taken.

    Copies are joined back by (id, source, hash of the text); rows equal in these
    share the copies that were taken of them.
    """
    copies = (mix(docs, id_col, text_col, source_col)
              .groupBy(F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_text"), F.col("source").alias("_mix_source"))
              .agg(F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_rows")))
    own = {"_own_id": F.col(id_col).cast("bigint"), "_own_text": F.xxhash64(empty_text(text_col)),
           "_own_source": F.col(source_col).cast("string")}
    place = F.row_number().over(Window.partitionBy(*own).orderBy(F.lit(0)))
    rows = docs.withColumns(own).withColumn("_own_place", place)
    same = [F.col(k).eqNullSafe(F.col(k.replace("_own", "_mix"))) for k in own]
    times = (F.floor(F.col("_mix_copies") / F.col("_mix_rows"))
             + (F.col("_own_place") <= F.col("_mix_copies") % F.col("_mix_rows")).cast("int")).cast("int")
    return (rows.join(copies, same).withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times)))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
