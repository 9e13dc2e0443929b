"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickworks.session import work_dir

#: Words are maximal runs outside space and \t \n \v \f \r (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts lineage with files that survive a lost executor.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, key: str, name: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder with a bucket a shuffle partition, for joins on ``key`` that leave it in place.

    ``df`` should be partitioned by ``key`` already, so that each bucket is one file. Table and files go at the end:
    what is read from it must be written by then.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    held = f"tickworks_{path.rsplit('-', 1)[1]}"
    df.write.option("path", path).bucketBy(partitions(df), key).saveAsTable(held)
    try:
        yield spark.table(held)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {held}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def frequent(counts: DataFrame, count: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows of highest count, at most ``most`` of them, and the rows of the next level, which no longer fit.

    A histogram of the counts (a row per count, per sixteenth of a power of two from 1,024 on) tells
    how far down they fit, so only these rows need to leave the executors: no task sends a list of its own.
    """
    level = F.when(F.col(count) < 1_024, F.col(count)).otherwise(F.floor(1_024 + 16 * (F.log2(count) - 10)))
    total, least, edge = 0, None, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            edge = row["level"]
            break
        least = row["level"]
    none = counts.limit(0)
    return none if least is None else counts.where(level >= least), none if edge is None else counts.where(level == edge)


def empty_text(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rebatch(frames: Iterator[pd.DataFrame], size_col: str, limit: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into frames of about ``limit`` characters, at least one row each."""
    for pdf in frames:
        if not len(pdf):
            continue
        ends = pdf[size_col].str.len().fillna(0).cumsum().to_numpy()
        start, base = 0, 0.0
        while start < len(pdf):
            stop = max(start + 1, int(ends.searchsorted(base + limit, side="right")))
            yield pdf.iloc[start:stop].reset_index(drop=True)
            start, base = stop, ends[stop - 1]
