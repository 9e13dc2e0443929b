"""Plain forms that the chunked operators are compared with."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickworks.schema import SMA_MIN_TICKS, SMA_WINDOW


def rolling_mean_plain(ticks: DataFrame, n: int = SMA_WINDOW,
                       min_ticks: int = SMA_MIN_TICKS, out_col: str = "sma") -> DataFrame:
    """One window per symbol: exact, but a hot symbol is one task."""
    w = Window.partitionBy("symbol").orderBy("partition", "offset")
    t = ticks.where(F.col("price").isNotNull() & F.col("offset").isNotNull())
    mean = F.when(F.row_number().over(w) >= min_ticks,
                  F.avg("price").over(w.rowsBetween(-(n - 1), 0)))
    return t.withColumn(out_col, mean)
