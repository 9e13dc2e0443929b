import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickworks.session import build_session, checkpoint_root
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tickworks-test-")


def tick_rows(spark, rows):
    """rows: (symbol, 'YYYY-mm-dd HH:MM:SS', price, volume, offset[, partition])."""
    from pyspark.sql import functions as F
    data = [(r[0], r[1], r[2], r[3], r[5] if len(r) > 5 else 0, r[4]) for r in rows]
    df = spark.createDataFrame(
        data, "symbol string, ts string, price double, volume bigint, partition int, offset bigint")
    return df.select(
        "symbol", F.col("ts").try_cast("timestamp").alias("timestamp"), "price", "volume",
        F.lit("test").alias("source"), F.col("ts").try_cast("timestamp").alias("kafka_timestamp"),
        "partition", "offset")
