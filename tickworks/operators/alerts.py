"""Volume alerts and the recent-alert report.

P7/P8/P12  volume_alerts  ticks with volume > threshold as VOLUME_SPIKE alerts
O1         latest_alerts  newest ``n`` alerts by time (ties: later arrival first)

``volume_alerts`` is a row-local filter + projection (pushed to the scan when
the ticks come from parquet); ``latest_alerts`` is a TakeOrderedAndProject:
every task keeps its own top ``n``, one task merges them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import VOLUME_SPIKE, VOLUME_SPIKE_THRESHOLD

ALERT_COLUMNS = ["symbol", "price", "volume", "alert_type", "timestamp"]


def volume_alerts(ticks: DataFrame, threshold: int = VOLUME_SPIKE_THRESHOLD,
                  keep_seq: bool = True) -> DataFrame:
    """Strictly greater than ``threshold``; a null volume never alerts."""
    extra = ["partition", "offset"] if keep_seq else []
    return (ticks.where(F.col("volume") > F.lit(threshold))
            .select("symbol", "price", "volume", F.lit(VOLUME_SPIKE).alias("alert_type"),
                    "timestamp", *extra))


def latest_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` alerts: timestamp desc, then arrival (partition, offset) desc."""
    order = [F.col("timestamp").desc_nulls_last()]
    order += [F.col(c).desc() for c in ("partition", "offset") if c in alerts.columns]
    return alerts.orderBy(*order).limit(n)
