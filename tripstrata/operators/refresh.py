"""Gold tables brought up to date from the days of silver that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gold import DAILY_SUMMARY_COLUMNS, gold_daily_summary
from .ranking import rolling_average

HOUR = ["pickup_date", "pickup_hour"]
ROLLING = "rolling_7d_avg_trips"


def changed_summary(stored: DataFrame, silver: DataFrame, touched: Sequence) -> tuple[DataFrame, list]:
    """(rows, days): the hourly table's rows of all days that change when the days ``touched`` of silver did.

    Measures and ranks change on the touched days only.  The rolling average of an hour reaches over its next six
    rows, whatever their dates, so it is computed anew from three columns of the stored table, and days where it
    differs change too.  Silver is read on the touched days alone.  The driver sees a row a changed day.
    """
    on_touched = F.col("pickup_date").isin(list(touched))
    fresh = gold_daily_summary(silver.filter(on_touched))
    kept = stored.filter(~on_touched)
    narrow = [*HOUR, "trip_count"]
    rolled = rolling_average(kept.select(*narrow).unionByName(fresh.select(*narrow))).select(*HOUR, F.col(ROLLING).alias("_rolled"))
    moved = kept.join(rolled, HOUR).filter(~F.col(ROLLING).eqNullSafe(F.col("_rolled"))).select("pickup_date").distinct()
    days = sorted({*touched, *(row[0] for row in moved.collect())})
    rows = kept.filter(F.col("pickup_date").isin(days)).unionByName(fresh).join(rolled, HOUR).withColumn(ROLLING, F.col("_rolled"))
    return rows.select(*DAILY_SUMMARY_COLUMNS), days
