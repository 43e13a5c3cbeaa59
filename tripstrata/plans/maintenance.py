"""What is done to a lake every day: old versions go, small files are merged."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.history import TableHistory
from ..operators.stored import compact, run_maintenance
from .audit import utc_now
from .medallion import SORT_COLUMNS, Layout

# Versions are kept for a week, and the three newest in any case.
KEEP_DAYS, KEEP_VERSIONS = 7, 3


def default_plan(spark: SparkSession, root: str, profile: str = "dbt", now: dt.datetime | None = None) -> dict[str, Callable[[], object]]:
    """Tasks by table for :func:`run_maintenance`: expiry of silver's versions, compaction of silver and of daily gold."""
    layout, limit = Layout(root.rstrip("/"), profile), (now or utc_now()) - dt.timedelta(days=KEEP_DAYS)
    order = SORT_COLUMNS.get(profile, ("pickup_datetime",))

    def silver() -> None:
        TableHistory(spark, layout.silver).expire(limit, KEEP_VERSIONS)
        compact(spark, layout.silver, sort_by=order)

    plan: dict[str, Callable[[], object]] = {f"silver_{profile}": silver}
    if "daily_summary" in layout.gold():
        plan[f"gold_{profile}_daily_summary"] = lambda: compact(spark, layout.gold()["daily_summary"], sort_by=("pickup_hour",))
    return plan


def maintain(spark: SparkSession, root: str, profile: str = "dbt", now: dt.datetime | None = None) -> DataFrame:
    """Run :func:`default_plan`; a row per table with how it went."""
    return run_maintenance(spark, default_plan(spark, root, profile, now))
