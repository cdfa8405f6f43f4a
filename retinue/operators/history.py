"""Wide one-row-per-day history of the group totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.schemas import HISTORY_METRICS
from retinue.settings import HISTORY_ROWS


def history_columns(groups: Sequence[str]) -> list[str]:
    return [f"{m}_{g}" for m in HISTORY_METRICS for g in groups]


def history_row(totals: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(day, pid, metric columns) to one row per day with a column per metric and group.

    The groups are known, so the pivot needs no pass to discover them.
    """
    wide = totals.groupBy("day").agg(*[
        F.max(F.when(F.col("pid") == g, F.col(m))).alias(f"{m}_{g}")
        for m in HISTORY_METRICS for g in groups
    ])
    return wide.na.fill(0, history_columns(groups))


def newest(history: DataFrame, rows: int = HISTORY_ROWS) -> DataFrame:
    return history.orderBy(F.desc("day")).limit(rows)


def unpivot_newest(history: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The newest history row back as (day, pid, metric, users) rows."""
    entries = [
        F.struct(F.lit(g).alias("pid"), F.lit(m).alias("metric"),
                 F.col(f"{m}_{g}").cast("bigint").alias("users"))
        for m in HISTORY_METRICS for g in groups
    ]
    return newest(history, 1).select("day", F.inline(F.array(*entries)))


def wide_totals(entries: DataFrame) -> DataFrame:
    """(pid, metric, users) rows back to one row per group with a column per metric."""
    return entries.groupBy("pid").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("users"))).alias(m) for m in HISTORY_METRICS
    ])
