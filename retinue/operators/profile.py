"""One row per user and group from which every user metric of a day is a sum of flags.

The alternative, one distinct count per (group, metric, window, attribute), would shuffle
the visits once for each of them.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import age_in_days, compact, shift

MONTH_DAYS = 30
OLDEST_COHORT = 7
LADDER_STEPS = (5, 4, 3, 2)


def _visit_bits(visit_rows: DataFrame, day: str, days: int) -> DataFrame:
    """Visits as single bits: bit k stands for a visit k days before ``day``."""
    age = F.datediff(F.lit(day).cast("date"), F.to_date("day"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), age)
    return visit_rows.where(F.col("day").between(shift(day, days - 1), day)).select(
        "pid", "orig_id", bit.alias("visit_mask")
    )


def visited(days: int) -> Column:
    """Visited on one of the ``days`` days ending at the profile's day."""
    return F.col("visit_mask").bitwiseAND(F.lit((1 << days) - 1)) != 0


def registered(age: int) -> Column:
    return F.col("reg_age") == age


def retained(age: int, days: int) -> Column:
    """Registered ``age`` days ago and seen again within the last ``days`` days."""
    return registered(age) & visited(days)


def _recent_registrations(bounds: DataFrame, day: str) -> DataFrame:
    """Age of the registration, and whether it covers an earlier one, of recent users.

    The filter compares the stored text, so that it reaches the scan.
    """
    today = compact(day)
    first, last = F.col("min_reg_time"), F.col("max_reg_time")
    is_cover = (last == today) & (first < today)
    in_cohorts = first.between(compact(shift(day, OLDEST_COHORT)), today)
    return bounds.where(in_cohorts | is_cover).select(
        "pid", "orig_id", age_in_days(first, day).alias("reg_age"), is_cover.alias("is_cover")
    )


def user_profile(
    visit_rows: DataFrame, bounds: DataFrame, day: str, days: int = MONTH_DAYS
) -> DataFrame:
    """(pid, orig_id, visit_mask, reg_age, is_cover) of users a metric of ``day`` needs.

    Visits and registrations are stacked and aggregated rather than joined: a single
    shuffle whose input is combined beforehand, and nothing to sort. Duplicate visit rows
    do no harm, so visits need not be de-duplicated first. With fewer ``days`` only the
    visits of these are read; flags that look further back are then not to be used.
    """
    return _profile(_visit_bits(visit_rows, day, days), bounds, day)


def rolled_profile(
    previous: DataFrame, since: str, visit_rows: DataFrame, bounds: DataFrame, day: str
) -> DataFrame:
    """The profile of ``day`` from the one of ``since``, an earlier day of its month.

    The masks move on by the days between, losing those that leave the month, and only the
    visits after ``since`` are read. Registrations are taken anew, as they may have changed.
    """
    days = (date.fromisoformat(day) - date.fromisoformat(since)).days
    if not 0 < days < MONTH_DAYS:
        raise ValueError(f"{since} is not in the month that ends at {day}, or not before it")
    moved = F.call_function("shiftleft", F.col("visit_mask"), F.lit(days))
    kept = previous.select(
        "pid", "orig_id", moved.bitwiseAND(F.lit((1 << MONTH_DAYS) - 1)).alias("visit_mask")
    ).where(F.col("visit_mask") != 0)
    return _profile(kept.unionByName(_visit_bits(visit_rows, day, days)), bounds, day)


def _profile(visits: DataFrame, bounds: DataFrame, day: str) -> DataFrame:
    return (
        visits.unionByName(_recent_registrations(bounds, day), allowMissingColumns=True)
        .groupBy("pid", "orig_id")
        .agg(
            F.coalesce(F.bit_or("visit_mask"), F.lit(0)).alias("visit_mask"),
            F.min("reg_age").alias("reg_age"),
            F.coalesce(F.bool_or("is_cover"), F.lit(False)).alias("is_cover"),
        )
    )


def total_flags() -> dict[str, Column]:
    """Metrics of whole groups."""
    return {
        "dau": visited(1),
        "wau": visited(7),
        "mau": visited(MONTH_DAYS),
        "new_users": registered(0),
        "cover_users": F.col("is_cover"),
        "total_new": registered(0) | F.col("is_cover"),
        "ret_day2": retained(1, 1),
        "ret_day7": retained(6, 1),
        "ret_week": retained(7, 7),
    }


def breakdown_flags() -> dict[str, Column]:
    """Metrics that are also published per attribute value.

    The weekly one starts from the cohort of six days ago, unlike that of whole groups.
    """
    ladder = {f"ladder_{k}": retained(k, k) for k in LADDER_STEPS}
    return {
        "active": visited(1),
        "new": registered(0),
        "new_7d": F.col("reg_age").between(0, 6),
        "ret_day2": retained(1, 1),
        "ret_day7": retained(6, 1),
        "ret_week": retained(6, 6),
        **ladder,
    }


def _counts(flags: dict[str, Column]) -> list[Column]:
    return [F.count_if(F.coalesce(flag, F.lit(False))).alias(m) for m, flag in flags.items()]


def any_of(flags: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags.values()])


def group_totals(profile: DataFrame) -> DataFrame:
    """One row per group with all whole-group metrics."""
    return profile.groupBy("pid").agg(*_counts(total_flags()))


def group_breakdown(segmented: DataFrame) -> DataFrame:
    """One row per group, attribute and value; input carries ``attr`` and ``attr_value``."""
    return segmented.groupBy("pid", "attr", "attr_value").agg(*_counts(breakdown_flags()))
