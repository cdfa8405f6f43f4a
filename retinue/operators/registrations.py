"""Registration bounds, new and cover users, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import compact
from retinue.operators.identity import decorated, register_times, to_groups


def register_bounds(properties: DataFrame, devices: DataFrame, groups: DataFrame) -> DataFrame:
    """First and last registration day per device and group.

    Bounds are taken on the full time text and cut to the day afterwards.
    """
    per_device = register_times(properties).join(decorated(devices), ["pid", "uid"])
    return (
        to_groups(per_device.drop("uid"), groups)
        .groupBy("pid", "orig_id")
        .agg(F.max("max_val").alias("max_val"), F.min("min_val").alias("min_val"))
        .select(
            "pid",
            "orig_id",
            F.substring("max_val", 1, 8).alias("max_reg_time"),
            F.substring("min_val", 1, 8).alias("min_reg_time"),
        )
    )


def combine_bounds(bounds: DataFrame, parts: Sequence[str], combined: str) -> DataFrame:
    """Bounds of the union of several groups: last of the lasts, first of the firsts."""
    return (
        bounds.where(F.col("pid").isin(*parts))
        .groupBy("orig_id")
        .agg(F.max("max_reg_time").alias("max_reg_time"),
             F.min("min_reg_time").alias("min_reg_time"))
        .withColumn("pid", F.lit(combined))
    )


def first_register(properties: DataFrame, devices: DataFrame) -> DataFrame:
    """Earliest registration time text per sub-project and device."""
    return (
        register_times(properties)
        .join(decorated(devices), ["pid", "uid"])
        .groupBy("pid", "orig_id")
        .agg(F.min("min_val").alias("reg_time"))
    )


def register_histogram(bounds: DataFrame, month: str) -> DataFrame:
    """Users per first registration day within a ``yyyyMM`` month."""
    return (
        bounds.where(F.col("min_reg_time").startswith(month))
        .groupBy("pid", F.col("min_reg_time").alias("reg_day"))
        .agg(F.count("*").alias("users"))
    )


def new_users(bounds: DataFrame, day: str) -> DataFrame:
    """Users who registered on ``day``, per group; bounds are unique per group and device."""
    return (
        bounds.where(F.col("min_reg_time") == compact(day))
        .groupBy("pid")
        .agg(F.count("*").alias("users"))
    )


def cover_users(bounds: DataFrame, day: str) -> DataFrame:
    """Cover users and their sum with the new ones, per group.

    A cover user registered on ``day`` and had registered earlier in another member.
    """
    today = compact(day)
    is_new = F.col("min_reg_time") == today
    is_cover = (F.col("max_reg_time") == today) & (F.col("min_reg_time") < today)
    return (
        bounds.where(is_new | is_cover)
        .groupBy("pid")
        .agg(F.count_if(is_cover).alias("cover"), F.count("*").alias("total_new"))
    )


def retained_set(
    visits: DataFrame, bounds: DataFrame, reg_day: str, from_day: str, to_day: str
) -> DataFrame:
    """Users who registered on ``reg_day`` and visited in the range, once per group."""
    cohort = bounds.where(F.col("min_reg_time") == compact(reg_day)).select("pid", "orig_id")
    visited = visits.where(F.col("day").between(from_day, to_day)).select("pid", "orig_id")
    return cohort.join(visited, ["pid", "orig_id"], "left_semi").distinct()


def retention(
    visits: DataFrame, bounds: DataFrame, reg_day: str, from_day: str, to_day: str
) -> DataFrame:
    return (
        retained_set(visits, bounds, reg_day, from_day, to_day)
        .groupBy("pid")
        .agg(F.count("*").alias("users"))
    )
