"""Breakdowns of user counts by an attribute such as the nation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import compact, shift
from retinue.operators import profile as up
from retinue.operators.identity import decorated, filled_properties, to_groups
from retinue.operators.visits import unique_users
from retinue.settings import UNKNOWN_VALUE


def attributes(
    properties: DataFrame, devices: DataFrame, groups: DataFrame, *attrs: str
) -> DataFrame:
    """Distinct (pid, attr, orig_id, val); a device may keep several values."""
    stored = filled_properties(properties, *attrs).select("pid", "uid", "prop", "val").distinct()
    owned = stored.join(decorated(devices), ["pid", "uid"]).drop("uid")
    return to_groups(owned, groups).withColumnRenamed("prop", "attr").distinct()


def with_attribute(users: DataFrame, attrs: DataFrame, attr: str) -> DataFrame:
    """Attach the values of ``attr`` to users that are unique on (pid, orig_id).

    Users without one get the unknown value, users with several appear once under each.
    Values are distinct per user, so no key can be heavy.
    """
    values = attrs.where(F.col("attr") == attr).select("pid", "orig_id", "val")
    joined = users.join(values, ["pid", "orig_id"], "left")
    return joined.withColumn(
        "attr_value", F.coalesce(F.col("val"), F.lit(UNKNOWN_VALUE))
    ).drop("val")


def count_by_attr(users: DataFrame, attrs: DataFrame, attr: str) -> DataFrame:
    return (
        with_attribute(users, attrs, attr)
        .groupBy("pid", "attr_value")
        .agg(F.count("*").alias("users"))
    )


def active_by_attr(
    visits: DataFrame, attrs: DataFrame, attr: str, day: str, days: int = 1
) -> DataFrame:
    return count_by_attr(unique_users(visits, day, days), attrs, attr)


def new_by_attr(
    bounds: DataFrame, attrs: DataFrame, attr: str, from_day: str, to_day: str
) -> DataFrame:
    registered = F.col("min_reg_time").between(compact(from_day), compact(to_day))
    return count_by_attr(bounds.where(registered).select("pid", "orig_id"), attrs, attr)


def retention_by_attr(
    visits: DataFrame,
    bounds: DataFrame,
    attrs: DataFrame,
    attr: str,
    day: str,
    steps: Sequence[tuple[int, int]],
) -> DataFrame:
    """Retained users per step and attribute value, all steps in one pass.

    A step (age, days) takes the cohort registered ``age`` days before ``day`` and its
    visits on the ``days`` days ending at ``day``.
    """
    users = up.user_profile(visits, bounds, day, max(days for _age, days in steps))
    step_rows = [
        F.when(
            up.retained(age, days),
            F.struct(F.lit(shift(day, age)).alias("reg_day"),
                     F.lit(shift(day, days - 1)).alias("from_day")),
        )
        for age, days in steps
    ]
    hits = F.filter(F.array(*step_rows), lambda s: s.isNotNull())
    in_a_step = users.withColumn("steps", hits).where(F.size("steps") > 0)
    return (
        with_attribute(in_a_step.select("pid", "orig_id", "steps"), attrs, attr)
        .select("pid", "attr_value", F.inline("steps"))
        .groupBy("pid", "reg_day", "from_day", "attr_value")
        .agg(F.count("*").alias("users"))
    )


def with_attributes(users: DataFrame, attrs: DataFrame, *names: str) -> DataFrame:
    """Users, unique on (pid, orig_id), once for each value of each attribute.

    The values of a user are gathered as one array per attribute, so that one scan of the
    attributes and one join serve any number of them. A user without a value of an attribute
    gets the unknown value there.
    """
    gathered = attrs.where(F.col("attr").isin(*names)).groupBy("pid", "orig_id").agg(*[
        F.collect_set(F.when(F.col("attr") == name, F.col("val"))).alias(f"values_{i}")
        for i, name in enumerate(names)
    ])

    def named(name: str, values: Column) -> Column:
        known = F.when(F.size(values) > 0, values).otherwise(F.array(F.lit(UNKNOWN_VALUE)))
        return F.transform(
            known, lambda v: F.struct(F.lit(name).alias("attr"), v.alias("attr_value")))

    rows = [named(name, F.col(f"values_{i}")) for i, name in enumerate(names)]
    joined = users.join(gathered, ["pid", "orig_id"], "left")
    return joined.select(*users.columns, F.inline(F.concat(*rows)))


def breakdown(profile: DataFrame, attrs: DataFrame, *names: str) -> DataFrame:
    """All per-value metrics of a day, of all the attributes, in one pass over the profile."""
    counted = profile.where(up.any_of(up.breakdown_flags()))
    return up.group_breakdown(with_attributes(counted, attrs, *names))
