"""Unique visitors per group and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import bounds_ms, shift
from retinue.operators.identity import in_any_group, to_groups
from retinue.settings import HEARTBEAT_PREFIX, VISIT_PREFIX


def is_visit(heartbeat_pids: Sequence[str] | None = None) -> Column:
    """Visits and heartbeats; with ``heartbeat_pids`` heartbeats count only there."""
    event = F.col("event")
    heartbeat = event.startswith(HEARTBEAT_PREFIX)
    if heartbeat_pids is not None:
        heartbeat = heartbeat & F.col("pid").isin(*heartbeat_pids)
    return event.startswith(VISIT_PREFIX) | heartbeat


def in_day_range(from_day: str, to_day: str, utc_offset_hours: int = 0) -> Column:
    """Day partition and epoch milliseconds both inside the range, ends included.

    ``ts`` is compared as a number; text that is not one never matches.
    """
    first, _ = bounds_ms(from_day, utc_offset_hours)
    _, last = bounds_ms(to_day, utc_offset_hours)
    ts = F.col("ts").try_cast("bigint")
    return F.col("day").between(from_day, to_day) & ts.between(first, last)


def visit_events(
    events: DataFrame,
    from_day: str,
    to_day: str,
    heartbeat_pids: Sequence[str] | None = None,
    utc_offset_hours: int = 0,
) -> DataFrame:
    return events.where(
        in_day_range(from_day, to_day, utc_offset_hours) & is_visit(heartbeat_pids)
    )


def events_to_devices(visited: DataFrame, devices: DataFrame) -> DataFrame:
    """Day and device of each visiting uid.

    The log shrinks to one row per day and uid before it meets the id map, so a uid that
    fills the log costs one row per map task.
    """
    uids = visited.select("day", "pid", "uid").distinct()
    return uids.join(devices, ["pid", "uid"]).drop("uid")


def visit_rows(
    events: DataFrame,
    devices: DataFrame,
    groups: DataFrame,
    from_day: str,
    to_day: str,
    heartbeat_pids: Sequence[str] | None = None,
    utc_offset_hours: int = 0,
) -> DataFrame:
    """(day, orig_id, pid) of visiting devices, not yet de-duplicated."""
    visited = visit_events(events, from_day, to_day, heartbeat_pids, utc_offset_hours)
    return to_groups(events_to_devices(in_any_group(visited, groups), devices), groups)


def member_visits(
    events: DataFrame,
    devices: DataFrame,
    from_day: str,
    to_day: str,
    heartbeat_pids: Sequence[str] | None = None,
    utc_offset_hours: int = 0,
) -> DataFrame:
    """Distinct (day, orig_id, pid) of visiting devices per sub-project, of no group yet."""
    visited = visit_events(events, from_day, to_day, heartbeat_pids, utc_offset_hours)
    return events_to_devices(visited, devices).select("day", "orig_id", "pid").distinct()


def visits(*args, **kwargs) -> DataFrame:
    """Distinct visitors per group and day; arguments as for ``visit_rows``."""
    return visit_rows(*args, **kwargs).distinct()


def combine_visits(visits_: DataFrame, parts: Sequence[str], combined: str) -> DataFrame:
    """Distinct union of the visitors of several groups, under a new group name."""
    return (
        visits_.where(F.col("pid").isin(*parts))
        .select("day", "orig_id", F.lit(combined).alias("pid"))
        .distinct()
    )


def active_users(visits_: DataFrame, day: str, days: int = 1) -> DataFrame:
    """Distinct visitors per group over the ``days`` days ending at ``day``."""
    return (
        visits_.where(F.col("day").between(shift(day, days - 1), day))
        .groupBy("pid")
        .agg(F.count_distinct("orig_id").alias("users"))
    )


def unique_users(visits_: DataFrame, day: str, days: int = 7) -> DataFrame:
    """The distinct visitors themselves over the ``days`` days ending at ``day``."""
    in_range = F.col("day").between(shift(day, days - 1), day)
    return visits_.where(in_range).select("pid", "orig_id").distinct()
