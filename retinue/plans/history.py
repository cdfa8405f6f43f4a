"""History of group totals by the set rules, and republication of exported metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import shift
from retinue.operators import metrics as M
from retinue.operators.history import history_row, newest, unpivot_newest, wide_totals
from retinue.operators.identity import device_ids, to_groups
from retinue.operators.profile import MONTH_DAYS, group_totals, user_profile
from retinue.operators.registrations import register_bounds
from retinue.operators.visits import member_visits
from retinue.settings import HISTORY_ROWS, UNMAPPED_ID
from retinue.sources.store import publish, reload_json
from retinue.sources.warehouse import Warehouse

FAMILY = "history"


def set_visits(
    events: DataFrame, ids: DataFrame, from_day: str, to_day: str, heartbeat_pids: Sequence[str]
) -> DataFrame:
    """Visitors per day and sub-project under the set rules.

    These differ from the daily metrics: heartbeats count in the listed sub-projects
    only, and visitors without a device id count together as one.
    """
    return member_visits(events, device_ids(ids, UNMAPPED_ID), from_day, to_day, heartbeat_pids)


def cohort_totals(
    visited: DataFrame, ids: DataFrame, properties: DataFrame, groups: DataFrame, day: str
) -> DataFrame:
    """Group totals of a day from the visitors of its month per sub-project."""
    bounds = register_bounds(properties, device_ids(ids), groups)
    totals = group_totals(user_profile(to_groups(visited, groups), bounds, day))
    return totals.select(F.lit(day).alias("day"), "*")


def _any_day(days: dict[str, list[str]]) -> Column:
    """Partitions of several days, each with its sub-projects."""
    return reduce(Column.__or__, [
        (F.col("day") == d) & F.col("pid").isin(*pids) for d, pids in sorted(days.items())])


def unstaged(warehouse: Warehouse, members: Sequence[str], day: str) -> dict[str, list[str]]:
    """Days of the month ending at ``day`` that are in the log of a sub-project, but whose
    visitors are not staged. ``day`` itself is always among them."""
    first = shift(day, MONTH_DAYS - 1)
    staged = warehouse.partitions("user_set_visit", first, day)
    missing = {day: list(members)}
    for p in warehouse.partitions("user_event", first, shift(day, 1)):
        if p["pid"] in members and p not in staged:
            missing.setdefault(p["day"], []).append(p["pid"])
    return missing


def stage_sets(
    warehouse: Warehouse, members: Sequence[str], day: str, heartbeat_pids: Sequence[str]
) -> dict[str, list[str]]:
    """Write the visitors of ``day`` per sub-project; returns the days and sub-projects written.

    As a rule that is one day of the log. Days of the month that were never staged, in a first
    run or for a sub-project that has come in since, are caught up in the same pass.
    """
    missing = unstaged(warehouse, members, day)
    events = warehouse.table("user_event").where(_any_day(missing))
    ids = warehouse.table("user_id").where(F.col("pid").isin(*members))
    rows = set_visits(events, ids, min(missing), day, heartbeat_pids)
    warehouse.overwrite_each("user_set_visit", rows, [
        {"day": d, "pid": pid} for d, pids in missing.items() for pid in pids])
    return missing


def run_history(
    warehouse: Warehouse,
    groups: DataFrame,
    group_names: Sequence[str],
    day: str,
    heartbeat_pids: Sequence[str],
    rows: int = HISTORY_ROWS,
) -> DataFrame:
    """Add the totals of ``day`` to the history, publish them, return the newest ``rows``.

    Visitors are kept per day and sub-project, so a group that is added later has the visitors
    of its members in the days before. Totals are kept per day: running a day again replaces
    its row, and only the newest days are read. The columns are those of ``group_names``; days
    written before a group was added have 0 for it.
    """
    members = sorted({r.member for r in groups.collect()})
    warehouse.add_partitions("user_event", [{"day": day, "pid": m} for m in members])
    stage_sets(warehouse, members, day, heartbeat_pids)
    of_members = F.col("pid").isin(*members)
    month = F.col("day").between(shift(day, MONTH_DAYS - 1), day)
    totals = cohort_totals(
        warehouse.table("user_set_visit").where(month & of_members),
        warehouse.table("user_id").where(of_members),
        warehouse.table("user_property").where(of_members), groups, day,
    )
    warehouse.overwrite("set_totals", totals.drop("day"), day=day)
    publish_history(warehouse, group_names, day)
    return stored_history(warehouse, group_names, rows)


def stored_history(
    warehouse: Warehouse, group_names: Sequence[str], rows: int = HISTORY_ROWS,
    to_day: str | None = None,
) -> DataFrame:
    """The newest ``rows`` days of the history, one wide row each."""
    days = sorted(d for d in warehouse.days("set_totals") if to_day is None or d <= to_day)
    kept = warehouse.table("set_totals").where(F.col("day").isin(*days[-rows:]))
    return newest(history_row(kept, group_names), rows)


def publish_history(warehouse: Warehouse, group_names: Sequence[str], day: str) -> DataFrame:
    """Publish the history row of ``day`` as metrics; returns what was published.

    Keys are those of the daily metrics, which take precedence where both are published.
    """
    last = stored_history(warehouse, group_names, 1, day).where(F.col("day") == day)
    totals = wide_totals(unpivot_newest(last, group_names))
    publish(warehouse, M.total_metrics(totals, day), day, FAMILY)
    return warehouse.table("metrics").where(
        (F.col("run_day") == day) & (F.col("family") == FAMILY)
    )


def republish(warehouse: Warehouse, export_root: str, day: str, family: str) -> DataFrame:
    """Publish the exported metrics of ``day`` again."""
    rows = reload_json(warehouse.spark, export_root, day, family)
    publish(warehouse, rows, day, family)
    return warehouse.table("metrics").where(
        (F.col("run_day") == day) & (F.col("family") == family)
    )
