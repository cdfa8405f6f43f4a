"""Search metrics: stage the per-user fact of a day, then publish its combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import compact, shift
from retinue.operators.metrics import (
    level_cells,
    level_groups,
    reset_rows,
    reset_then,
    search_metrics,
    total_cells,
)
from retinue.operators.search import (
    by_level,
    fact_paths,
    search_by_type,
    search_cube,
    search_fact,
    search_paths,
    search_total,
)
from retinue.plans.daily import register_inputs, stage_devices
from retinue.settings import Settings
from retinue.sources.store import publish, upsert
from retinue.sources.warehouse import Warehouse

# Search data lags a day: a run for D reads D-1, a weekly one D-6 to D-1.
LAG = 1
WEEK_START = 6


def search_members(groups: DataFrame, settings: Settings) -> list[str]:
    """Sub-projects whose search events count."""
    of_group = groups.where(F.col("grp") == settings.search_group).collect()
    return sorted({r.member for r in of_group} | set(settings.search_extra_members))


def stage_search(
    warehouse: Warehouse, groups: DataFrame, settings: Settings, day: str
) -> None:
    """Write the search fact of the day before ``day``, in both layouts."""
    scan_day = shift(day, LAG)
    members = search_members(groups, settings)
    register_inputs(warehouse, members, settings, scan_day)
    stage_devices(warehouse, members)
    of_members = F.col("pid").isin(*members)
    found = search_paths(
        warehouse.table("user_event").where(of_members),
        warehouse.table("user_device").where(of_members),
        warehouse.table("user_property").where(of_members),
        scan_day, scan_day, settings.search_event,
    )
    stored_day = compact(scan_day)
    warehouse.overwrite("user_search_path", found.drop("day"), day=stored_day)
    found = warehouse.table("user_search_path").where(F.col("day") == stored_day)
    warehouse.overwrite("user_search", search_fact(found).drop("day"), day=stored_day)
    warehouse.overwrite(
        "user_search_by_type", search_by_type(found).drop("day"), day=stored_day
    )


def search_rows(
    fact: DataFrame, settings: Settings, day: str, period: str
) -> DataFrame:
    """Metric rows of a ``day`` or ``week`` run.

    A weekly key ends at ``day`` although the data behind it ends a day earlier.
    """
    last = shift(day, LAG)
    first = last if period == "day" else shift(day, WEEK_START)
    end = last if period == "day" else day
    cube = search_cube(fact_paths(fact, compact(first), compact(last)))
    return search_metrics(cube, settings.search_group, first, end, last, settings.search_event)


def _publish(
    warehouse: Warehouse, settings: Settings, rows: DataFrame, day: str, family: str
) -> DataFrame:
    publish(warehouse, rows, day, family)
    published = warehouse.table("metrics").where(
        (F.col("run_day") == day) & (F.col("family") == family)
    )
    if settings.store_client:
        upsert(published, settings.store_client, **settings.store_options)
    return published


def run_search(
    warehouse: Warehouse,
    settings: Settings,
    day: str,
    period: str = "day",
    today: str | None = None,
) -> DataFrame:
    """Publish the search combinations of ``day``; returns what was published.

    If ``day`` is the day before ``today``, its own keys, for which there is no data yet,
    are set to zero.
    """
    if period not in ("day", "week"):
        raise ValueError(f"period must be 'day' or 'week', not {period!r}")
    rows = search_rows(warehouse.table("user_search"), settings, day, period)
    if today is not None and shift(today, 1) == day:
        zeros = reset_rows(warehouse.spark, settings.search_group, day, settings.search_event)
        rows = reset_then(rows, zeros)
    return _publish(warehouse, settings, rows, day, f"search_{period}")


def level_rows(typed: DataFrame, settings: Settings, day: str) -> DataFrame:
    """One-dimensional search metrics: the last data day in full, the week as groups."""
    last, first = shift(day, LAG), shift(day, WEEK_START)
    of_day = by_level(typed, compact(last), compact(last))
    of_week = by_level(typed, compact(first), compact(last))
    total = search_total(typed, compact(last), compact(last))
    cells = total_cells(total).unionByName(level_cells(of_day)).unionByName(level_groups(of_day))
    project, event = settings.search_group, settings.search_event
    return search_metrics(cells, project, last, last, last, event).unionByName(
        search_metrics(level_groups(of_week), project, first, day, last, event)
    )


def run_search_levels(
    warehouse: Warehouse, settings: Settings, day: str, today: str | None = None
) -> DataFrame:
    """Publish the one-dimensional search metrics of ``day``.

    If ``day`` is the day before ``today``, its own keys are set to zero, as in ``run_search``.
    """
    rows = level_rows(warehouse.table("user_search_by_type"), settings, day)
    if today is not None and shift(today, 1) == day:
        zeros = reset_rows(warehouse.spark, settings.search_group, day, settings.search_event)
        rows = reset_then(rows, zeros)
    return _publish(warehouse, settings, rows, day, "search_levels")
