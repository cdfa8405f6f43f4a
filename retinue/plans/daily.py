"""Daily user metrics: stage the user tables, count, publish."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.functions.days import shift
from retinue.functions.ids import is_filled
from retinue.local import local_rows
from retinue.operators import metrics as M
from retinue.operators.counters import InputCounters
from retinue.operators.identity import device_ids
from retinue.operators.profile import MONTH_DAYS, group_totals, rolled_profile, user_profile
from retinue.operators.registrations import register_bounds
from retinue.operators.segments import attributes, breakdown
from retinue.operators.visits import in_day_range, is_visit, visits
from retinue.schemas import TABLES
from retinue.settings import NATION, REGISTER_TIME, Settings
from retinue.sources.store import export_json, publish, upsert
from retinue.sources.warehouse import Registration, Warehouse, cut_lineage

FAMILY = "users"


def user_metrics(
    totals: DataFrame,
    breakdowns: dict[str, DataFrame],
    stored: DataFrame,
    group_names: list[str],
    settings: Settings,
    day: str,
) -> DataFrame:
    """All user metric rows of a day.

    ``totals`` has a row per group, ``breakdowns`` per attribute a row per group and
    value; both are small. ``stored`` is the metric store, read for page views recorded
    under today's keys.
    """
    totals = M.with_all_groups(totals, group_names)
    rows = M.total_metrics(totals, day)
    if settings.page_view_group:
        rows = M.with_page_views(rows, stored, settings.page_view_group, day)
    rows = rows.unionByName(M.category_alias(rows, settings.categories, day))
    in_breakdown = F.col("pid").isin(*settings.breakdown_groups)
    rows = rows.unionByName(M.total_metrics(totals.where(in_breakdown), day, M.COVER))
    for attr, counts in breakdowns.items():
        rows = rows.unionByName(M.breakdown_metrics(counts, day, attr))
    return rows


def group_config(
    warehouse: Warehouse, groups: DataFrame, settings: Settings
) -> tuple[DataFrame, list[str], list[str]]:
    """Configured groups with the roll-up groups added, their names and their members."""
    rows = {(r.grp, r.member) for r in groups.collect()}
    for name, parts in settings.combined.items():
        rows |= {(name, member) for grp, member in rows if grp in parts}
    local = local_rows(warehouse.spark, sorted(rows), "grp", "member")
    return local, sorted({grp for grp, _ in rows}), sorted({member for _, member in rows})


def stage_devices(
    warehouse: Warehouse, members: list[str], counters: InputCounters | None = None
) -> None:
    """Write the cleaned id map of the given sub-projects for every later step.

    A sub-project whose id map has become empty has no devices any more.
    """
    ids = warehouse.table("user_id").where(F.col("pid").isin(*members))
    if counters:
        ids = counters.watch("id_map", ids, is_filled(F.col("orig_id")))
    warehouse.overwrite_each("user_device", device_ids(ids), [{"pid": m} for m in members])


def write_visits(
    warehouse: Warehouse, groups: DataFrame, settings: Settings, from_day: str, to_day: str
) -> None:
    """Write the visits of a range of days.

    A single day is replaced as a whole; in a longer range, a backfill, the groups that
    have visitors on a day. Activity derived from these days before is forgotten.
    """
    local, _, members = group_config(warehouse, groups, settings)
    _write_visits(warehouse, local, members, settings, from_day, to_day)


def _write_visits(
    warehouse: Warehouse, groups: DataFrame, members: list[str], settings: Settings,
    from_day: str, to_day: str, counters: InputCounters | None = None,
) -> None:
    of_members = F.col("pid").isin(*members)
    events = warehouse.table("user_event").where(
        of_members & F.col("day").between(from_day, to_day))
    if counters:
        events = counters.watch("events", events, is_visit(settings.heartbeat_pids) & in_day_range(
            from_day, to_day, settings.utc_offset_hours))
    rows = visits(
        events, warehouse.table("user_device").where(of_members),
        groups, from_day, to_day, settings.heartbeat_pids, settings.utc_offset_hours,
    )
    warehouse.forget("user_activity", from_day, shift(to_day, 1 - MONTH_DAYS))
    if from_day == to_day:
        warehouse.overwrite("user_visit", rows.drop("day"), day=to_day)
    else:
        warehouse.overwrite_found("user_visit", rows)


def stage_users(
    warehouse: Warehouse, local: DataFrame, members: list[str], settings: Settings, day: str
) -> None:
    """Write devices, visits of ``day``, registration bounds and attributes, and what of each
    input was read and kept."""
    counters = InputCounters() if settings.count_inputs else None
    stage_devices(warehouse, members, counters)
    _write_visits(warehouse, local, members, settings, day, day, counters)
    of_members = F.col("pid").isin(*members)
    devices = warehouse.table("user_device").where(of_members)

    def stored(prop: str) -> DataFrame:
        rows = warehouse.table("user_property").where(of_members & (F.col("prop") == prop))
        filled = is_filled(F.col("uid")) & is_filled(F.col("val"))
        return counters.watch(f"property {prop}", rows, filled) if counters else rows

    bounds = register_bounds(stored(REGISTER_TIME), devices, local)
    warehouse.overwrite("user_register_time", bounds)
    kept = local.where(F.col("grp").isin(*settings.breakdown_groups))
    for attr in settings.attributes:
        values = attributes(stored(attr), devices, kept, attr)
        warehouse.overwrite("user_attribute", values.drop("attr"), attr=attr)
    if counters:
        counted = warehouse.spark.createDataFrame(
            [(*row, day) for row in counters.counts()], TABLES["run_counters"][0])
        warehouse.overwrite("run_counters", counted.drop("run_day"), run_day=day)


def stage_activity(warehouse: Warehouse, day: str) -> DataFrame:
    """Write the activity of ``day``: each user's visits of a month as a mask, and the
    registration that a metric needs; returns it.

    It is rolled on from the newest activity of an earlier day of the month, so that only the
    visits since then are read, and built from the whole month where there is none. Whoever
    writes visits forgets the activity that follows from them, so what is stored is good:
    late days and repeated ones give what a full rebuild gives.
    """
    visits_, bounds = warehouse.table("user_visit"), warehouse.table("user_register_time")
    first = shift(day, MONTH_DAYS - 1)
    since = max((d for d in warehouse.days("user_activity") if first <= d < day), default=None)
    if since is None:
        rows = user_profile(visits_, bounds, day)
    else:
        before = warehouse.table("user_activity").where(F.col("day") == since)
        rows = rolled_profile(before, since, visits_, bounds, day)
    warehouse.overwrite_each("user_activity", rows.withColumn("day", F.lit(day)),
                             warehouse.partitions("user_activity", day, day))
    return warehouse.table("user_activity").where(F.col("day") == day).drop("day")


def run_daily(
    warehouse: Warehouse, groups: DataFrame, settings: Settings, day: str, export_root: str
) -> DataFrame:
    """Compute and publish the user metrics of ``day``; returns what was published.

    Each step reads the tables written by the one before, so later failures never repeat
    the joins behind them. A failed step fails the day and publishes nothing. Days of the
    month without stored visits are reported as a warning, as they count nobody.
    """
    local, names, members = group_config(warehouse, groups, settings)
    failed = [r for r in register_inputs(warehouse, members, settings, day) if r.error]
    if failed:
        warnings.warn(f"not registered: {failed}", stacklevel=2)
    stage_users(warehouse, local, members, settings, day)
    if missing := missing_days(warehouse, day):
        warnings.warn(f"no visits stored for {len(missing)} days from {missing[0]}", stacklevel=2)

    profile = stage_activity(warehouse, day)
    warehouse.overwrite("group_totals", group_totals(profile), day=day)
    totals = warehouse.table("group_totals").where(F.col("day") == day).drop("day")

    in_breakdown = F.col("pid").isin(*settings.breakdown_groups)
    attrs = warehouse.table("user_attribute").where(in_breakdown)
    counts = breakdown(profile.where(in_breakdown), attrs, *settings.attributes)
    warehouse.overwrite("group_breakdown", counts, day=day)
    stored_counts = warehouse.table("group_breakdown").where(F.col("day") == day)
    breakdowns = {a: stored_counts.where(F.col("attr") == a) for a in settings.attributes}
    # What this family published today is about to be replaced and must not be read. The
    # checkpoint, of rows that are all derived from the two small tables above, is needed
    # because a table cannot be read and overwritten in one plan.
    stored = warehouse.table("metrics").where(
        (F.col("run_day") == day) & (F.col("family") != FAMILY)
    )
    rows = user_metrics(totals, breakdowns, stored, names, settings, day)
    publish(warehouse, cut_lineage(rows), day, FAMILY)
    published = warehouse.table("metrics").where(
        (F.col("run_day") == day) & (F.col("family") == FAMILY)
    )
    export_json(published, export_root, day, FAMILY)
    if settings.store_client:
        upsert(published, settings.store_client, **settings.store_options)
    return published


def missing_days(warehouse: Warehouse, day: str) -> list[str]:
    """Days of the month ending at ``day`` that have no stored visits at all."""
    stored = warehouse.days("user_visit")
    wanted = [shift(day, n) for n in reversed(range(MONTH_DAYS))]
    return [d for d in wanted if d not in stored]


def expire_visits(warehouse: Warehouse, day: str, keep_days: int) -> list[str]:
    """Drop visits more than ``keep_days`` before ``day``: a job of its own.

    A day can be computed again only as long as its month is stored, so nothing is dropped
    by the daily run, and fewer days than a month are refused.
    """
    if keep_days < MONTH_DAYS:
        raise ValueError(f"a month of visits is needed; keep_days is {keep_days}")
    warehouse.expire("user_activity", day, keep_days)
    return warehouse.expire("user_visit", day, keep_days)


def register_inputs(
    warehouse: Warehouse, members: list[str], settings: Settings, day: str
) -> list[Registration]:
    """Make the raw partitions of the day known; none of it is listed from storage.

    Returns what became of each; one that fails leaves the others registered.
    """
    props = sorted({REGISTER_TIME, NATION, *settings.attributes})
    return [
        *warehouse.add_partitions("user_event", [{"day": day, "pid": m} for m in members]),
        *warehouse.add_partitions("user_id", [{"pid": m} for m in members]),
        *warehouse.add_partitions(
            "user_property", [{"pid": m, "prop": p} for m in members for p in props]),
    ]
