"""Joins, counts and sets over users."""

from __future__ import annotations

from pyspark.sql import functions as F

from retinue.catalog.common import (
    DAY,
    HEARTBEAT_PIDS,
    MD5UID,
    NEXT_DAY,
    PREFIX,
    Catalog,
    all_visits,
    back,
    bounds_of,
    everything,
    month,
    nations_of,
    today,
    totals_sql,
    visits_of,
    week,
)
from retinue.functions import ids as I
from retinue.functions.days import compact, shift
from retinue.operators import counters, identity, registrations, search, segments
from retinue.operators import metrics as M
from retinue.operators import visits as V
from retinue.operators.profile import group_totals, user_profile
from retinue.plans.history import cohort_totals, set_visits
from retinue.settings import Settings

catalog = Catalog()
add = catalog.add
NATION = "nation"


# --- joins ---------------------------------------------------------------------------


@add("event_to_orig", """
SELECT e.event_id, e.pid, d.orig_id FROM ev e JOIN dev d ON d.pid = e.pid AND d.uid = e.uid""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    joined = x.events.join(x.devices, ["pid", "uid"])
    return joined.select("event_id", "pid", "orig_id")


@add("property_to_orig", """
SELECT p.pid, d.orig_id, p.prop, p.val FROM props p
JOIN ddev d ON d.pid = p.pid AND d.uid = p.uid WHERE trim(p.val) <> ''""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    stored = identity.filled_properties(x.properties, "register_time", NATION)
    return stored.join(identity.decorated(x.devices), ["pid", "uid"]).drop("uid")


RETAINED = f"""SELECT DISTINCT v.pid, v.orig_id FROM vis v
JOIN reg r ON r.pid = v.pid AND r.orig_id = v.orig_id
WHERE r.min_reg_time = '{compact(back(7))}' AND v.day BETWEEN '{back(6)}' AND '{DAY}'"""


@add("retained_join", RETAINED)
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    return registrations.retained_set(
        visits_of(x, 7), bounds_of(x), back(7), back(6), DAY)


@add("visit_attr_left", f"""
SELECT v.pid, v.orig_id, coalesce(a.val, 'XA-NA') AS attr_value FROM vis v
LEFT JOIN att a ON a.pid = v.pid AND a.orig_id = v.orig_id WHERE v.day = '{DAY}'""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    users = V.unique_users(visits_of(x, 1), DAY, 1)
    return segments.with_attribute(users, nations_of(x), NATION)


@add("register_attr_left", """
SELECT r.pid, r.orig_id, r.min_reg_time, coalesce(a.val, 'XA-NA') AS attr_value FROM reg r
LEFT JOIN att a ON a.pid = r.pid AND a.orig_id = r.orig_id""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    users = bounds_of(x).drop("max_reg_time")
    return segments.with_attribute(users, nations_of(x), NATION)


@add("retained_attr_left", f"""
SELECT x.pid, x.orig_id, coalesce(a.val, 'XA-NA') AS attr_value FROM ({RETAINED}) x
LEFT JOIN att a ON a.pid = x.pid AND a.orig_id = x.orig_id""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    users = registrations.retained_set(visits_of(x, 7), bounds_of(x), back(7), back(6), DAY)
    return segments.with_attribute(users, nations_of(x), NATION)


@add("tagged_set_join", """
SELECT DISTINCT e.pid, e.uid, d.orig_id FROM ev e JOIN dev d ON d.pid = e.pid AND d.uid = e.uid
WHERE e.event LIKE 'visit.%'""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    left = x.events.where(F.col("event").startswith("visit.")).select("pid", "uid").distinct()
    return left.join(x.devices, ["pid", "uid"])


@add("search_uid_to_orig", """
SELECT r.day, r.pid, r.uid, d.orig_id, CAST(r.count AS BIGINT) AS count FROM roll r
JOIN dev d ON d.pid = r.pid AND d.uid = r.uid""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    rollup = search.user_rollup(search.search_events(x.events, None, None, PREFIX))
    stored = rollup.withColumn("uid", I.md5uid(F.col("uid")))
    inner = stored.withColumn("uid", I.truncate_uid(F.col("uid")).cast("string"))
    return inner.join(x.devices, ["pid", "uid"]).select(
        "day", "pid", "uid", "orig_id", "count")


@add("search_uid_to_nation", f"""
SELECT r.day, r.pid, r.uid, coalesce(n.nation, '*') AS nation FROM roll r
LEFT JOIN nat n ON n.pid = r.pid AND n.uid = {MD5UID.format('r.uid')}""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    rollup = search.user_rollup(search.search_events(x.events, None, None, PREFIX))
    keyed = rollup.withColumn("key", I.md5uid(F.col("uid")))
    stored = search.nations(x.properties).withColumnRenamed("uid", "key")
    return keyed.join(stored, ["pid", "key"], "left").select(
        "day", "pid", "uid", F.coalesce(NATION, F.lit("*")).alias(NATION))


# --- counts per group --------------------------------------------------------------------


def active_sql(first: str, last: str = DAY) -> str:
    return (f"SELECT pid, count(DISTINCT orig_id) AS users FROM vis "
            f"WHERE day BETWEEN '{first}' AND '{last}' GROUP BY pid")


def _add_active(name: str, days: int) -> None:
    @add(name, active_sql(back(days - 1)))
    def _(spark, sf_dir):
        return V.active_users(visits_of(month(spark, sf_dir), days), DAY, days)


_add_active("daily_active", 1)
_add_active("weekly_active", 7)
_add_active("monthly_active", 30)


@add("monthly_active_next_day", active_sql(shift(NEXT_DAY, 29), NEXT_DAY))
def _(spark, sf_dir):
    return V.active_users(all_visits(everything(spark, sf_dir)), NEXT_DAY, 30)


@add("new_users", f"""
SELECT pid, count(DISTINCT orig_id) AS users FROM reg
WHERE min_reg_time = '{compact(DAY)}' GROUP BY pid""")
def _(spark, sf_dir):
    return registrations.new_users(bounds_of(today(spark, sf_dir)), DAY)


COVER = f"""SELECT pid,
  count(*) FILTER (WHERE max_reg_time = '{compact(DAY)}' AND min_reg_time < max_reg_time) AS cover,
  count(*) AS total_new
FROM reg WHERE min_reg_time = '{compact(DAY)}'
  OR (max_reg_time = '{compact(DAY)}' AND min_reg_time < max_reg_time) GROUP BY pid"""


@add("cover_users", f"SELECT pid, cover FROM ({COVER}) c")
def _(spark, sf_dir):
    return registrations.cover_users(bounds_of(today(spark, sf_dir)), DAY).drop("total_new")


@add("total_new_users", f"SELECT pid, total_new FROM ({COVER}) c")
def _(spark, sf_dir):
    return registrations.cover_users(bounds_of(today(spark, sf_dir)), DAY).drop("cover")


def _add_retention(name: str, cohort: int, days: int) -> None:
    @add(name, f"""
SELECT v.pid, count(DISTINCT v.orig_id) AS users FROM vis v
JOIN reg r ON r.pid = v.pid AND r.orig_id = v.orig_id
WHERE r.min_reg_time = '{compact(back(cohort))}'
  AND v.day BETWEEN '{back(days - 1)}' AND '{DAY}' GROUP BY v.pid""")
    def _(spark, sf_dir):
        x = week(spark, sf_dir)
        return registrations.retention(
            visits_of(x, 7), bounds_of(x), back(cohort), back(days - 1), DAY)


_add_retention("retention_day2", 1, 1)
_add_retention("retention_day7", 6, 1)
_add_retention("retention_week", 7, 7)


@add("daily_totals", totals_sql(DAY).replace(f"'{DAY}' AS day, ", "", 1))
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    return group_totals(user_profile(visits_of(x), bounds_of(x), DAY))


@add("daily_totals_next_day", totals_sql(NEXT_DAY).replace(f"'{NEXT_DAY}' AS day, ", "", 1))
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    return group_totals(user_profile(all_visits(x), bounds_of(x), NEXT_DAY))


# --- by attribute ------------------------------------------------------------------------


@add("active_by_attr", f"""
SELECT v.pid, coalesce(a.val, 'XA-NA') AS attr_value, count(DISTINCT v.orig_id) AS users
FROM vis v LEFT JOIN att a ON a.pid = v.pid AND a.orig_id = v.orig_id
WHERE v.day = '{DAY}' GROUP BY 1, 2""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    return segments.active_by_attr(visits_of(x, 1), nations_of(x), NATION, DAY)


def _add_new_by_attr(name: str, first: str) -> None:
    @add(name, f"""
SELECT r.pid, coalesce(a.val, 'XA-NA') AS attr_value, count(DISTINCT r.orig_id) AS users
FROM reg r LEFT JOIN att a ON a.pid = r.pid AND a.orig_id = r.orig_id
WHERE r.min_reg_time BETWEEN '{compact(first)}' AND '{compact(DAY)}' GROUP BY 1, 2""")
    def _(spark, sf_dir):
        x = today(spark, sf_dir)
        return segments.new_by_attr(bounds_of(x), nations_of(x), NATION, first, DAY)


_add_new_by_attr("new_by_attr", DAY)
_add_new_by_attr("new_by_attr_7d", back(6))


def _add_retention_by_attr(name: str, steps: list[tuple[int, int]]) -> None:
    per_step = [f"""
SELECT v.pid, '{back(age)}' AS reg_day, '{back(days - 1)}' AS from_day,
  coalesce(a.val, 'XA-NA') AS attr_value, count(DISTINCT v.orig_id) AS users
FROM vis v JOIN reg r ON r.pid = v.pid AND r.orig_id = v.orig_id
LEFT JOIN att a ON a.pid = v.pid AND a.orig_id = v.orig_id
WHERE r.min_reg_time = '{compact(back(age))}'
  AND v.day BETWEEN '{back(days - 1)}' AND '{DAY}' GROUP BY 1, 2, 3, 4""" for age, days in steps]

    @add(name, " UNION ALL ".join(per_step))
    def _(spark, sf_dir):
        x = week(spark, sf_dir)
        return segments.retention_by_attr(
            visits_of(x, 7), bounds_of(x), nations_of(x), NATION, DAY, steps)


_add_retention_by_attr("retention_by_attr", [(1, 1), (6, 1)])
_add_retention_by_attr("retention_week_by_attr", [(6, 6)])
_add_retention_by_attr("retention_curve_by_attr", [(k, k) for k in segments.up.LADDER_STEPS])


# --- staged relations ----------------------------------------------------------------------


@add("register_bounds", "SELECT pid, orig_id, max_reg_time, min_reg_time FROM reg")
def _(spark, sf_dir):
    return bounds_of(today(spark, sf_dir))


@add("register_bounds_combined", """
SELECT 'all' AS pid, orig_id, max(max_reg_time) AS max_reg_time,
  min(min_reg_time) AS min_reg_time FROM reg WHERE pid IN ('g1', 'g2') GROUP BY orig_id""")
def _(spark, sf_dir):
    return registrations.combine_bounds(bounds_of(today(spark, sf_dir)), ("g1", "g2"), "all")


@add("first_register", """
SELECT p.pid, d.orig_id, min(p.val) AS reg_time FROM props p
JOIN ddev d ON d.pid = p.pid AND d.uid = p.uid
WHERE p.prop = 'register_time' GROUP BY p.pid, d.orig_id""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    return registrations.first_register(x.properties, x.devices)


@add("distinct_visitors", "SELECT pid, day, orig_id FROM vis "
     f"WHERE day BETWEEN '{back(29)}' AND '{DAY}'")
def _(spark, sf_dir):
    return visits_of(month(spark, sf_dir))


@add("distinct_attributes", "SELECT pid, 'nation' AS attr, orig_id, val FROM att")
def _(spark, sf_dir):
    return nations_of(today(spark, sf_dir))


@add("week_unique_users", f"""
SELECT DISTINCT pid, orig_id FROM vis WHERE day BETWEEN '{back(6)}' AND '{DAY}'""")
def _(spark, sf_dir):
    return V.unique_users(visits_of(week(spark, sf_dir), 7), DAY, 7)


@add("register_histogram", """
SELECT pid, min_reg_time AS reg_day, count(*) AS users FROM reg
WHERE min_reg_time LIKE '202401%' GROUP BY 1, 2""")
def _(spark, sf_dir):
    return registrations.register_histogram(bounds_of(today(spark, sf_dir)), "202401")


@add("combined_group_visitors", f"""
SELECT DISTINCT day, orig_id, 'all' AS pid FROM vis WHERE pid IN ('g1', 'g2')
  AND day BETWEEN '{back(6)}' AND '{DAY}'""")
def _(spark, sf_dir):
    return V.combine_visits(visits_of(week(spark, sf_dir), 7), ("g1", "g2"), "all")


@add("retained_set", f"""
SELECT pid, orig_id FROM reg WHERE min_reg_time = '{compact(back(1))}'
INTERSECT SELECT pid, orig_id FROM vis WHERE day = '{DAY}'""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    return registrations.retained_set(visits_of(x, 1), bounds_of(x), back(1), DAY, DAY)


# --- published variants of the daily actives -----------------------------------------------


def _daily_rows(x):
    actives = V.active_users(visits_of(x, 1), DAY).withColumnRenamed("users", "dau")
    return M.total_metrics(actives, DAY, M.TOTALS[:1])


def page_views(x):
    """Page views as already stored under the daily-active keys."""
    pages = x.events.where(F.col("event").startswith("visit.") & (F.col("day") == DAY))
    counted = identity.to_groups(pages.select("pid"), x.groups).groupBy("pid").agg(
        F.count("*").alias("views"))
    rows = M.total_metrics(counted, DAY, [M.Published("views")])
    return rows.select(
        *[c for c in rows.columns if c not in ("cnt", "users")],
        F.col("users").alias("cnt"), F.lit(0).cast("bigint").alias("users"),
        F.lit(DAY).alias("run_day"), F.lit("page_views").alias("family"))


DAILY_KEY = f"',{DAY},{DAY},visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD'"


@add("active_with_pv", f"""
SELECT 'COMMON,' || pid || {DAILY_KEY} AS cache_key, '{DAY} 00:00' AS label,
  CASE WHEN pid = 'g1' THEN (SELECT count(*) FROM ev WHERE pid IN ('p0', 'p1')
    AND day = '{DAY}' AND event LIKE 'visit.%') ELSE 0 END AS cnt, users
FROM ({active_sql(DAY)}) a""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    rows = M.with_page_views(_daily_rows(x), page_views(x), "g1", DAY)
    return rows.select("cache_key", "label", "cnt", "users")


@add("category_alias", f"""
SELECT 'COMMON,all,{DAY},{DAY},visit.*,{{"category":"' || CASE pid WHEN 'g1' THEN '1' ELSE '2' END
  || '"}},VF-ALL-0-0,PERIOD' AS cache_key, '{DAY} 00:00' AS label, users
FROM ({active_sql(DAY)}) a WHERE pid IN ('g1', 'g2')""")
def _(spark, sf_dir):
    aliased = M.category_alias(_daily_rows(today(spark, sf_dir)), Settings().categories, DAY)
    return aliased.select("cache_key", "label", "users")


@add("pipeline_counters", f"""
SELECT 'events' AS source, count(*) AS read, count(*) FILTER (WHERE day = '{DAY}' AND
    (event LIKE 'visit.%' OR event LIKE 'ientheartbeat.%')) AS kept,
  count(*) FILTER (WHERE NOT (day = '{DAY}' AND
    (event LIKE 'visit.%' OR event LIKE 'ientheartbeat.%'))) AS missed FROM ev
UNION ALL SELECT 'id_map', count(*), count(orig_id), count(*) - count(orig_id) FROM idm
UNION ALL SELECT 'properties', count(*), count(*) FILTER (WHERE val <> ''),
  count(*) FILTER (WHERE val = '') FROM props""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    return counters.transform_counters(x.events, x.ids, x.properties, DAY)


# --- set rules ------------------------------------------------------------------------------

SET_RULES = """, setdev AS (
  SELECT DISTINCT pid, uid, coalesce(lower(orig_id), '***') AS orig_id FROM idm),
setvis AS (
  SELECT DISTINCT g.grp AS pid, e.day, d.orig_id
  FROM ev e JOIN setdev d ON d.pid = e.pid AND d.uid = e.uid JOIN grps g ON g.member = e.pid
  WHERE e.event LIKE 'visit.%' OR (e.event LIKE 'ientheartbeat.%' AND e.pid = 'p1'))
"""


@add("cohort_sets", SET_RULES + totals_sql(DAY, "setvis"))
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    visited = set_visits(x.events, x.ids, back(29), DAY, HEARTBEAT_PIDS)
    return cohort_totals(visited, x.ids, x.properties, x.groups, DAY)
