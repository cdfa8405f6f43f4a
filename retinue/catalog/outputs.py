"""Sinks, each written and read back, and the jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from retinue.catalog.common import (
    DAY,
    HEARTBEAT_PIDS,
    MD5UID,
    PREFIX,
    Catalog,
    as_double,
    back,
    bounds_of,
    everything,
    found_in,
    month,
    nations_of,
    new_warehouse,
    today,
    totals_sql,
    visits_of,
    week,
)
from retinue.catalog.inputs import TOTAL_ROWS, total_rows_sql
from retinue.catalog.scalars import search_key_sql
from retinue.catalog.searches import CUBE_DAY, cube_sql
from retinue.catalog.users import SET_RULES, active_sql, page_views
from retinue.functions.days import compact, shift
from retinue.operators import history, search
from retinue.operators import metrics as M
from retinue.operators.profile import group_totals, user_profile
from retinue.operators.visits import visits
from retinue.plans.daily import run_daily, stage_devices, write_visits
from retinue.plans.history import republish as republish_job
from retinue.plans.history import publish_history, run_history
from retinue.plans.search import run_search, run_search_levels, stage_search
from retinue.settings import Settings
from retinue.sources import sample, store
from retinue.sources.warehouse import shared_dir

catalog = Catalog()
add = catalog.add
GROUP_NAMES = ("g1", "g2", "all")
SETTINGS = Settings()


@add("write_visit", f"""
SELECT pid, day, orig_id FROM vis WHERE day BETWEEN '{back(6)}' AND '{DAY}'""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    warehouse = new_warehouse(spark)
    warehouse.overwrite("user_visit", visits_of(x, 7))
    today_only = visits_of(x, 1).drop("day")
    warehouse.overwrite("user_visit", today_only, day=DAY)
    return warehouse.table("user_visit")


@add("write_register_time", "SELECT pid, orig_id, max_reg_time, min_reg_time FROM reg")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark)
    bounds = bounds_of(today(spark, sf_dir))
    for _run in range(2):
        warehouse.overwrite("user_register_time", bounds)
    return warehouse.table("user_register_time")


@add("write_attribute", "SELECT pid, 'nation' AS attr, orig_id, val FROM att")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark)
    values = nations_of(today(spark, sf_dir)).drop("attr")
    warehouse.overwrite("user_attribute", values, attr="nation")
    return warehouse.table("user_attribute")


def _totals(x):
    return group_totals(user_profile(visits_of(x), bounds_of(x), DAY))


@add("publish_metrics", TOTAL_ROWS)
def _(spark, sf_dir):
    rows = M.total_metrics(_totals(month(spark, sf_dir)), DAY)
    warehouse = new_warehouse(spark)
    stale = rows.withColumn("users", F.col("users") + 1)
    store.publish(warehouse, stale, back(1), "users")
    for _run in range(2):
        store.publish(warehouse, rows, DAY, "users")
    current = M.current_metrics(warehouse.table("metrics"))
    return current.select("cache_key", "label", "users")


@add("export_metrics_json", f"""
SELECT '{{"' || replace(cache_key, '"', '\\"') || '":{{"' || label || '":[0,0,'
  || users || ',1]}}}}' AS document FROM ({TOTAL_ROWS}) t""")
def _(spark, sf_dir):
    path = store.export_json(
        M.total_metrics(_totals(month(spark, sf_dir)), DAY), shared_dir(spark), DAY, "users")
    return spark.read.schema("document string").text(path)


@add("write_search_fact", f"""
SELECT '{compact(CUBE_DAY)}' AS day, uid, ev3 || ',' || ev4 || ',' || ev5 || ',' || nation
  AS events, count, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM fact WHERE day = '{CUBE_DAY}'""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    warehouse = new_warehouse(spark)
    fact = search.search_fact(found_in(x, CUBE_DAY, CUBE_DAY))
    warehouse.overwrite("user_search", fact.drop("day"), day=compact(CUBE_DAY))
    stored = warehouse.table("user_search")
    return as_double(stored.withColumn("events", F.array_join("events", ",")), "value")


@add("write_search_by_type", """
SELECT replace(day, '-', '') AS day, type, uid, prop, CAST(1 AS BIGINT) AS num, count,
  CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM typed""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    warehouse = new_warehouse(spark)
    typed = search.search_by_type(found_in(x))
    stored_day = F.replace("day", F.lit("-"), F.lit(""))
    warehouse.overwrite("user_search_by_type", typed.withColumn("day", stored_day))
    return as_double(warehouse.table("user_search_by_type"), "value")


HISTORY_DAYS = (back(2), back(1), DAY)


def _history(spark, sf_dir):
    x = everything(spark, sf_dir)
    rows = visits(x.events, x.devices, x.groups, shift(HISTORY_DAYS[0], 29), DAY)
    bounds = bounds_of(x)
    per_day = [
        group_totals(user_profile(rows, bounds, d)).select(F.lit(d).alias("day"), "*")
        for d in HISTORY_DAYS
    ]
    totals = per_day[0].unionByName(per_day[1]).unionByName(per_day[2])
    return history.newest(history.history_row(totals, GROUP_NAMES))


def _history_sql(visits_view: str = "vis") -> str:
    per_day = " UNION ALL ".join(f"({totals_sql(d, visits_view)})" for d in HISTORY_DAYS)
    columns = ", ".join(
        f"CAST(max({m}) FILTER (WHERE pid = '{g}') AS BIGINT) AS \"{m}_{g}\""
        for m in history.HISTORY_METRICS for g in GROUP_NAMES)
    return f"SELECT day, {columns} FROM ({per_day}) t GROUP BY day"


@add("daily_history_row", _history_sql())
def _(spark, sf_dir):
    return _history(spark, sf_dir)


@add("reload_history_row", " UNION ALL ".join(
    f"SELECT '{DAY}' AS day, pid, '{m}' AS metric, CAST({m} AS BIGINT) AS users "
    f"FROM ({totals_sql(DAY)}) t WHERE pid IN ('g1', 'g2', 'all')"
    for m in history.HISTORY_METRICS))
def _(spark, sf_dir):
    return history.unpivot_newest(_history(spark, sf_dir), GROUP_NAMES)


RESET_KEYS = f"""(VALUES
  ('GROUP,g1,{DAY},{DAY},pay.search2.*,TOTAL_USER,VF-ALL-0-0,EVENT,2', 'null'),
  ('GROUP,g1,{DAY},{DAY},pay.search2.*,TOTAL_USER,VF-ALL-0-0,EVENT,3', 'null'),
  ('GROUP,g1,{DAY},{DAY},pay.search2.*,TOTAL_USER,VF-ALL-0-0,EVENT,4', 'null'),
  ('GROUP,g1,{DAY},{DAY},pay.search2.*,TOTAL_USER,VF-ALL-0-0,USER_PROPERTIES,nation', 'null'),
  ('COMMON,g1,{DAY},{DAY},pay.search2.*,TOTAL_USER,VF-ALL-0-0,PERIOD', '{DAY} 00:00'))"""
CUBE_KEYS = search_key_sql(CUBE_DAY, CUBE_DAY, CUBE_DAY, cube_sql(CUBE_DAY, CUBE_DAY))


@add("reset_day_metrics", f"""
SELECT cache_key, label, cnt, value, users FROM ({CUBE_KEYS}) k
UNION ALL SELECT z.k, z.l, 0, 0.0, 0 FROM {RESET_KEYS} z(k, l)""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    paths = search.user_paths(found_in(x, CUBE_DAY, CUBE_DAY))
    rows = M.search_metrics(
        search.search_cube(paths), "g1", CUBE_DAY, CUBE_DAY, CUBE_DAY, PREFIX)
    merged = M.reset_then(rows, M.reset_rows(spark, "g1", DAY, PREFIX))
    return as_double(merged.select("cache_key", "label", "cnt", "value", "users"), "value")


@add("merge_metric_sets", f"""
SELECT cache_key, label, users + 1 AS users FROM ({TOTAL_ROWS}) t WHERE cache_key LIKE '%,g1,%'
UNION ALL SELECT cache_key, label, users FROM ({TOTAL_ROWS}) t
  WHERE cache_key NOT LIKE '%,g1,%'""")
def _(spark, sf_dir):
    rows = M.total_metrics(_totals(month(spark, sf_dir)), DAY)
    corrected = rows.where(F.col("project") == "g1").withColumn("users", F.col("users") + 1)
    return M.merge_metric_sets(rows, corrected).select("cache_key", "label", "users")


@add("expire_metrics", f"""
SELECT pid, day, count(*) AS users FROM vis WHERE day >= '{back(10)}' AND day <= '{DAY}'
GROUP BY pid, day""")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark)
    warehouse.overwrite("user_visit", visits_of(month(spark, sf_dir)))
    warehouse.expire("user_visit", DAY, keep_days=10)
    return warehouse.table("user_visit").groupBy("pid", "day").agg(F.count("*").alias("users"))


# --- jobs ------------------------------------------------------------------------------------


def _config(x):
    """The configured groups; the roll-up group is the job's to add."""
    return x.groups.where(F.col("grp") != "all")


def _daily_run(spark, sf_dir):
    x = month(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    groups = _config(x)
    stage_devices(warehouse, ["p0", "p1", "p2", "p3", "p4"])
    write_visits(warehouse, groups, SETTINGS, back(29), back(1))
    store.publish(warehouse, page_views(x), DAY, "page_views")
    root = shared_dir(spark)
    return warehouse, root, run_daily(warehouse, groups, SETTINGS, DAY, root)


def _cohort(first: str, last: str | None = None) -> str:
    return f'"register_time":{{"$gte":"{first}","$lte":"{last or first}"}}'


# (segment filters, first key day, label of COMMON or '', GROUP?, cohort days, visit window start)
_BY_ATTR = [
    ("", DAY, DAY, True, None, DAY),
    (_cohort(DAY), DAY, DAY, True, (DAY, DAY), None),
    (_cohort(back(6), DAY), back(6), "", True, (back(6), DAY), None),
    (_cohort(back(1)), DAY, back(1), True, (back(1), back(1)), DAY),
    (_cohort(back(6)), DAY, back(6), True, (back(6), back(6)), DAY),
    (_cohort(back(6)), back(5), back(5), True, (back(6), back(6)), back(5)),
    (_cohort(back(5)), back(4), "", True, (back(5), back(5)), back(4)),
    (_cohort(back(4)), back(3), "", True, (back(4), back(4)), back(3)),
    (_cohort(back(3)), back(2), "", True, (back(3), back(3)), back(2)),
    (_cohort(back(2)), back(2), "", True, (back(2), back(2)), back(1)),
]


def _daily_sql() -> str:
    parts = [f"""SELECT cache_key, label,
      CASE WHEN cache_key = 'COMMON,g1,{DAY},{DAY},visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD'
        THEN pv.views ELSE 0 END AS cnt, users FROM ({TOTAL_ROWS}) t, pv"""]
    parts.append(f"""SELECT 'COMMON,all,{DAY},{DAY},visit.*,{{"category":"' ||
      CASE pid WHEN 'g1' THEN '1' ELSE '2' END || '"}},VF-ALL-0-0,PERIOD', '{DAY} 00:00',
      CASE pid WHEN 'g1' THEN pv.views ELSE 0 END, users
      FROM ({active_sql(DAY)}) a, pv WHERE pid IN ('g1', 'g2')""")
    for event, column in (("int1cover", "cover_users"), ("int1totalnew", "total_new")):
        parts.append(f"""SELECT 'COMMON,g1,{DAY},{DAY},{event}.*,{{{_cohort(DAY)}}},'
          || 'VF-ALL-0-0,PERIOD', '{DAY} 00:00', 0, {column} FROM ({totals_sql(DAY)}) t
          WHERE pid = 'g1'""")
    for filters, first, label, group, cohort, seen_from in _BY_ATTR:
        users = "vis" if cohort is None else "reg"
        where = f"u.pid = 'g1' AND u.day = '{DAY}'"
        if cohort:
            where = (f"u.pid = 'g1' AND u.min_reg_time BETWEEN '{compact(cohort[0])}' "
                     f"AND '{compact(cohort[1])}'")
            if seen_from:
                where += (f" AND u.orig_id IN (SELECT orig_id FROM vis WHERE pid = 'g1' "
                          f"AND day BETWEEN '{seen_from}' AND '{DAY}')")
        counts = f"""SELECT coalesce(a.val, 'XA-NA') AS v, count(DISTINCT u.orig_id) AS n
          FROM {users} u LEFT JOIN att a ON a.pid = u.pid AND a.orig_id = u.orig_id
          WHERE {where} GROUP BY 1"""
        prefix = f"g1,{first},{DAY},visit.*,"
        if label:
            extra = "," + filters if filters else ""
            parts.append(f"""SELECT 'COMMON,{prefix}{{"nation":"' || v || '"{extra}}},VF-ALL-0-0,'
              || 'PERIOD', '{label} 00:00', 0, n FROM ({counts}) c""")
        if group:
            total = "{" + filters + "}" if filters else "TOTAL_USER"
            parts.append(f"""SELECT 'GROUP,{prefix}{total},VF-ALL-0-0,USER_PROPERTIES,nation',
              v, 0, n FROM ({counts}) c""")
    views = f""", pv AS (SELECT count(*) AS views FROM ev WHERE pid IN ('p0', 'p1')
      AND day = '{DAY}' AND event LIKE 'visit.%')"""
    return views + " UNION ALL ".join(parts)


@add("daily_user_metrics", _daily_sql())
def _(spark, sf_dir):
    _warehouse, _root, published = _daily_run(spark, sf_dir)
    return published.select("cache_key", "label", "cnt", "users")


@add("republish", _daily_sql())
def _(spark, sf_dir):
    warehouse, root, published = _daily_run(spark, sf_dir)
    store.publish(warehouse, spark.createDataFrame([], published.schema), DAY, "users")
    again = republish_job(warehouse, root, DAY, "users")
    return again.select("cache_key", "label", "cnt", "users")


@add("run_counters", """
SELECT 'events' AS source, count(*) AS read, count(*) FILTER (WHERE
    event LIKE 'visit.%' OR event LIKE 'ientheartbeat.%') AS kept,
  count(*) FILTER (WHERE NOT (event LIKE 'visit.%' OR event LIKE 'ientheartbeat.%')) AS missed
FROM ev WHERE day = '""" + DAY + """'
UNION ALL SELECT 'id_map', count(*), count(orig_id), count(*) - count(orig_id) FROM idm
UNION ALL SELECT 'property ' || prop, count(*), count(*) FILTER (WHERE val <> ''),
  count(*) FILTER (WHERE val = '') FROM props GROUP BY prop""")
def _(spark, sf_dir):
    warehouse, _, _ = _daily_run(spark, sf_dir)
    return warehouse.table("run_counters").where(F.col("run_day") == DAY).drop("run_day")


@add("history_job", SET_RULES + f"SELECT * FROM ({_history_sql('setvis')}) h")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark, everything(spark, sf_dir))
    groups = sample.groups(spark)
    for day in HISTORY_DAYS:
        newest = run_history(warehouse, groups, GROUP_NAMES, day, HEARTBEAT_PIDS)
    return newest


@add("publish_history", SET_RULES + f"""SELECT cache_key, label, users
FROM ({total_rows_sql('setvis')}) t WHERE cache_key NOT LIKE 'COMMON,g3,%'""")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark, everything(spark, sf_dir))
    run_history(warehouse, sample.groups(spark), GROUP_NAMES, DAY, HEARTBEAT_PIDS)
    return publish_history(warehouse, GROUP_NAMES, DAY).select("cache_key", "label", "users")


IN_G1 = "AND pid IN ('p0', 'p1')"


@add("search_stage", f"""
SELECT '{compact(CUBE_DAY)}' AS day, uid, ev3 || ',' || ev4 || ',' || ev5 || ',' || nation
  AS events, count, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM fact WHERE day = '{CUBE_DAY}' {IN_G1}""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    stage_search(warehouse, _config(x), SETTINGS, DAY)
    stored = warehouse.table("user_search")
    return as_double(stored.withColumn("events", F.array_join("events", ",")), "value")


@add("search_metrics", search_key_sql(
    CUBE_DAY, CUBE_DAY, CUBE_DAY, cube_sql(CUBE_DAY, CUBE_DAY, IN_G1)))
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    stage_search(warehouse, _config(x), SETTINGS, DAY)
    rows = run_search(warehouse, SETTINGS, DAY, "day")
    return as_double(rows.select("cache_key", "label", "cnt", "value", "users"), "value")


@add("search_metrics_week", search_key_sql(
    back(6), DAY, back(1), cube_sql(back(6), back(1), IN_G1)))
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    for n in range(5, -1, -1):
        stage_search(warehouse, _config(x), SETTINGS, back(n))
    rows = run_search(warehouse, SETTINGS, DAY, "week")
    return as_double(rows.select("cache_key", "label", "cnt", "value", "users"), "value")


def _level_sql(first: str, last: str, end: str, kinds: str) -> str:
    """Level breakdown of a period; COMMON rows filter by a value, GROUP rows list it."""
    return f"""SELECT CASE k.kind WHEN 'COMMON' THEN 'COMMON,g1,{first},{end},{PREFIX}.' || CASE type
      WHEN 'event3' THEN prop || '.*' WHEN 'event4' THEN '*.' || prop || '.*'
      WHEN 'event5' THEN '*.*.' || prop || '.*' ELSE '*' END || ','
      || CASE type WHEN 'nation' THEN '{{"nation":"' || prop || '"}}' ELSE 'TOTAL_USER' END
      || ',VF-ALL-0-0,PERIOD'
    ELSE 'GROUP,g1,{first},{end},{PREFIX}.*,TOTAL_USER,VF-ALL-0-0,' || CASE type
      WHEN 'event3' THEN 'EVENT,2' WHEN 'event4' THEN 'EVENT,3' WHEN 'event5' THEN 'EVENT,4'
      ELSE 'USER_PROPERTIES,nation' END END AS cache_key,
  CASE k.kind WHEN 'COMMON' THEN '{CUBE_DAY} 00:00' ELSE prop END AS label,
  CAST(sum(count) AS BIGINT) AS cnt, CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value,
  count(DISTINCT uid) AS users
FROM g1_typed, (VALUES {kinds}) k(kind) WHERE day BETWEEN '{first}' AND '{last}'
GROUP BY k.kind, type, prop"""


# The breakdown by type restricted to the sub-projects of the search group.
G1_TYPED = """, g1_sev AS (SELECT * FROM sev WHERE pid IN ('p0', 'p1')),
g1_typed AS (
  SELECT day, type, prop, uid, CAST(sum(count) AS BIGINT) AS count, sum(value) AS value FROM (
    SELECT s.day, d.orig_id AS uid, t.type, s.value, 1 AS count,
      coalesce(nullif(split_part(s.event, '.', t.part), ''), 'XA-NA') AS prop
    FROM g1_sev s JOIN dev d ON d.pid = s.pid AND d.uid = s.uid,
      (VALUES ('event3', 3), ('event4', 4), ('event5', 5)) t(type, part)) x
  GROUP BY day, type, prop, uid
  UNION ALL
  SELECT s.day, 'nation', coalesce(min(n.nation), 'XA-NA'), d.orig_id,
    CAST(count(*) AS BIGINT), sum(s.value)
  FROM g1_sev s JOIN dev d ON d.pid = s.pid AND d.uid = s.uid
  LEFT JOIN nat n ON n.pid = s.pid AND n.uid = """ + MD5UID.format("s.uid") + """
  GROUP BY s.day, d.orig_id)
"""


@add("search_level_metrics", G1_TYPED + f"""
SELECT 'COMMON,g1,{CUBE_DAY},{CUBE_DAY},{PREFIX}.*,TOTAL_USER,VF-ALL-0-0,PERIOD' AS cache_key,
  '{CUBE_DAY} 00:00' AS label, CAST(sum(count) AS BIGINT) AS cnt,
  CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value, count(DISTINCT uid) AS users
FROM g1_typed WHERE day = '{CUBE_DAY}' AND type = 'nation'
UNION ALL ({_level_sql(CUBE_DAY, CUBE_DAY, CUBE_DAY, "('COMMON'), ('GROUP')")})
UNION ALL ({_level_sql(back(6), CUBE_DAY, DAY, "('GROUP')")})""")
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    for n in range(5, -1, -1):
        stage_search(warehouse, _config(x), SETTINGS, back(n))
    rows = run_search_levels(warehouse, SETTINGS, DAY)
    return as_double(rows.select("cache_key", "label", "cnt", "value", "users"), "value")


@add("search_metrics_reset", f"""
SELECT * FROM ({search_key_sql(CUBE_DAY, CUBE_DAY, CUBE_DAY,
                               cube_sql(CUBE_DAY, CUBE_DAY, IN_G1))}) k
UNION ALL SELECT z.k, z.l, 0, 0.0, 0 FROM {RESET_KEYS} z(k, l)""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    warehouse = new_warehouse(spark, x)
    stage_search(warehouse, _config(x), SETTINGS, DAY)
    rows = run_search(warehouse, SETTINGS, DAY, "day", today=shift(DAY, -1))
    return as_double(rows.select("cache_key", "label", "cnt", "value", "users"), "value")
