"""Search revenue: rollups, breakdowns by level and every wildcard combination."""

from __future__ import annotations

from pyspark.sql import functions as F

from retinue.catalog.common import (
    DAY,
    PREFIX,
    Catalog,
    as_double,
    back,
    everything,
    found_in,
    month,
    week,
)
from retinue.operators import search
from retinue.settings import GRP_NONE

catalog = Catalog()
add = catalog.add

CUBE_DAY = back(1)
MEASURES = """count(DISTINCT uid) AS users, CAST(sum(count) AS BIGINT) AS cnt,
  CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value"""


def cube_sql(first: str, last: str, members: str = "") -> str:
    return f"""SELECT ev3, ev4, ev5, nation, grp, grpkey, {MEASURES} FROM wild
WHERE day BETWEEN '{first}' AND '{last}' {members} GROUP BY ALL"""


def _all_paths(x):
    return search.user_paths(found_in(x))


def _typed(x):
    return search.search_by_type(found_in(x))


@add("search_user_rollup", """
SELECT day, pid, uid, CAST(count AS BIGINT) AS count, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM roll""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    rollup = search.user_rollup(search.search_events(x.events, None, None, PREFIX))
    return as_double(rollup.drop("first_event"), "value")


@add("search_user_first_path", """
SELECT day, pid, uid, coalesce(nullif(split_part(e, '.', 3), ''), '*') AS ev3,
  coalesce(nullif(split_part(e, '.', 4), ''), '*') AS ev4,
  coalesce(nullif(split_part(e, '.', 5), ''), '*') AS ev5
FROM (SELECT day, pid, uid, arg_min(event, event) AS e FROM sev GROUP BY day, pid, uid) x""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    rollup = search.user_rollup(search.search_events(x.events, None, None, PREFIX))
    return rollup.select("day", "pid", "uid", *search.path_levels(F.col("first_event")))


@add("search_fact", """
SELECT day, uid, ev3 || ',' || ev4 || ',' || ev5 || ',' || nation AS events, count,
  CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM fact""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    fact = search.search_fact(found_in(x))
    return as_double(fact.withColumn("events", F.array_join("events", ",")), "value")


@add("merge_same_user", """
SELECT uid, CAST(1 AS BIGINT) AS users, CAST(sum(count) AS BIGINT) AS count,
  CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value FROM fact GROUP BY uid""")
def _(spark, sf_dir):
    return as_double(search.merge_same_user(_all_paths(everything(spark, sf_dir)), "uid"), "value")


@add("merge_diff_user", """
SELECT pid, ev3, count(*) AS users, CAST(sum(count) AS BIGINT) AS count,
  CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value
FROM (SELECT pid, ev3, uid, sum(count) AS count, sum(value) AS value FROM fact
  GROUP BY pid, ev3, uid) x GROUP BY pid, ev3""")
def _(spark, sf_dir):
    users = search.merge_same_user(_all_paths(everything(spark, sf_dir)), "pid", "ev3", "uid")
    return as_double(search.merge_diff_user(users, "pid", "ev3"), "value")


def _add_by_level(name: str, first: str, last: str) -> None:
    @add(name, f"""SELECT type, prop, {MEASURES} FROM typed
WHERE day BETWEEN '{first}' AND '{last}' GROUP BY type, prop""")
    def _(spark, sf_dir):
        levels = search.by_level(_typed(week(spark, sf_dir)), first, last)
        return as_double(levels, "value")


_add_by_level("search_by_level", CUBE_DAY, CUBE_DAY)
_add_by_level("search_by_level_week", back(6), back(1))


@add("search_total", f"""SELECT {MEASURES} FROM fact WHERE day = '{CUBE_DAY}'""")
def _(spark, sf_dir):
    total = search.search_total(_typed(week(spark, sf_dir)), CUBE_DAY, CUBE_DAY)
    return as_double(total, "value")


@add("search_level_reconciliation", f"""
SELECT t.type, CAST(sum(f.count) AS BIGINT) AS cnt, CAST(CAST(sum(f.value) AS VARCHAR) AS DOUBLE) AS value
FROM fact f, (VALUES ('event3'), ('event4'), ('event5'), ('nation')) t(type) GROUP BY t.type""")
def _(spark, sf_dir):
    typed = _typed(everything(spark, sf_dir))
    sums = typed.groupBy("type").agg(F.sum("count").alias("cnt"), F.sum("value").alias("value"))
    return as_double(sums, "value")


def _paths(x, first: str, last: str):
    return search.user_paths(found_in(x, first, last))


@add("search_wildcard_cube", cube_sql(CUBE_DAY, CUBE_DAY))
def search_wildcard_cube(spark, sf_dir):
    cube = search.search_cube(_paths(week(spark, sf_dir), CUBE_DAY, CUBE_DAY))
    return as_double(cube, "value")


@add("search_wildcard_cube_week", cube_sql(back(6), back(1)))
def _(spark, sf_dir):
    return as_double(search.search_cube(_paths(week(spark, sf_dir), back(6), back(1))), "value")


@add("search_wildcard_cube_month", cube_sql(back(29), DAY))
def search_wildcard_cube_month(spark, sf_dir):
    return as_double(search.search_cube(_paths(month(spark, sf_dir), back(29), DAY)), "value")


@add("search_cube_literal", cube_sql(back(6), back(1), """
  AND (day, pid, uid) NOT IN (SELECT (day, pid, uid) FROM fact
    WHERE ev3 <> '*' AND ev4 <> '*' AND ev5 <> '*' AND nation = '*')"""))
def _(spark, sf_dir):
    paths = _paths(week(spark, sf_dir), back(6), back(1))
    return as_double(search.search_cube(paths, drop_full_path_without_nation=True), "value")


@add("explode_event_groups", f"""
SELECT day, pid, uid, ev3, ev4, ev5, nation, grp, grpkey FROM wild
WHERE day BETWEEN '{back(6)}' AND '{back(1)}'""")
def _(spark, sf_dir):
    paths = _paths(week(spark, sf_dir), back(6), back(1))
    return search.explode_event_groups(paths.drop("count", "value"))


@add("search_cube_by_explode", cube_sql(back(6), back(1)))
def search_cube_by_explode(spark, sf_dir):
    cube = search.search_cube_by_explode(_paths(week(spark, sf_dir), back(6), back(1)))
    return as_double(cube, "value")


@add("search_cube_total", f"SELECT {MEASURES} FROM fact WHERE day = '{CUBE_DAY}'")
def _(spark, sf_dir):
    cube = search.search_cube(_paths(week(spark, sf_dir), CUBE_DAY, CUBE_DAY))
    free = F.lit(True)
    for d in search.DIMENSIONS:
        free = free & (F.col(d) == "*")
    total = cube.where(free & (F.col("grp") == GRP_NONE))
    return as_double(total.select("users", "cnt", "value"), "value")
