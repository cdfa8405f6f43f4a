"""Shared setup of the named queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.functions.days import shift
from retinue.operators.registrations import register_bounds
from retinue.operators.search import search_paths
from retinue.operators.segments import attributes
from retinue.operators.visits import visits
from retinue.sources import sample
from retinue.sources.sample import GROUPS, Inputs
from retinue.sources.warehouse import Warehouse, shared_dir

#: The test day, whose month is all days of events, and the next, whose month leaves one out.
DAY, NEXT_DAY = "2024-01-30", "2024-01-31"
PREFIX = "pay.search2"
HEARTBEAT_PIDS = ("p1",)

Query = Callable[[SparkSession, str], DataFrame]


def back(n: int) -> str:
    return shift(DAY, n)


class Catalog:
    """Collects queries and the SQL of those that SQL can express."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = with_views(sql)
            return query

        return register


def month(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs with the events of the thirty days ending at the test day."""
    return sample.load(spark, sf_dir, back(29), DAY)


def week(spark: SparkSession, sf_dir: str) -> Inputs:
    return sample.load(spark, sf_dir, back(6), DAY)


def today(spark: SparkSession, sf_dir: str) -> Inputs:
    return sample.load(spark, sf_dir, DAY, DAY)


def everything(spark: SparkSession, sf_dir: str) -> Inputs:
    return sample.load(spark, sf_dir)


def visits_of(x: Inputs, days: int = 30) -> DataFrame:
    return visits(x.events, x.devices, x.groups, back(days - 1), DAY)


def all_visits(x: Inputs) -> DataFrame:
    """Visits of every day of events, for queries whose own window matters."""
    return visits(x.events, x.devices, x.groups, "2024-01-01", NEXT_DAY)


def bounds_of(x: Inputs) -> DataFrame:
    return register_bounds(x.properties, x.devices, x.groups)


def nations_of(x: Inputs) -> DataFrame:
    return attributes(x.properties, x.devices, x.groups, "nation")


def found_in(x: Inputs, from_day: str | None = None, to_day: str | None = None) -> DataFrame:
    return search_paths(x.events, x.devices, x.properties, from_day, to_day, PREFIX)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def stage_text(x: Inputs, root: str) -> None:
    """Write the inputs as the tab-separated files that a deployment receives."""

    def write(df: DataFrame, table: str, *partitions: str) -> None:
        writer = df.write.partitionBy(*partitions).option("sep", "\t").option("quote", "")
        writer.option("emptyValue", "").mode("overwrite").csv(f"{root}/{table}")

    named = x.events.withColumn("p", F.col("pid"))
    write(named.select("p", "uid", "event", "value", "ts", "day", "pid"), "user_event",
          "day", "pid")
    write(x.properties.select("uid", "val", "pid", "prop"), "user_property", "pid", "prop")
    lines = x.ids.select(F.concat_ws("\t", "uid", "orig_id").alias("value"), "pid")
    lines.write.partitionBy("pid").mode("overwrite").text(f"{root}/user_id")


def new_warehouse(spark: SparkSession, raw: Inputs | None = None) -> Warehouse:
    """An empty warehouse in a new shared folder, optionally over staged text inputs."""
    root = shared_dir(spark)
    name = root.rsplit("/", 1)[1].replace("-", "_")
    warehouse = Warehouse(spark, name, f"{root}/tables")
    if raw is None:
        warehouse.create_tables()
        return warehouse
    stage_text(raw, f"{root}/raw")
    warehouse.create_tables(f"{root}/raw")
    for table in ("user_event", "user_property", "user_id"):
        warehouse.discover(table)
    return warehouse


# --- the same tables in DuckDB -------------------------------------------------------

_GROUP_ROWS = ", ".join(f"('{g}', '{m}')" for g, members in GROUPS.items() for m in members)

MD5UID = ("CAST(CAST('0x' || substr(md5({0}), 1, 2) AS BIGINT) * 4294967296"
          " + CAST({0} AS BIGINT) AS VARCHAR)")

VIEWS = f"""
WITH ev AS (
  SELECT event_id, user_id, 'p' || CAST(event_id % 5 AS VARCHAR) AS pid,
    CAST(user_id AS VARCHAR) AS uid,
    CASE event_type WHEN 'view' THEN 'visit.page' WHEN 'click' THEN 'ientheartbeat.tick'
      WHEN 'signup' THEN 'signup.done' WHEN 'error' THEN 'error.any'
    ELSE 'pay.search2' || CASE WHEN k % 5 >= 1 THEN '.s' || CAST(k % 3 AS VARCHAR) ELSE '' END
      || CASE WHEN k % 5 >= 2 THEN '.c' || CAST(k % 4 AS VARCHAR) ELSE '' END
      || CASE WHEN k % 5 >= 3 THEN '.b' || CAST(k % 2 AS VARCHAR) ELSE '' END END AS event,
    value, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts, strftime(ts, '%Y-%m-%d') AS day
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e),
usr AS (
  SELECT DISTINCT pid, uid, user_id, CAST(substr(pid, 2, 1) AS INT) AS n FROM ev),
idm AS (
  SELECT pid, uid, CASE WHEN user_id % 37 <> 36 THEN 'DEV-' || CAST(
    user_id - CASE WHEN user_id % 5 = 4 THEN 1 ELSE 0 END AS VARCHAR) END AS orig_id FROM usr),
props AS (
  SELECT pid, {MD5UID.format('uid')} AS uid, 'register_time' AS prop,
    strftime(DATE '2024-01-01' + CAST((user_id * 2654435761 + n * 40503) % 1000003 % 30 AS INT),
      '%Y%m%d') || '120000' AS val FROM usr
  UNION ALL
  SELECT pid, {MD5UID.format('uid')}, 'nation', CASE WHEN user_id % 10 = 0 THEN ''
    WHEN n = 1 AND user_id % 25 = 3 THEN 'other' ELSE lower(n_name) END
  FROM usr JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey),
grps(grp, member) AS (VALUES {_GROUP_ROWS}),
dev AS (SELECT DISTINCT pid, uid, lower(orig_id) AS orig_id FROM idm WHERE orig_id IS NOT NULL),
ddev AS (SELECT pid, {MD5UID.format('uid')} AS uid, orig_id FROM dev),
vis AS (
  SELECT DISTINCT g.grp AS pid, e.day, d.orig_id
  FROM ev e JOIN dev d ON d.pid = e.pid AND d.uid = e.uid JOIN grps g ON g.member = e.pid
  WHERE e.event LIKE 'visit.%' OR e.event LIKE 'ientheartbeat.%'),
reg AS (
  SELECT g.grp AS pid, d.orig_id, substr(max(p.val), 1, 8) AS max_reg_time,
    substr(min(p.val), 1, 8) AS min_reg_time
  FROM props p JOIN ddev d ON d.pid = p.pid AND d.uid = p.uid JOIN grps g ON g.member = p.pid
  WHERE p.prop = 'register_time' AND trim(p.val) <> '' GROUP BY g.grp, d.orig_id),
att AS (
  SELECT DISTINCT g.grp AS pid, d.orig_id, p.val
  FROM props p JOIN ddev d ON d.pid = p.pid AND d.uid = p.uid JOIN grps g ON g.member = p.pid
  WHERE p.prop = 'nation' AND trim(p.val) <> ''),
nat AS (
  SELECT pid, uid, min(val) AS nation FROM props WHERE prop = 'nation' AND trim(val) <> ''
  GROUP BY pid, uid),
sev AS (
  SELECT event_id, day, pid, uid, event, CAST(CAST(value AS VARCHAR) AS DECIMAL(38,18)) AS value
  FROM ev WHERE starts_with(event, 'pay.search2')),
roll AS (
  SELECT day, pid, uid, count(*) AS count, sum(value) AS value, min(event) AS first_event
  FROM sev GROUP BY day, pid, uid),
upath AS (
  SELECT r.day, r.pid, d.orig_id AS uid, CAST(sum(r.count) AS BIGINT) AS count,
    sum(r.value) AS value, min(r.first_event) AS first_event,
    coalesce(min(n.nation), '*') AS nation
  FROM roll r JOIN dev d ON d.pid = r.pid AND d.uid = r.uid
  LEFT JOIN nat n ON n.pid = r.pid AND n.uid = {MD5UID.format('r.uid')}
  GROUP BY r.day, r.pid, d.orig_id),
fact AS (
  SELECT day, pid, uid,
    CASE WHEN split_part(first_event, '.', 3) = '' THEN '*'
      ELSE split_part(first_event, '.', 3) END AS ev3,
    CASE WHEN split_part(first_event, '.', 4) = '' THEN '*'
      ELSE split_part(first_event, '.', 4) END AS ev4,
    CASE WHEN split_part(first_event, '.', 5) = '' THEN '*'
      ELSE split_part(first_event, '.', 5) END AS ev5,
    nation, count, value FROM upath),
typed AS (
  SELECT day, type, prop, uid, CAST(sum(count) AS BIGINT) AS count, sum(value) AS value FROM (
    SELECT s.day, d.orig_id AS uid, t.type, s.value, 1 AS count,
      CASE WHEN split_part(s.event, '.', t.part) = '' THEN 'XA-NA'
        ELSE split_part(s.event, '.', t.part) END AS prop
    FROM sev s JOIN dev d ON d.pid = s.pid AND d.uid = s.uid,
      (VALUES ('event3', 3), ('event4', 4), ('event5', 5)) t(type, part)) x
  GROUP BY day, type, prop, uid
  UNION ALL
  SELECT s.day, 'nation', coalesce(min(n.nation), 'XA-NA'), d.orig_id,
    CAST(count(*) AS BIGINT), sum(s.value)
  FROM sev s JOIN dev d ON d.pid = s.pid AND d.uid = s.uid
  LEFT JOIN nat n ON n.pid = s.pid AND n.uid = {MD5UID.format('s.uid')}
  GROUP BY s.day, d.orig_id),
picks(a, b, c, d) AS (
  SELECT a, b, c, d FROM (VALUES (0), (1)) t1(a), (VALUES (0), (1)) t2(b),
    (VALUES (0), (1)) t3(c), (VALUES (0), (1)) t4(d)),
grpcodes(grp) AS (VALUES ('2'), ('3'), ('4'), ('5'), ('6')),
wild AS (
  SELECT f.day, f.pid, f.uid, f.count, f.value,
    CASE WHEN a = 1 THEN f.ev3 ELSE '*' END AS ev3,
    CASE WHEN b = 1 THEN f.ev4 ELSE '*' END AS ev4,
    CASE WHEN c = 1 THEN f.ev5 ELSE '*' END AS ev5,
    CASE WHEN d = 1 THEN f.nation ELSE '*' END AS nation, g.grp,
    CASE g.grp WHEN '2' THEN f.ev3 WHEN '3' THEN f.ev4 WHEN '4' THEN f.ev5
      WHEN '5' THEN f.nation ELSE '-' END AS grpkey
  FROM fact f, picks, grpcodes g
  WHERE (a = 0 OR f.ev3 <> '*') AND (b = 0 OR f.ev4 <> '*') AND (c = 0 OR f.ev5 <> '*')
    AND (d = 0 OR f.nation <> '*')
    AND NOT (g.grp = '2' AND a = 1) AND NOT (g.grp = '3' AND b = 1)
    AND NOT (g.grp = '4' AND c = 1) AND NOT (g.grp = '5' AND d = 1))
"""


def with_views(body: str) -> str:
    return VIEWS + body


def totals_sql(day: str, visits_view: str = "vis", reg_view: str = "reg") -> str:
    """Whole-group metrics of one day, one independent count per metric."""
    ago = {n: shift(day, n) for n in (1, 6, 7, 29)}
    reg = {n: shift(day, n).replace("-", "") for n in (0, 1, 6, 7)}

    def active(first: str) -> str:
        return (f"(SELECT count(DISTINCT orig_id) FROM {visits_view} v WHERE v.pid = g.pid "
                f"AND v.day BETWEEN '{first}' AND '{day}')")

    def kept(cohort: str, first: str) -> str:
        return (f"(SELECT count(DISTINCT v.orig_id) FROM {visits_view} v JOIN {reg_view} r "
                "ON r.pid = v.pid AND r.orig_id = v.orig_id WHERE v.pid = g.pid "
                f"AND r.min_reg_time = '{cohort}' AND v.day BETWEEN '{first}' AND '{day}')")

    new = (f"(SELECT count(DISTINCT orig_id) FROM {reg_view} r WHERE r.pid = g.pid "
           f"AND r.min_reg_time = '{reg[0]}')")
    cover = (f"(SELECT count(DISTINCT orig_id) FROM {reg_view} r WHERE r.pid = g.pid "
             f"AND r.max_reg_time = '{reg[0]}' AND r.min_reg_time < r.max_reg_time)")
    return f"""SELECT '{day}' AS day, g.pid, {active(day)} AS dau, {active(ago[6])} AS wau,
      {active(ago[29])} AS mau, {new} AS new_users, {cover} AS cover_users,
      {new} + {cover} AS total_new, {kept(reg[1], day)} AS ret_day2,
      {kept(reg[6], day)} AS ret_day7, {kept(reg[7], ago[6])} AS ret_week
      FROM (SELECT DISTINCT grp AS pid FROM grps) g"""
