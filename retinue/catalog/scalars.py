"""Scalar expressions, evaluated over the whole event table or what derives from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from retinue.catalog.common import (
    DAY,
    MD5UID,
    PREFIX,
    Catalog,
    as_double,
    back,
    everything,
    found_in,
    week,
)
from retinue.catalog.searches import CUBE_DAY, cube_sql
from retinue.functions import days as D
from retinue.functions import ids as I
from retinue.functions import keys as K
from retinue.functions import paths as P
from retinue.functions.registry import register_functions
from retinue.operators import search
from retinue.operators.metrics import search_metrics

catalog = Catalog()
add = catalog.add


def _events(spark, sf_dir):
    return everything(spark, sf_dir).events


@add("fn_days_before", """
SELECT event_id, strftime(CAST(day AS DATE) - 1, '%Y-%m-%d') AS day_1,
  strftime(CAST(day AS DATE) - 30, '%Y-%m-%d') AS day_30,
  strftime(CAST(day AS DATE) - 7, '%Y%m%d') AS compact_7 FROM ev""")
def _(spark, sf_dir):
    day = F.col("day")
    return _events(spark, sf_dir).select(
        "event_id", D.days_before(day, 1).alias("day_1"), D.days_before(day, 30).alias("day_30"),
        D.days_before(day, 7, D.COMPACT).alias("compact_7"))


@add("fn_day_bounds", """
SELECT event_id, epoch_ms(CAST(day AS TIMESTAMP)) AS first_ms,
  epoch_ms(CAST(day AS TIMESTAMP)) + 86399999 AS last_ms FROM ev""")
def _(spark, sf_dir):
    day = F.col("day")
    return _events(spark, sf_dir).select(
        "event_id", D.day_start_ms(day).alias("first_ms"), D.day_end_ms(day).alias("last_ms"))


@add("fn_day_to_ms", """
SELECT event_id, epoch_ms(CAST(day AS TIMESTAMP)) AS utc_ms,
  epoch_ms(CAST(day AS TIMESTAMP)) - 28800000 AS east_8_ms FROM ev""")
def _(spark, sf_dir):
    day = F.col("day")
    return _events(spark, sf_dir).select(
        "event_id", D.day_start_ms(day).alias("utc_ms"), D.day_start_ms(day, 8).alias("east_8_ms"))


@add("fn_compact_day", "SELECT event_id, replace(day, '-', '') AS compact_day FROM ev")
def _(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return rows.select("event_id", D.compact_day(F.col("day")).alias("compact_day"))


@add("fn_expand_day", "SELECT event_id, strftime(strptime(replace(day, '-', ''), '%Y%m%d'), "
     "'%Y-%m-%d') AS day FROM ev")
def _(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return rows.select("event_id", D.expand_day(D.compact_day(F.col("day"))).alias("day"))


@add("fn_lower_substr_coalesce", """
SELECT pid, uid, lower(orig_id) AS lowered, substr(orig_id, 1, 3) AS head,
  coalesce(orig_id, 'XA-NA') AS filled, coalesce(orig_id LIKE 'DEV-1%', false) AS is_like,
  pid IN ('p0', 'p1') AS is_in FROM idm""")
def _(spark, sf_dir):
    orig = F.col("orig_id")
    return everything(spark, sf_dir).ids.select(
        "pid", "uid", I.normalise_orig_id(orig).alias("lowered"),
        F.substring(orig, 1, 3).alias("head"), F.coalesce(orig, F.lit("XA-NA")).alias("filled"),
        F.coalesce(orig.like("DEV-1%"), F.lit(False)).alias("is_like"),
        F.col("pid").isin("p0", "p1").alias("is_in"))


@add("fn_md5uid", f"""
SELECT event_id, {MD5UID.format('uid')} AS decorated, '' AS unparsable FROM ev""")
def _(spark, sf_dir):
    register_functions(spark)
    rows = _events(spark, sf_dir)
    return rows.selectExpr("event_id", "md5uid(uid) AS decorated", "md5uid(event) AS unparsable")


@add("md5uid_native", f"""
SELECT pid, uid, {MD5UID.format('uid')} AS decorated FROM usr""")
def _(spark, sf_dir):
    users = _events(spark, sf_dir).select("pid", "uid").distinct()
    return users.withColumn("decorated", I.md5uid(F.col("uid")))


@add("fn_next_prefix", """
SELECT event_id, left(event, -1) || chr(ascii(right(event, 1)) + 1) AS upper_bound,
  event >= 'pay.search2' AND event < 'pay.search3' AS in_range FROM ev""")
def _(spark, sf_dir):
    event, prefix = F.col("event"), F.lit(PREFIX)
    in_range = (event >= prefix) & (event < P.next_prefix(prefix))
    return _events(spark, sf_dir).select(
        "event_id", P.next_prefix(event).alias("upper_bound"), in_range.alias("in_range"))


def search_key_sql(first: str, last: str, label_day: str, cells: str) -> str:
    """Keys of search cube rows, spelled out independently of the library."""
    common = f"grp = '6' AND '{first}' = '{last}'"
    return f"""SELECT CASE WHEN {common} THEN 'COMMON' ELSE 'GROUP' END
    || ',g1,{first},{last},{PREFIX}.' ||
    CASE WHEN ev5 <> '*' THEN ev3 || '.' || ev4 || '.' || ev5 || '.*'
      WHEN ev4 <> '*' THEN ev3 || '.' || ev4 || '.*'
      WHEN ev3 <> '*' THEN ev3 || '.*' ELSE '*' END
    || ',' || CASE WHEN nation = '*' THEN 'TOTAL_USER' ELSE '{{"nation":"' || nation || '"}}' END
    || ',VF-ALL-0-0,' || CASE WHEN {common} THEN 'PERIOD'
      WHEN nation = '*' AND grp = '5' THEN 'USER_PROPERTIES,nation' ELSE 'EVENT,' || grp END
    AS cache_key,
  CASE WHEN grp = '6' THEN '{label_day} 00:00' ELSE grpkey END AS label, cnt, value, users
FROM ({cells}) c"""


@add("fn_metric_key", f"SELECT cache_key, label FROM "
     f"({search_key_sql(CUBE_DAY, CUBE_DAY, CUBE_DAY, cube_sql(CUBE_DAY, CUBE_DAY))}) k")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    paths = search.user_paths(found_in(x, CUBE_DAY, CUBE_DAY))
    rows = search_metrics(search.search_cube(paths), "g1", CUBE_DAY, CUBE_DAY, CUBE_DAY, PREFIX)
    return rows.select("cache_key", "label")


@add("fn_metric_key_sql", f"""
SELECT event_id, 'COMMON,' || pid || ',' || day || ',' || day
  || ',visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD' AS cache_key FROM ev""")
def _(spark, sf_dir):
    register_functions(spark)
    key = "metric_key('COMMON', pid, day, day, 'visit.*', 'TOTAL_USER', 'PERIOD') AS cache_key"
    return _events(spark, sf_dir).selectExpr("event_id", key)


@add("fn_metric_value", f"""
SELECT type, prop, cnt AS entry_count, value AS entry_value, users AS entry_users,
  1.0::DOUBLE AS entry_rate
FROM (SELECT type, prop, count(DISTINCT uid) AS users, CAST(sum(count) AS BIGINT) AS cnt,
  CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) AS value FROM typed WHERE day BETWEEN '{back(6)}' AND '{DAY}'
  GROUP BY type, prop) x""")
def _(spark, sf_dir):
    x = week(spark, sf_dir)
    typed = search.search_by_type(found_in(x, back(6), DAY))
    levels = search.by_level(typed, back(6), DAY)
    entry = K.metric_entry(F.col("cnt"), F.col("value"), F.col("users"), F.lit(1.0))
    rows = levels.select("type", "prop", entry.alias("e")).select(
        "type", "prop", F.col("e")[0].cast("bigint").alias("entry_count"),
        F.col("e")[1].alias("entry_value"), F.col("e")[2].cast("bigint").alias("entry_users"),
        F.col("e")[3].alias("entry_rate"))
    return as_double(rows, "entry_value", "entry_rate")


@add("fn_event_pattern", """
SELECT event_id, CASE WHEN e5 <> '' THEN e3 || '.' || e4 || '.' || e5 || '.*'
  WHEN e4 <> '' THEN e3 || '.' || e4 || '.*' WHEN e3 <> '' THEN e3 || '.*' ELSE '*' END AS pattern
FROM (SELECT event_id, split_part(event, '.', 3) AS e3, split_part(event, '.', 4) AS e4,
  split_part(event, '.', 5) AS e5 FROM ev) x""")
def _(spark, sf_dir):
    levels = _events(spark, sf_dir).select("event_id", *P.path_levels(F.col("event")))
    pattern = P.event_pattern(F.col("ev3"), F.col("ev4"), F.col("ev5"))
    return levels.select("event_id", pattern.alias("pattern"))
