"""Sources and the filters that sit on them."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.catalog.common import (
    DAY,
    GROUPS,
    HEARTBEAT_PIDS,
    PREFIX,
    Catalog,
    as_double,
    back,
    bounds_of,
    everything,
    found_in,
    month,
    new_warehouse,
    stage_text,
    today,
    totals_sql,
    visits_of,
)
from retinue.functions import ids as I
from retinue.functions import paths as P
from retinue.functions.days import compact
from retinue.operators import identity, metrics, search
from retinue.operators.profile import group_totals, user_profile
from retinue.operators.visits import in_day_range, is_visit
from retinue.settings import UNKNOWN_VALUE, UNMAPPED_ID
from retinue.sources import logs, store
from retinue.sources.warehouse import shared_dir

catalog = Catalog()
add = catalog.add
G1 = GROUPS["g1"]


# --- sources ------------------------------------------------------------------------


@add("scan_events", f"""
SELECT pid, uid, event, value, ts, day FROM ev
WHERE day = '{DAY}' AND pid IN ('p0', 'p1')""")
def _(spark, sf_dir):
    root = shared_dir(spark)
    stage_text(everything(spark, sf_dir), root)
    return as_double(logs.read_events(spark, f"{root}/user_event", DAY, G1).drop("p"), "value")


@add("scan_properties", """
SELECT pid, uid, val FROM props WHERE prop = 'nation' AND pid IN ('p0', 'p1') AND val <> ''""")
def _(spark, sf_dir):
    root = shared_dir(spark)
    stage_text(today(spark, sf_dir), root)
    rows = logs.read_properties(spark, f"{root}/user_property", "nation", G1)
    return rows.where(I.is_filled(F.col("val"))).drop("prop")


@add("scan_id_map", "SELECT pid, uid, coalesce(orig_id, '***') AS orig_id FROM idm")
def _(spark, sf_dir):
    root = shared_dir(spark)
    stage_text(today(spark, sf_dir), root)
    return logs.read_id_map(spark, f"{root}/user_id").na.fill(UNMAPPED_ID, "orig_id")


@add("scan_search_events", f"""
SELECT event_id, day, pid, uid, event, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM sev
WHERE day = '{DAY}'""")
def _(spark, sf_dir):
    rows = search.search_events(today(spark, sf_dir).events, DAY, DAY, PREFIX)
    return as_double(rows.select("event_id", "day", "pid", "uid", "event", "value"), "value")


@add("scan_search_fact", f"""
SELECT replace(day, '-', '') AS day, uid, ev3, ev4, ev5, nation, count,
  CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value
FROM fact WHERE day BETWEEN '{back(6)}' AND '{back(1)}'""")
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    warehouse = new_warehouse(spark)
    fact = search.search_fact(found_in(x, back(29), DAY))
    stored = fact.withColumn("day", F.replace("day", F.lit("-"), F.lit("")))
    warehouse.overwrite("user_search", stored)
    first, last = compact(back(6)), compact(back(1))
    return as_double(search.fact_paths(warehouse.table("user_search"), first, last), "value")


@add("project_members", """
SELECT g.grp, g.member, count(*) AS events FROM grps g JOIN ev ON ev.pid = g.member
GROUP BY g.grp, g.member""")
def _(spark, sf_dir):
    path = f"{shared_dir(spark)}/groups"
    config = [
        {"project": g, "members": ",".join(f"{m}:on" for m in ms)} for g, ms in GROUPS.items()
    ]
    text = spark.createDataFrame([(json.dumps(config),)], "value string")
    text.write.text(path)
    members = logs.read_groups(spark, path)
    events = everything(spark, sf_dir).events.groupBy("pid").agg(F.count("*").alias("events"))
    return members.join(events, members.member == events.pid).drop("pid")


@add("lookup_dimension", f"""
SELECT pid, uid, orig_id FROM dev
WHERE (pid, uid) IN (SELECT (pid, uid) FROM sev WHERE day = '{DAY}')""")
def _(spark, sf_dir):
    x = today(spark, sf_dir)
    keys = search.search_events(x.events, DAY, DAY, PREFIX)
    return logs.lookup(keys, x.devices, ["pid", "uid"])


@add("scan_last_n_days", " UNION ALL ".join(
    f"SELECT '{n}' AS window_days, count(*) AS events, count(DISTINCT day) AS days FROM ev "
    f"WHERE day BETWEEN '{back(n - 1)}' AND '{DAY}'" for n in (1, 7, 30)))
def _(spark, sf_dir):
    per_day = month(spark, sf_dir).events.groupBy("day").agg(F.count("*").alias("events"))
    windows = F.inline(F.array(*[
        F.struct(F.lit(str(n)).alias("window_days"),
                 logs.last_n_days(F.col("day"), DAY, n).alias("inside"))
        for n in (1, 7, 30)
    ]))
    return (
        per_day.select("day", "events", windows).where("inside").groupBy("window_days")
        .agg(F.sum("events").alias("events"), F.count("*").alias("days"))
    )


def _total_rows(spark, sf_dir, day=DAY):
    x = month(spark, sf_dir)
    totals = group_totals(user_profile(visits_of(x), bounds_of(x), day))
    return metrics.total_metrics(totals, day)


def total_rows_sql(visits_view: str = "vis") -> str:
    return f"""
SELECT 'COMMON,' || pid || ',' || s.first || ',{DAY},visit.*,' || s.segment
  || ',VF-ALL-0-0,PERIOD' AS cache_key, '{DAY} 00:00' AS label, CAST(s.users AS BIGINT) AS users
FROM ({totals_sql(DAY, visits_view)}) t, LATERAL (VALUES
  ('{DAY}', 'TOTAL_USER', dau), ('{back(7)}', 'TOTAL_USER', wau),
  ('{back(30)}', 'TOTAL_USER', mau),
  ('{DAY}', '{{"register_time":{{"$gte":"{DAY}","$lte":"{DAY}"}}}}', new_users),
  ('{DAY}', '{{"register_time":{{"$gte":"{back(1)}","$lte":"{back(1)}"}}}}', ret_day2),
  ('{DAY}', '{{"register_time":{{"$gte":"{back(6)}","$lte":"{back(6)}"}}}}', ret_day7),
  ('{back(6)}', '{{"register_time":{{"$gte":"{back(7)}","$lte":"{back(7)}"}}}}', ret_week)
) s(first, segment, users)"""


TOTAL_ROWS = total_rows_sql()


@add("reload_metrics", TOTAL_ROWS)
def _(spark, sf_dir):
    root = shared_dir(spark)
    store.export_json(_total_rows(spark, sf_dir), root, DAY, "users")
    return store.reload_json(spark, root, DAY, "users").select("cache_key", "label", "users")


@add("read_previous_metric", f"""
SELECT DISTINCT 'COMMON,' || g.grp || ',' || d.day || ',' || d.day
    || ',visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD' AS cache_key,
  (SELECT count(*) FROM ev e JOIN grps m ON m.member = e.pid
   WHERE m.grp = g.grp AND e.day = d.day AND d.day < '{DAY}' AND e.event LIKE 'visit.%')
    AS stored_cnt
FROM grps g, (SELECT DISTINCT day FROM ev WHERE day <= '{DAY}') d""")
def _(spark, sf_dir):
    x = month(spark, sf_dir)
    key = F.concat(F.lit("COMMON,"), "pid", F.lit(","), "day", F.lit(","), "day",
                   F.lit(",visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD")).alias("cache_key")
    grouped = identity.to_groups(x.events.select("pid", "day", "event"), x.groups)
    views = grouped.groupBy("pid", "day").agg(
        F.count_if(F.col("event").startswith("visit.")).alias("cnt"))
    stored = views.where(F.col("day") < DAY).select(
        key, "cnt", F.col("day").alias("run_day"), F.lit("x").alias("label"),
        F.lit("page_views").alias("family"))
    return metrics.previous_counts(views.select(key), stored)


@add("discover_partitions", """
SELECT DISTINCT 'day=' || day || '/pid=' || pid AS partition FROM ev""")
def _(spark, sf_dir):
    warehouse = new_warehouse(spark, everything(spark, sf_dir))
    return warehouse.discover("user_event")


@add("init_schemas", """
SELECT 'user_event' AS source, pid, count(*) AS stored FROM ev GROUP BY pid
UNION ALL SELECT 'user_property', pid, count(*) FROM props GROUP BY pid
UNION ALL SELECT 'user_id', pid, count(*) FROM idm GROUP BY pid""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    warehouse = new_warehouse(spark)
    tables = {"user_event": x.events.withColumn("p", F.col("pid")),
              "user_property": x.properties, "user_id": x.ids}
    for table, rows in tables.items():
        warehouse.overwrite_found(table, rows)
    warehouse.create_tables()  # again: what is stored and registered stays
    counts = [warehouse.table(t).groupBy(F.lit(t).alias("source"), "pid").agg(
        F.count("*").alias("stored")) for t in tables]
    return reduce(DataFrame.unionByName, counts)


def _put_foreign_file(spark, folder: str) -> None:
    """A file beside the part files, which no reader may take for one of them."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/notes.txt")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.writeBytes("999999\tDEV-999999\n")
    out.close()


@add("only_part_files", "SELECT pid, count(DISTINCT orig_id) AS ids FROM dev GROUP BY pid")
def _(spark, sf_dir):
    root = shared_dir(spark)
    stage_text(today(spark, sf_dir), root)
    _put_foreign_file(spark, f"{root}/user_id/pid=p0")
    lines = logs.read_id_map(spark, f"{root}/user_id")
    return identity.device_ids(lines).groupBy("pid").agg(
        F.count_distinct("orig_id").alias("ids"))


# --- filters and projections -----------------------------------------------------------


@add("visit_filter", """
SELECT event_id, pid, event FROM ev
WHERE event LIKE 'visit.%' OR event LIKE 'ientheartbeat.%'""")
def _(spark, sf_dir):
    return everything(spark, sf_dir).events.where(is_visit()).select("event_id", "pid", "event")


@add("visit_filter_per_project", """
SELECT event_id, pid, event FROM ev
WHERE (event LIKE 'visit.%' OR (event LIKE 'ientheartbeat.%' AND pid = 'p1')) AND ts <> ''""")
def _(spark, sf_dir):
    rows = everything(spark, sf_dir).events.where(is_visit(HEARTBEAT_PIDS))
    return rows.where(I.is_filled(F.col("ts"))).select("event_id", "pid", "event")


@add("day_range_filter", f"""
SELECT event_id, ts FROM ev
WHERE CAST(ts AS BIGINT) >= epoch_ms(DATE '{back(6)}')
  AND CAST(ts AS BIGINT) < epoch_ms(DATE '{DAY}' + 1)""")
def _(spark, sf_dir):
    events = everything(spark, sf_dir).events
    return events.where(in_day_range(back(6), DAY)).select("event_id", "ts")


@add("pid_in_group", """
SELECT event_id, pid FROM ev WHERE pid IN (SELECT member FROM grps WHERE grp = 'g1')""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    g1 = x.groups.where(F.col("grp") == "g1")
    return identity.in_any_group(x.events, g1).select("event_id", "pid")


@add("non_blank_rows", "SELECT pid, uid, prop, val FROM props WHERE trim(val) <> ''")
def _(spark, sf_dir):
    rows = today(spark, sf_dir).properties
    return identity.filled_properties(rows, "register_time", "nation")


@add("parse_event_path", """
SELECT event_id, ev3, ev4, ev5, CASE WHEN ev3 = '*' THEN 'XA-NA' ELSE ev3 END AS level3,
  CASE WHEN ev4 = '*' THEN 'XA-NA' ELSE ev4 END AS level4,
  CASE WHEN ev5 = '*' THEN 'XA-NA' ELSE ev5 END AS level5
FROM (SELECT event_id,
  coalesce(nullif(split_part(event, '.', 3), ''), '*') AS ev3,
  coalesce(nullif(split_part(event, '.', 4), ''), '*') AS ev4,
  coalesce(nullif(split_part(event, '.', 5), ''), '*') AS ev5 FROM ev) x""")
def _(spark, sf_dir):
    event = F.col("event")
    named = [P.level(event, i, UNKNOWN_VALUE).alias(f"level{i + 1}") for i in (2, 3, 4)]
    return everything(spark, sf_dir).events.select("event_id", *P.path_levels(event), *named)


@add("decode_row_key", f"""
SELECT event_id, replace(day, '-', '') AS day, event,
  CAST(CAST('0x' || substr(md5(uid), 1, 2) AS BIGINT) * 4294967296 + user_id AS BIGINT) AS uid
FROM ev WHERE starts_with(event, '{PREFIX}')""")
def _(spark, sf_dir):
    rows = everything(spark, sf_dir).events.where(F.col("event").startswith(PREFIX))
    day = F.replace("day", F.lit("-"), F.lit(""))
    key = I.search_row_key(day, F.col("event"), I.md5uid(F.col("uid")))
    return rows.select("event_id", I.decode_row_key(key).alias("k")).select("event_id", "k.*")


@add("truncate_uid", "SELECT DISTINCT pid, uid, user_id AS inner_uid FROM (SELECT pid, "
     "CAST('0x' || substr(md5(uid), 1, 2) AS BIGINT) * 4294967296 + user_id AS uid, user_id "
     "FROM usr) x")
def _(spark, sf_dir):
    users = everything(spark, sf_dir).events.select("pid", "uid").distinct()
    decorated = users.select("pid", I.md5uid(F.col("uid")).cast("bigint").alias("uid"))
    return decorated.withColumn("inner_uid", I.truncate_uid(F.col("uid")))


@add("reg_day", "SELECT pid, uid, substr(val, 1, 8) AS reg_day FROM props "
     "WHERE prop = 'register_time'")
def _(spark, sf_dir):
    rows = identity.filled_properties(today(spark, sf_dir).properties, "register_time")
    return rows.select("pid", "uid", F.substring("val", 1, 8).alias("reg_day"))


@add("reg_prefix_match", f"SELECT pid, uid, val FROM props WHERE prop = 'register_time' "
     f"AND val LIKE '{compact(DAY)}%'")
def _(spark, sf_dir):
    rows = identity.filled_properties(today(spark, sf_dir).properties, "register_time")
    return rows.where(F.col("val").startswith(compact(DAY))).drop("prop")


@add("default_attr", f"""
SELECT u.pid, u.uid, coalesce(n.nation, 'XA-NA') AS nation FROM usr u
LEFT JOIN nat n ON n.pid = u.pid AND n.uid =
  CAST(CAST('0x' || substr(md5(u.uid), 1, 2) AS BIGINT) * 4294967296 + u.user_id AS VARCHAR)""")
def _(spark, sf_dir):
    x = everything(spark, sf_dir)
    users = x.events.select("pid", "uid").distinct().withColumn("key", I.md5uid(F.col("uid")))
    stored = search.nations(x.properties).withColumnRenamed("uid", "key")
    return users.join(stored, ["pid", "key"], "left").select(
        "pid", "uid", F.coalesce("nation", F.lit(UNKNOWN_VALUE)).alias("nation"))


@add("normalise_orig_id", "SELECT pid, uid, orig_id FROM dev")
def _(spark, sf_dir):
    return today(spark, sf_dir).devices
