"""The input tables derived from a TPC-H-like data set with an event stream.

Five sub-projects share the events. Some users have no device id (the id-map line is
incomplete), some share a device, some have a blank nation or two different ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.functions.days import shift
from retinue.functions.ids import md5uid
from retinue.local import local_rows
from retinue.operators.identity import device_ids

GROUPS = {
    "g1": ("p0", "p1"),
    "g2": ("p2", "p3"),
    "all": ("p0", "p1", "p2", "p3"),
    "g3": ("p4",),
}

_EVENT_PATH = """
CASE event_type
  WHEN 'view' THEN 'visit.page'
  WHEN 'click' THEN 'ientheartbeat.tick'
  WHEN 'signup' THEN 'signup.done'
  WHEN 'error' THEN 'error.any'
  ELSE concat('pay.search2',
    CASE WHEN k % 5 >= 1 THEN concat('.s', k % 3) ELSE '' END,
    CASE WHEN k % 5 >= 2 THEN concat('.c', k % 4) ELSE '' END,
    CASE WHEN k % 5 >= 3 THEN concat('.b', k % 2) ELSE '' END)
END"""


@dataclass(frozen=True)
class Inputs:
    events: DataFrame
    ids: DataFrame
    devices: DataFrame
    properties: DataFrame
    groups: DataFrame


def events(
    spark: SparkSession, sf_dir: str, from_day: str | None = None, to_day: str | None = None
) -> DataFrame:
    """The event log. A day range becomes a filter on the stored timestamp, which
    reaches the scan as partition pruning would on the real log."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    if from_day is not None:
        raw = raw.where(F.expr(f"ts >= TIMESTAMP_NTZ'{from_day} 00:00:00'"))
    if to_day is not None:
        raw = raw.where(F.expr(f"ts < TIMESTAMP_NTZ'{shift(to_day, -1)} 00:00:00'"))
    ms = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    return raw.withColumn("k", F.get_json_object("props", "$.k").cast("int")).select(
        "event_id",
        "user_id",
        F.concat(F.lit("p"), F.col("event_id") % 5).alias("pid"),
        F.col("user_id").cast("string").alias("uid"),
        F.expr(_EVENT_PATH).alias("event"),
        "value",
        F.expr(ms).cast("string").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .select("pid", "uid", "user_id")
        .distinct()
        .withColumn("n", F.substring("pid", 2, 1).cast("int"))
    )


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = F.col("user_id") - F.when(F.col("user_id") % 5 == 4, 1).otherwise(0)
    mapped = F.col("user_id") % 37 != 36
    return _users(spark, sf_dir).select(
        "pid", "uid", F.when(mapped, F.concat(F.lit("DEV-"), device)).alias("orig_id")
    )


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir).withColumn("stored_uid", md5uid(F.col("uid")))
    spread = (F.col("user_id") * F.lit(2654435761) + F.col("n") * 40503) % 1000003 % 30
    first_day = F.lit("2024-01-01").cast("date")
    registered = users.select(
        "pid",
        F.col("stored_uid").alias("uid"),
        F.lit("register_time").alias("prop"),
        F.concat(
            F.date_format(F.date_add(first_day, spread.cast("int")), "yyyyMMdd"),
            F.lit("120000"),
        ).alias("val"),
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    home = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.lower("n_name").alias("home")
    )
    nations = users.join(home, "user_id").select(
        "pid",
        F.col("stored_uid").alias("uid"),
        F.lit("nation").alias("prop"),
        F.when(F.col("user_id") % 10 == 0, "")
        .when((F.col("n") == 1) & (F.col("user_id") % 25 == 3), "other")
        .otherwise(F.col("home"))
        .alias("val"),
    )
    return registered.unionByName(nations)


def groups(spark: SparkSession) -> DataFrame:
    rows = [(grp, member) for grp, members in GROUPS.items() for member in members]
    return local_rows(spark, rows, "grp", "member")


def load(
    spark: SparkSession, sf_dir: str, from_day: str | None = None, to_day: str | None = None
) -> Inputs:
    ids = id_map(spark, sf_dir)
    return Inputs(
        events(spark, sf_dir, from_day, to_day),
        ids,
        device_ids(ids),
        properties(spark, sf_dir),
        groups(spark),
    )
