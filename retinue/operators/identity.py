"""From inner uids to device ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.functions.ids import is_filled, md5uid, normalise_orig_id
from retinue.settings import REGISTER_TIME


def device_ids(ids: DataFrame, unmapped: str | None = None) -> DataFrame:
    """Distinct (pid, uid, orig_id), lower-cased: what operators take as ``devices``.

    Entries without an id are dropped, or share the id ``unmapped`` if one is given. The
    jobs store the result once a day, so that only one step pays for the distinct.
    """
    orig_id = normalise_orig_id(F.col("orig_id"))
    if unmapped is not None:
        orig_id = F.when(is_filled(orig_id), orig_id).otherwise(F.lit(unmapped))
    return (
        ids.select("pid", "uid", orig_id.alias("orig_id"))
        .where(is_filled(F.col("orig_id")))
        .distinct()
    )


def decorated(devices: DataFrame) -> DataFrame:
    """Devices keyed by the decorated uid under which properties are stored.

    A uid that is not a number has no decorated form and therefore no properties.
    """
    return devices.withColumn("uid", md5uid(F.col("uid"))).where(F.col("uid") != "")


def to_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Fan sub-project rows out to the groups they belong to; ``pid`` becomes the group."""
    named = groups.select(F.col("grp"), F.col("member").alias("pid"))
    return rows.join(named, "pid").drop("pid").withColumnRenamed("grp", "pid")


def in_any_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of sub-projects that belong to at least one group."""
    return rows.join(groups.select(F.col("member").alias("pid")), "pid", "left_semi")


def filled_properties(properties: DataFrame, *props: str) -> DataFrame:
    named = is_filled(F.col("uid")) & is_filled(F.col("val"))
    return properties.where(F.col("prop").isin(*props) & named)


def register_times(properties: DataFrame) -> DataFrame:
    """First and last registration time per stored uid; combines before shuffling."""
    return (
        filled_properties(properties, REGISTER_TIME)
        .groupBy("pid", "uid")
        .agg(F.max("val").alias("max_val"), F.min("val").alias("min_val"))
    )
