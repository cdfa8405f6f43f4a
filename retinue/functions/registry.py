"""SQL names for the expressions that SQL users call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from retinue.functions.ids import MD5UID_SQL
from retinue.functions.keys import METRIC_KEY_SQL


def register_functions(spark: SparkSession) -> None:
    spark.sql(MD5UID_SQL)
    spark.sql(METRIC_KEY_SQL)
