"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A side of a join is broadcast only if a count has shown at most so many rows.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session may go without that setting: its threads share one disk. All
    intermediate tables of an application lie below one folder, named after it, which
    can be removed when the application has ended.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    This cuts the lineage: a lost executor costs a read, and several consumers share one
    computation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (cheap to count, as after ``written``) with a broadcast hint if it is small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
