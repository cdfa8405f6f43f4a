"""Small configuration relations whose size the planner knows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_rows(spark: SparkSession, rows: Sequence[Sequence[str]], *names: str) -> DataFrame:
    """Rows of strings as a local relation.

    A DataFrame made from Python rows has no known size, and joining the log with one
    would shuffle the log by sub-project; a local relation is broadcast instead.
    """
    columns = {
        name: pa.array([r[i] for r in rows], pa.string()) for i, name in enumerate(names)
    }
    return spark.createDataFrame(pa.table(columns))
