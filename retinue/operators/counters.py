"""Row counts of what the daily transforms read, keep and miss."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retinue.functions.ids import is_filled
from retinue.operators.visits import in_day_range, is_visit


def _missing(c: str):
    return ~F.coalesce(is_filled(F.col(c)), F.lit(False))


class InputCounters:
    """Rows read and kept of inputs, observed by the steps that read them anyway.

    A step that finds its other inputs empty may skip reading one altogether, and nothing is
    observed; that input is then counted by itself. Tasks that run again after an executor was
    lost count again, so the counts describe a run, and nothing is computed from them.
    """

    def __init__(self):
        self._watched: dict[str, tuple[Observation, DataFrame]] = {}

    def watch(self, source: str, rows: DataFrame, kept: Column) -> DataFrame:
        """``rows``, to be used by one step; ``kept`` tells which of them it goes on with.

        Filters of the step do not move below the count, so ``rows`` has to be cut down to
        the wanted partitions before.
        """
        measures = (F.count(F.lit(1)).alias("read"), F.count_if(kept).alias("kept"))
        seen = Observation()
        self._watched[source] = (seen, rows.agg(*measures))
        return rows.observe(seen, *measures)

    def counts(self) -> list[tuple[str, int, int, int]]:
        """(source, read, kept, missed); waits for steps that are not done."""
        found = []
        for source, (seen, alone) in self._watched.items():
            row = _observed(seen) or alone.first().asDict()
            found.append((source, row["read"], row["kept"], row["read"] - row["kept"]))
        return found


def _observed(seen: Observation) -> dict[str, int]:
    """What was observed; nothing if the step skipped it, which Spark reports as a row without
    columns that cannot be fetched."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def event_counters(events: DataFrame, day: str) -> DataFrame:
    visited = in_day_range(day, day) & is_visit()
    return events.agg(F.count("*").alias("read"),
                      F.count_if(visited).alias("kept")).select(
        F.lit("events").alias("source"), "read", "kept",
        (F.col("read") - F.col("kept")).alias("missed"))


def filled_counters(rows: DataFrame, source: str, column: str) -> DataFrame:
    missed = F.count_if(_missing(column)).alias("missed")
    return rows.agg(F.count("*").alias("read"), missed).select(
        F.lit(source).alias("source"), "read",
        (F.col("read") - F.col("missed")).alias("kept"), "missed")


def transform_counters(
    events: DataFrame, ids: DataFrame, properties: DataFrame, day: str
) -> DataFrame:
    """(source, read, kept, missed) for the three inputs."""
    return (
        event_counters(events, day)
        .unionByName(filled_counters(ids, "id_map", "orig_id"))
        .unionByName(filled_counters(properties, "properties", "val"))
    )
