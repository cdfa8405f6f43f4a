"""The partitioned tables that the daily jobs read and overwrite."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.functions.days import shift
from retinue.schemas import RAW_TABLES, TABLES
from retinue.settings import KEEP_DAYS
from retinue.sources.logs import PART_FILES, id_map_select

#: What tells a table of lines from the view of the same name that splits them.
LINES = "_lines"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one the cluster shares.

    Only a local session, all of whose threads see one disk, may go without one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or tempfile.gettempdir()
    return os.path.join(base, f"retinue-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the cluster's shared folder; a temporary one only where none is set."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _spec(values: dict[str, str]) -> str:
    return ", ".join(f"{k}={_quoted(v)}" for k, v in values.items())


def _listed(partition: str) -> dict[str, str]:
    """Values of a listed partition, whose special characters are percent-encoded."""
    pairs = (p.split("=", 1) for p in partition.split("/"))
    return {k: unquote(v) for k, v in pairs}


@dataclass(frozen=True)
class Registration:
    """A partition that was to be registered, and why it was not, if so."""

    partition: dict[str, str]
    error: str | None = None


class Warehouse:
    """One database of Parquet tables.

    Writes replace whole partitions, so a job that ran twice leaves the same tables as
    one that ran once, and a lost executor costs only its tasks.
    """

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        at = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def create_tables(self, raw_location: str | None = None) -> list[str]:
        """Create the tables that do not exist yet.

        With ``raw_location`` the raw inputs are the tab-separated text found there, one
        folder per table and partition; otherwise they are Parquet like the rest. The id
        map is then a view of its lines by the rule of ``read_id_map``, since a CSV table
        would take the first two fields of any line.
        """
        for table in TABLES:
            if raw_location and table == "user_id":
                self._create_id_map(f"{raw_location}/{table}")
                continue
            schema, partitions = TABLES[table]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            storage, location = "USING parquet", ""
            if raw_location and table in RAW_TABLES:
                storage = ("USING csv OPTIONS (sep '\\t', quote '', "
                           f"pathGlobFilter '{PART_FILES}')")
                location = f" LOCATION '{raw_location}/{table}'"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) {storage} "
                f"PARTITIONED BY ({', '.join(partitions)}){location}"
            )
        return list(TABLES)

    def _create_id_map(self, location: str) -> None:
        view, lines = self.name("user_id"), self.name("user_id" + LINES)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {lines} (value STRING, pid STRING) USING text "
            f"OPTIONS (pathGlobFilter '{PART_FILES}') PARTITIONED BY (pid) LOCATION '{location}'")
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {view} AS "
                       f"SELECT {', '.join(id_map_select())} FROM {lines}")

    def _stored(self, table: str) -> str:
        """The table that holds the partitions of ``table``, which may be a view of it."""
        lines = self.name(table + LINES)
        return lines if self.spark.catalog.tableExists(lines) else self.name(table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def overwrite(self, table: str, rows: DataFrame, **fixed: str) -> None:
        """Replace every partition under ``fixed`` with ``rows``.

        Partitions under ``fixed`` that ``rows`` no longer fills disappear too. The
        rebalance packs output files by partition and splits the large ones.
        """
        self._insert(table, rows, "static", fixed)

    def overwrite_found(self, table: str, rows: DataFrame) -> None:
        """Replace only the partitions that ``rows`` has rows for, keeping the others."""
        self._insert(table, rows, "dynamic", {})

    def overwrite_each(self, table: str, rows: DataFrame, specs: list[dict[str, str]]) -> None:
        """Replace the partitions ``specs``, to which all ``rows`` belong; those without rows
        end up empty, and registered, so that they are known to have been written."""
        if not specs:
            return self.overwrite_found(table, rows)
        before = self._files(table, specs)
        self.overwrite_found(table, rows)
        filled = [
            _listed("/".join(part for part in path.split("/")[:-1] if "=" in part))
            for path in self._files(table, specs) - before
        ]
        empty = [s for s in specs if s not in filled]
        self.drop_partitions(table, empty)
        self.add_partitions(table, empty)

    def _files(self, table: str, specs: list[dict[str, str]]) -> set[str]:
        """Files of the given partitions; each write makes new ones."""
        of_spec = [reduce(Column.__and__, [F.col(k) == v for k, v in s.items()]) for s in specs]
        return set(self.table(table).where(reduce(Column.__or__, of_spec)).inputFiles())

    def _insert(self, table: str, rows: DataFrame, mode: str, fixed: dict[str, str]) -> None:
        """One write with its own overwrite mode, whatever that of the session."""
        schema, partitions = TABLES[table]
        open_ = [p for p in partitions if p not in fixed]
        spec = ", ".join(([_spec(fixed)] if fixed else []) + open_)
        columns = [f.name for f in schema if f.name not in partitions] + open_
        packed = rows.select(*columns)
        packed = packed.hint("rebalance", *open_) if open_ else packed.hint("rebalance")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(table)} "
            f"WITH ('partitionOverwriteMode' = '{mode}') PARTITION ({spec}) "
            "SELECT * FROM {packed}",
            packed=packed,
        )

    def add_partitions(self, table: str, specs: list[dict[str, str]]) -> list[Registration]:
        """Register the given partitions without listing the table; a report of each.

        One that cannot be registered does not keep the others from it.
        """
        if not specs:
            return []
        try:
            self._add(table, specs)
            return [Registration(s) for s in specs]
        except PySparkException as error:
            if len(specs) == 1:
                return [Registration(specs[0], str(error))]
            return [done for s in specs for done in self.add_partitions(table, [s])]

    def _add(self, table: str, specs: list[dict[str, str]]) -> None:
        clauses = " ".join(f"PARTITION ({_spec(s)})" for s in specs)
        self.spark.sql(f"ALTER TABLE {self._stored(table)} ADD IF NOT EXISTS {clauses}")

    def discover(self, table: str) -> DataFrame:
        """Register partitions found on storage; repeating it changes nothing."""
        stored = self._stored(table)
        self.spark.sql(f"MSCK REPAIR TABLE {stored}")
        return self.spark.sql(f"SHOW PARTITIONS {stored}")

    def _by_day(self, table: str) -> DataFrame:
        """Stored partitions of a table partitioned by day first: (partition, day)."""
        day_value = F.regexp_extract("partition", "^[^=]+=([^/]+)", 1)
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        return listed.select("partition", day_value.alias("day"))

    def partitions(self, table: str, from_day: str, to_day: str) -> list[dict[str, str]]:
        """The values of the stored partitions of a range of days."""
        listed = self._by_day(table).where(F.col("day").between(from_day, to_day))
        return [_listed(r.partition) for r in listed.collect()]

    def days(self, table: str) -> set[str]:
        """Days that a table partitioned by day first has partitions of."""
        return {r.day for r in self._by_day(table).select("day").distinct().collect()}

    def expire(self, table: str, day: str, keep_days: int = KEEP_DAYS) -> list[str]:
        """Drop partitions whose leading day column lies more than ``keep_days`` back."""
        return self._drop_days(table, F.col("day") < shift(day, keep_days))

    def forget(self, table: str, from_day: str, to_day: str) -> list[str]:
        """Drop the partitions of a range of days."""
        return self._drop_days(table, F.col("day").between(from_day, to_day))

    def _drop_days(self, table: str, which: Column) -> list[str]:
        old = [r.partition for r in self._by_day(table).where(which).collect()]
        self.drop_partitions(table, [_listed(p) for p in old])
        return old

    def drop_partitions(self, table: str, specs: list[dict[str, str]]) -> None:
        if not specs:
            return
        clauses = ", ".join(f"PARTITION ({_spec(s)})" for s in specs)
        self.spark.sql(f"ALTER TABLE {self._stored(table)} DROP IF EXISTS {clauses}")
