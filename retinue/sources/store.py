"""The metric store: partition upsert, JSON copy, external key-value adapter."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from retinue.functions.keys import metric_entry
from retinue.operators.metrics import KEY_PARTS, ROW
from retinue.schemas import VALUE
from retinue.sources.logs import PART_FILES
from retinue.sources.warehouse import Warehouse

ENTRY = "map<string,map<string,array<decimal(38,18)>>>"
# Key text: kind, project, two days, event pattern, segment (may hold commas), grouping.
KEY_PATTERN = r"^([^,]*),([^,]*),([^,]*),([^,]*),([^,]*),(.*),VF-ALL-0-0,(.*)$"


class KeyValueClient(Protocol):
    """A connection to a key-value store that can hold entries back."""

    def stage(self, part: str, key: str, label: str, entry: list[float]) -> None:
        """Put an entry of a part aside, unseen by readers."""

    def show(self, parts: list[str]) -> None:
        """Make the entries of these parts the current ones. Repeating it changes nothing."""

    def discard(self, parts: list[str]) -> None:
        """Forget what was put aside in these parts."""

    def close(self) -> None: ...


def publish(warehouse: Warehouse, rows: DataFrame, run_day: str, family: str) -> None:
    """Replace what ``family`` published on ``run_day``."""
    warehouse.overwrite("metrics", rows.select(*ROW), run_day=run_day, family=family)


def _quoted(text: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(text.alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)


def _number(value: Column) -> Column:
    """All digits of a decimal, without an exponent for 0 and without trailing zeros."""
    text = F.regexp_replace(value.cast("string"), r"^0E-\d+$", "0")
    return F.regexp_replace(text, r"\.0*$|(\.\d*[1-9])0+$", "$1")


def to_documents(rows: DataFrame) -> DataFrame:
    """Each row as a JSON text ``{key: {label: [count, value, users, rate]}}``."""
    entry = metric_entry(F.col("cnt"), F.col("value"), F.col("users"), F.col("sample_rate"))
    numbers = F.array_join(F.transform(entry, _number), ",")
    return rows.select(F.concat(
        F.lit("{"), _quoted(F.col("cache_key")), F.lit(":{"), _quoted(F.col("label")),
        F.lit(":["), numbers, F.lit("]}}")).alias("value"))


def _export_path(root: str, run_day: str, family: str) -> str:
    return f"{root}/run_day={run_day}/family={family}"


def export_json(rows: DataFrame, root: str, run_day: str, family: str) -> str:
    """Write the day's documents, one line per key and label, replacing an earlier copy."""
    path = _export_path(root, run_day, family)
    to_documents(rows).write.mode("overwrite").text(path)
    return path


def from_documents(documents: DataFrame) -> DataFrame:
    """Metric rows out of the ``value`` column of JSON documents."""
    labels = documents.select(
        F.explode(F.from_json("value", ENTRY)).alias("cache_key", "labels")
    )
    entries = labels.select("cache_key", F.explode("labels").alias("label", "entry"))
    parts = [
        F.regexp_extract("cache_key", KEY_PATTERN, i).alias(name)
        for i, name in enumerate(KEY_PARTS, 1)
    ]
    return entries.select(
        *parts,
        "cache_key",
        "label",
        F.get("entry", F.lit(0)).cast("bigint").alias("cnt"),
        F.get("entry", F.lit(1)).cast(VALUE).alias("value"),
        F.get("entry", F.lit(2)).cast("bigint").alias("users"),
        F.get("entry", F.lit(3)).cast("double").alias("sample_rate"),
    )


def reload_json(spark: SparkSession, root: str, run_day: str, family: str) -> DataFrame:
    lines = spark.read.schema("value string").option("pathGlobFilter", PART_FILES)
    return from_documents(lines.text(_export_path(root, run_day, family)))


class KeyValueSource(DataSource):
    """A batch sink of metric entries: ``df.write.format("retinue_store")``.

    Option ``client`` names a function (``module:function``) that takes the options and
    returns a ``KeyValueClient``; it is called in every task and once more to finish.
    """

    @classmethod
    def name(cls) -> str:
        return "retinue_store"

    def writer(self, schema, overwrite: bool) -> KeyValueWriter:
        return KeyValueWriter(dict(self.options))


class Staged(WriterCommitMessage):
    """What one task has put aside."""

    def __init__(self, part: str, entries: int):
        self.part, self.entries = part, entries


class KeyValueWriter(DataSourceWriter):
    """Tasks put their entries aside; readers see them when all of them have ended.

    A repeated task puts aside a part of its own, so the part of the attempt that failed is
    never shown. Entries are absolute values: a job that ran twice leaves what one leaves.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options

    def _client(self) -> KeyValueClient:
        module, function = self.options["client"].split(":")
        return getattr(importlib.import_module(module), function)(self.options)

    def write(self, rows: Iterator[Row]) -> Staged:
        client, part, entries = self._client(), uuid.uuid4().hex, 0
        try:
            for r in rows:
                entry = [r.cnt, float(r.value), r.users, r.sample_rate]
                client.stage(part, r.cache_key, r.label, entry)
                entries += 1
        finally:
            client.close()
        return Staged(part, entries)

    def commit(self, messages: list[Staged]) -> None:
        client = self._client()
        try:
            client.show([m.part for m in messages if m is not None])
        finally:
            client.close()

    def abort(self, messages: list[Staged]) -> None:
        client = self._client()
        try:
            client.discard([m.part for m in messages if m is not None])
        finally:
            client.close()


def upsert(rows: DataFrame, client: str, **options: str) -> None:
    """Show every entry of ``rows`` in an external store, all of them or none."""
    rows.sparkSession.dataSource.register(KeyValueSource)
    rows.select("cache_key", "label", "cnt", "value", "users", "sample_rate").write.format(
        KeyValueSource.name()).mode("append").options(client=client, **options).save()
