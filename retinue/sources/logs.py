"""Readers for the raw inputs: tab-separated logs, group config, database dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue import schemas
from retinue.functions.days import shift

PART_FILES = "part-*"


#: Characters that a partition folder has percent-encoded, besides control characters.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def partition_folder(column: str, value: str) -> str:
    """The folder of a partition, as Spark and other writers of such tables name it."""
    return f"{column}=" + "".join(
        f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def _glob(text: str) -> str:
    """Text that a path pattern takes literally."""
    return "".join("\\" + c if c in "\\*?[]{}," else c for c in text)


def partition_paths(path: str, **values: Sequence[str]) -> str:
    """A pattern of the partition folders of the given values, column by column.

    Every level names its folders, so they are looked up one by one and nothing is listed
    above them; those that do not exist are left out.
    """
    levels = ["{%s}" % ",".join(sorted({_glob(partition_folder(c, v)) for v in of}))
              for c, of in values.items()]
    return "/".join([path.rstrip("/"), *levels])


def _tab_text(spark: SparkSession, schema, path: str, **values: Sequence[str]) -> DataFrame:
    """The partitions of the given values of a table of tab-separated text; of none, no rows."""
    found = (
        spark.read.schema(schema)
        .option("basePath", path)
        .option("sep", "\t")
        .option("quote", "")
        .option("pathGlobFilter", PART_FILES)
    )
    try:
        return found.csv(partition_paths(path, **values))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_n_days(day_col: Column, day: str, n: int) -> Column:
    """The ``n`` daily partitions ending at ``day``."""
    return day_col.between(shift(day, n - 1), day)


def read_events(
    spark: SparkSession, path: str, day: str, pids: Sequence[str], days: int = 1
) -> DataFrame:
    """Day and sub-project slice of the event log; no other part of the log is looked at."""
    wanted = [shift(day, k) for k in range(days)]
    return _tab_text(spark, schemas.USER_EVENT, path, day=wanted, pid=pids)


def read_properties(
    spark: SparkSession, path: str, prop: str, pids: Sequence[str]
) -> DataFrame:
    return _tab_text(spark, schemas.USER_PROPERTY, path, pid=pids, prop=[prop])


#: Columns of a line ``value`` of the id map, for the reader and for the table of the jobs.
ID_MAP_FIELDS = r"split(rtrim('\t', value), '\t')"
ID_MAP_COLUMNS = {
    "uid": f"get({ID_MAP_FIELDS}, 0)",
    "orig_id": f"CASE WHEN size({ID_MAP_FIELDS}) = 2 THEN get({ID_MAP_FIELDS}, 1) END",
    "pid": "pid",
}


def id_map_select() -> list[str]:
    return [f"{rule} AS {column}" for column, rule in ID_MAP_COLUMNS.items()]


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """``uid <tab> orig_id`` lines; ``orig_id`` is null unless a line has two fields."""
    lines = (
        spark.read.schema("value string, pid string")
        .option("pathGlobFilter", PART_FILES)
        .text(path)
    )
    return lines.selectExpr(*id_map_select())


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Group config ``[{"project": g, "members": "a:x,b:y"}]`` as (grp, member) rows."""
    config = spark.read.schema("project string, members string").json(path, multiLine=True)
    member = F.explode(F.split("members", ",")).alias("entry")
    return config.select(F.col("project").alias("grp"), member).select(
        "grp", F.split("entry", ":")[0].alias("member")
    )


def dimension_options(
    url: str, query: str, key: str, lower: int, upper: int, partitions: int, fetch_size: int
) -> dict[str, str]:
    """Options for a key-partitioned database read, one range per task."""
    return {
        "url": url,
        "dbtable": query,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_dimension(
    spark: SparkSession,
    url: str,
    query: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **connection: str,
) -> DataFrame:
    """Read an id map or property table once over JDBC, to be joined with ``lookup``."""
    options = dimension_options(url, query, key, lower, upper, partitions, fetch_size)
    return spark.read.format("jdbc").options(**options, **connection).load()


def lookup(keys: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Dimension rows of the given keys: a join in place of a long ``IN`` list."""
    return dimension.join(keys.select(*on).distinct(), list(on), "left_semi")
