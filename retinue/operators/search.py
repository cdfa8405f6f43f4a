"""Search revenue: per-user rollups, breakdowns by path level, wildcard combinations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.functions.ids import md5uid
from retinue.functions.paths import DIMENSIONS, path_levels
from retinue.operators.identity import filled_properties
from retinue.schemas import EVENT_VALUE
from retinue.settings import ANY, GRP_CODES, GRP_NONE, NATION, NO_GROUP_KEY, UNKNOWN_VALUE

LEVEL_TYPES = {"event3": "ev3", "event4": "ev4", "event5": "ev5"}
CODES = tuple(GRP_CODES[d] for d in DIMENSIONS)
SUBSETS = tuple(s for r in range(5) for s in combinations(range(4), r))


def search_events(
    events: DataFrame, from_day: str | None, to_day: str | None, prefix: str
) -> DataFrame:
    """Events whose name starts with ``prefix``: a prefix match, not a path match.

    Every occurrence counts. Without a day the range is open on that end.
    """
    found = events.where(F.col("event").startswith(prefix))
    if from_day is not None:
        found = found.where(F.col("day") >= from_day)
    if to_day is not None:
        found = found.where(F.col("day") <= to_day)
    return found.withColumn("value", F.col("value").cast(EVENT_VALUE))


def user_rollup(searches: DataFrame) -> DataFrame:
    """Per day, sub-project and uid: occurrences, exact value, first path in key order."""
    return searches.groupBy("day", "pid", "uid").agg(
        F.count("*").alias("count"),
        F.sum("value").alias("value"),
        F.min("event").alias("first_event"),
    )


def merge_same_user(rows: DataFrame, *by: str) -> DataFrame:
    """One user seen several times: counts and values add up, the user counts once."""
    return rows.groupBy(*by).agg(
        F.lit(1).cast("bigint").alias("users"),
        F.sum("count").alias("count"),
        F.sum("value").alias("value"),
    )


def merge_diff_user(rows: DataFrame, *by: str) -> DataFrame:
    """Different users: users, counts and values all add up."""
    return rows.groupBy(*by).agg(
        F.sum("users").alias("users"),
        F.sum("count").alias("count"),
        F.sum("value").alias("value"),
    )


def nations(properties: DataFrame) -> DataFrame:
    """One nation per stored uid, the smallest if there are several."""
    return (
        filled_properties(properties, NATION)
        .groupBy("pid", "uid")
        .agg(F.min("val").alias(NATION))
    )


def attach_identity(rows: DataFrame, devices: DataFrame, properties: DataFrame) -> DataFrame:
    """Device id (unmapped users drop out) and nation (null if unknown) of uid rows.

    The property table holds all users, the rows those of a day: it is reduced to their uids
    before it is aggregated.
    """
    stored_uid = F.nullif(md5uid(F.col("uid")), F.lit(""))
    keyed = rows.withColumn("stored_uid", stored_uid)
    wanted = keyed.select("pid", F.col("stored_uid").alias("uid")).distinct()
    asked = properties.join(wanted, ["pid", "uid"], "left_semi")
    stored = nations(asked).withColumnRenamed("uid", "stored_uid")
    mapped = keyed.join(devices, ["pid", "uid"])
    return mapped.join(stored, ["pid", "stored_uid"], "left").drop("stored_uid")


def search_paths(
    events: DataFrame,
    devices: DataFrame,
    properties: DataFrame,
    from_day: str | None,
    to_day: str | None,
    prefix: str,
) -> DataFrame:
    """Per day, sub-project, uid and event path: device, nation, count and value.

    Both stored layouts derive from this one pass over the log.
    """
    per_path = (
        search_events(events, from_day, to_day, prefix)
        .groupBy("day", "pid", "uid", "event")
        .agg(F.count("*").alias("count"), F.sum("value").alias("value"))
    )
    return attach_identity(per_path, devices, properties)


def user_paths(found: DataFrame) -> DataFrame:
    """Per day, sub-project and device: first path levels, nation, count and value.

    Several uids of a sub-project that share a device are added up under its smallest
    path and nation.
    """
    return (
        found.groupBy("day", "pid", "orig_id")
        .agg(
            F.sum("count").alias("count"),
            F.sum("value").alias("value"),
            F.min("event").alias("first_event"),
            F.min(NATION).alias(NATION),
        )
        .select(
            "day", "pid", F.col("orig_id").alias("uid"),
            *path_levels(F.col("first_event")),
            F.coalesce(NATION, F.lit(ANY)).alias(NATION),
            "count", "value",
        )
    )


def search_fact(found: DataFrame) -> DataFrame:
    """Stored form of ``user_paths``: (day, uid, events, count, value)."""
    return user_paths(found).select(
        "day", "uid", F.array(*DIMENSIONS).alias("events"), "count", "value"
    )


def fact_paths(fact: DataFrame, from_day: str, to_day: str) -> DataFrame:
    """Stored fact rows of a day range with the array spread into columns."""
    in_range = fact.where(F.col("day").between(from_day, to_day))
    spread = [F.get("events", F.lit(i)).alias(d) for i, d in enumerate(DIMENSIONS)]
    return in_range.select("day", "uid", *spread, "count", "value")


# --- one dimension at a time -------------------------------------------------------


def search_by_type(found: DataFrame) -> DataFrame:
    """(day, type, uid, prop, num, count, value): one row per user, level and value.

    Levels keep every path of a user; the nation is one per user and day.
    """
    levels = path_levels(F.col("event"), UNKNOWN_VALUE)
    level_rows = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("type"), level.alias("prop"))
        for kind, level in zip(LEVEL_TYPES, levels)
    ]))
    measures = (F.lit(1).cast("bigint").alias("num"), F.sum("count").alias("count"),
                F.sum("value").alias("value"))
    by_level = (
        found.select("day", "orig_id", "count", "value", level_rows)
        .groupBy("day", "type", "orig_id", "prop")
        .agg(*measures)
    )
    by_nation = (
        found.groupBy("day", "orig_id")
        .agg(F.coalesce(F.min(NATION), F.lit(UNKNOWN_VALUE)).alias("prop"), *measures)
        .withColumn("type", F.lit(NATION))
    )
    return by_level.unionByName(by_nation).withColumnRenamed("orig_id", "uid")


def by_level(typed: DataFrame, from_day: str, to_day: str) -> DataFrame:
    """Users, count and value per level and value over a day range."""
    return (
        typed.where(F.col("day").between(from_day, to_day))
        .groupBy("type", "prop")
        .agg(F.count_distinct("uid").alias("users"), F.sum("count").alias("cnt"),
             F.sum("value").alias("value"))
    )


def search_total(typed: DataFrame, from_day: str, to_day: str) -> DataFrame:
    """Users, count and value overall, read from the rows of one type."""
    return (
        typed.where(F.col("day").between(from_day, to_day) & (F.col("type") == NATION))
        .agg(F.count_distinct("uid").alias("users"), F.sum("count").alias("cnt"),
             F.sum("value").alias("value"))
    )


# --- every combination of filters and groupings --------------------------------------


def contiguous(rows: DataFrame) -> DataFrame:
    """Blank out path levels below the first missing one."""
    no_ev3, no_ev4 = F.col("ev3") == ANY, F.col("ev4") == ANY
    return rows.withColumns({
        "ev5": F.when(no_ev3 | no_ev4, ANY).otherwise(F.col("ev5")),
        "ev4": F.when(no_ev3, ANY).otherwise(F.col("ev4")),
    })


def _drop_literal_gap(rows: DataFrame) -> DataFrame:
    full_path = (F.col("ev3") != ANY) & (F.col("ev4") != ANY) & (F.col("ev5") != ANY)
    return rows.where(~(full_path & (F.col(NATION) == ANY)))


def explode_event_groups(
    rows: DataFrame, drop_full_path_without_nation: bool = False
) -> DataFrame:
    """Per row, every (ev3, ev4, ev5, nation, grp, grpkey) it contributes to.

    Any subset of the set dimensions may be fixed, the others are wildcards; each is
    grouped by every dimension that is not fixed, and once by none. The flag drops rows
    with a complete path but no nation, as existing published numbers do.
    """
    rows = contiguous(rows)
    if drop_full_path_without_nation:
        rows = _drop_literal_gap(rows)
    wildcards = []
    for fixed in SUBSETS:
        usable = F.lit(True)
        for i in fixed:
            usable = usable & (F.col(DIMENSIONS[i]) != ANY)
        dims = [
            (F.col(d) if i in fixed else F.lit(ANY)).alias(d) for i, d in enumerate(DIMENSIONS)
        ]
        groupings = [(CODES[i], F.col(DIMENSIONS[i])) for i in range(4) if i not in fixed]
        for code, key in [*groupings, (GRP_NONE, F.lit(NO_GROUP_KEY))]:
            row = F.struct(*dims, F.lit(code).alias("grp"), key.alias("grpkey"))
            wildcards.append(F.when(usable, row))
    kept = F.filter(F.array(*wildcards), lambda r: r.isNotNull())
    others = [c for c in rows.columns if c not in DIMENSIONS]
    return rows.select(*others, F.inline(kept))


MASKS = tuple(range(1 << len(DIMENSIONS)))


def _in_mask(i: int) -> Column:
    return F.col("mask").bitwiseAND(F.lit(1 << i)) != 0


def _spread_cells(rows: DataFrame) -> DataFrame:
    """Each row once per cube cell it falls in: a mask of fixed dimensions and their values.

    At most one fixed dimension may be a wildcard itself; other cells feed no result row.
    """
    cells = rows.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in MASKS])))
    unset = sum(
        F.when(_in_mask(i) & (F.col(d) == ANY), 1).otherwise(0)
        for i, d in enumerate(DIMENSIONS)
    )
    cells = cells.where(unset <= 1)
    return cells.withColumns(
        {d: F.when(_in_mask(i), F.col(d)).otherwise(F.lit(ANY)) for i, d in enumerate(DIMENSIONS)}
    )


def _relabel_cells(cells: DataFrame) -> DataFrame:
    """Cube cells to (filters, grouping) rows.

    The cell of filters S plus dimension d holds the row "S grouped by d" for d's value,
    and, if none of its values is a wildcard, also the row "S plus d, not grouped".
    """
    unset = [_in_mask(i) & (F.col(d) == ANY) for i, d in enumerate(DIMENSIONS)]
    any_unset = unset[0] | unset[1] | unset[2] | unset[3]
    dims = [F.col(d) for d in DIMENSIONS]
    rows = [F.when(~any_unset, F.struct(*dims, F.lit(GRP_NONE).alias("grp"),
                                        F.lit(NO_GROUP_KEY).alias("grpkey")))]
    for i, d in enumerate(DIMENSIONS):
        rest = [F.lit(ANY).alias(x) if x == d else F.col(x) for x in DIMENSIONS]
        grouped = F.struct(*rest, F.lit(CODES[i]).alias("grp"), F.col(d).alias("grpkey"))
        rows.append(F.when(_in_mask(i) & (~any_unset | unset[i]), grouped))
    kept = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return cells.select(F.inline(kept), "users", "cnt", "value")


def search_cube(
    paths: DataFrame, drop_full_path_without_nation: bool = False
) -> DataFrame:
    """Distinct users, count and value for every filter and grouping combination.

    Counting distinct users per cell directly would shuffle sixteen copies of every
    row. Here users meet on one partition first. Those with a single path and nation,
    the bulk, are counted per path without naming them; only users with several are
    spread over the cells, and de-duplicated where they are. What is shuffled after
    that is cells. The stored fact has one row for each day, sub-project and device, so a
    device brings no more rows than that, and dealing the rows by user once serves the sum
    per path and the count of paths.
    """
    rows = contiguous(paths)
    if drop_full_path_without_nation:
        rows = _drop_literal_gap(rows)
    measures = (F.sum("count").alias("count"), F.sum("value").alias("value"))
    per_path = rows.repartition("uid").groupBy("uid", *DIMENSIONS).agg(*measures)
    paths_of_user = F.expr("count(*) OVER (PARTITION BY uid)")
    counted = per_path.withColumn("paths_of_user", paths_of_user)

    single = (
        counted.where("paths_of_user = 1")
        .groupBy(*DIMENSIONS)
        .agg(F.count("*").alias("users"), *measures)
    )
    several = (
        _spread_cells(counted.where("paths_of_user > 1"))
        .groupBy("uid", "mask", *DIMENSIONS)
        .agg(*measures)
        .select("mask", *DIMENSIONS, F.lit(1).cast("bigint").alias("users"), "count", "value")
    )
    cells = (
        _spread_cells(single)
        .unionByName(several)
        .groupBy("mask", *DIMENSIONS)
        .agg(F.sum("users").alias("users"), F.sum("count").alias("cnt"),
             F.sum("value").alias("value"))
    )
    return _relabel_cells(cells)


def search_cube_by_explode(
    paths: DataFrame, drop_full_path_without_nation: bool = False
) -> DataFrame:
    """``search_cube`` in its direct form, up to 48 copies of every row; for comparison."""
    return (
        explode_event_groups(paths, drop_full_path_without_nation)
        .groupBy(*DIMENSIONS, "grp", "grpkey")
        .agg(F.count_distinct("uid").alias("users"), F.sum("count").alias("cnt"),
             F.sum("value").alias("value"))
    )
