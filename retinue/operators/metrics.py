"""Published metric rows: one row per key and label."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.functions import keys as K
from retinue.functions.days import shift
from retinue.local import local_rows
from retinue.schemas import METRICS, VALUE
from retinue.settings import (
    ANY,
    COVER_EVENT,
    GRP_CODES,
    GRP_NONE,
    NATION,
    NO_GROUP_KEY,
    SAMPLE_RATE,
    TOTAL_NEW_EVENT,
    TOTAL_USER,
    VISIT_EVENT,
)

ROW = [f.name for f in METRICS if f.name not in ("run_day", "family")]
KEY_PARTS = ("kind", "project", "start_day", "end_day", "event_pattern", "segment", "grouping")


@dataclass(frozen=True)
class Published:
    """How a metric column is keyed. Ages are days before the computed day.

    ``start`` is the key's first day, which need not be the first day of the data behind
    it. ``label`` is the age of the day that labels a COMMON entry.
    """

    metric: str
    start: int = 0
    cohort: tuple[int, int] | None = None
    event: str = VISIT_EVENT
    common: bool = True
    group: bool = True
    label: int = 0


TOTALS = (
    Published("dau"),
    Published("wau", start=7),
    Published("mau", start=30),
    Published("new_users", cohort=(0, 0)),
    Published("ret_day2", cohort=(1, 1)),
    Published("ret_day7", cohort=(6, 6)),
    Published("ret_week", start=6, cohort=(7, 7)),
)
COVER = (
    Published("cover_users", cohort=(0, 0), event=COVER_EVENT),
    Published("total_new", cohort=(0, 0), event=TOTAL_NEW_EVENT),
)
# The key of the two-day ladder step starts a day before its visits do; stored keys have it.
BREAKDOWN = (
    Published("active"),
    Published("new", cohort=(0, 0)),
    Published("new_7d", start=6, cohort=(6, 0), common=False),
    Published("ret_day2", cohort=(1, 1), label=1),
    Published("ret_day7", cohort=(6, 6), label=6),
    Published("ret_week", start=5, cohort=(6, 6), label=5),
    Published("ladder_5", start=4, cohort=(5, 5), common=False),
    Published("ladder_4", start=3, cohort=(4, 4), common=False),
    Published("ladder_3", start=2, cohort=(3, 3), common=False),
    Published("ladder_2", start=2, cohort=(2, 2), common=False),
)


def day_label(day: str) -> str:
    return day + " 00:00"


def _cohort_filter(spec: Published, day: str) -> list[str]:
    if spec.cohort is None:
        return []
    first, last = spec.cohort
    return [K.register_filter(shift(day, first), shift(day, last))]


def _entry(spec: Published, day: str, kind: str, segment: Column, grouping: str,
           label: Column, users: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(shift(day, spec.start)).alias("start_day"),
        F.lit(day).alias("end_day"),
        F.lit(spec.event).alias("event_pattern"),
        segment.alias("segment"),
        F.lit(grouping).alias("grouping"),
        label.alias("label"),
        users.cast("bigint").alias("users"),
    )


def finish(rows: DataFrame, cnt: Column | None = None, value: Column | None = None) -> DataFrame:
    """Add key and measures, and put the columns in table order."""
    parts = [F.col(c) for c in KEY_PARTS[:-1]]
    return rows.select(
        *KEY_PARTS,
        K.metric_key(*parts, F.col("grouping")).alias("cache_key"),
        "label",
        (F.lit(0) if cnt is None else cnt).cast("bigint").alias("cnt"),
        (F.lit(0) if value is None else value).cast(VALUE).alias("value"),
        "users",
        F.lit(SAMPLE_RATE).alias("sample_rate"),
    )


def total_metrics(totals: DataFrame, day: str, specs: Sequence[Published] = TOTALS) -> DataFrame:
    """One COMMON row per group and metric; zeros are published too."""
    entries = [
        _entry(s, day, K.COMMON, K.segment(*_cohort_filter(s, day)), K.PERIOD,
               F.lit(day_label(shift(day, s.label))), F.col(s.metric))
        for s in specs
    ]
    return finish(totals.select(F.col("pid").alias("project"), F.inline(F.array(*entries))))


def breakdown_metrics(
    counts: DataFrame, day: str, attr: str, specs: Sequence[Published] = BREAKDOWN
) -> DataFrame:
    """COMMON and GROUP rows per attribute value, where there is a user to count."""
    entries = []
    for s in specs:
        cohort = _cohort_filter(s, day)
        if s.common:
            with_value = K.segment(K.value_filter(attr, F.col("attr_value")), *cohort)
            entries.append(_entry(s, day, K.COMMON, with_value, K.PERIOD,
                                  F.lit(day_label(shift(day, s.label))), F.col(s.metric)))
        if s.group:
            entries.append(_entry(s, day, K.GROUP, K.segment(*cohort), "USER_PROPERTIES," + attr,
                                  F.col("attr_value"), F.col(s.metric)))
    rows = counts.select(F.col("pid").alias("project"), F.inline(F.array(*entries)))
    return finish(rows.where(F.col("users") > 0))


def with_all_groups(totals: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Groups without any user still get a row of zeros."""
    names = local_rows(totals.sparkSession, [(g,) for g in groups], "pid")
    return names.join(totals, "pid", "left").na.fill(0)


def search_metrics(
    cube: DataFrame, project: str, start_day: str, end_day: str, label_day: str, event: str
) -> DataFrame:
    """Rows of a search cube as metric rows; ungrouped totals are labelled by day."""
    start, end = F.lit(start_day), F.lit(end_day)
    keyed = cube.withColumns({
        "project": F.lit(project),
        "start_day": start,
        "end_day": end,
        **K.search_key_parts(start, end, event),
        "label": F.when(F.col("grp") == GRP_NONE, day_label(label_day)).otherwise(
            F.col("grpkey")
        ),
    })
    return finish(keyed, F.col("cnt"), F.col("value"))


LEVEL_DIMENSIONS = {"event3": "ev3", "event4": "ev4", "event5": "ev5", NATION: NATION}


def _as_cells(rows: DataFrame, grp: Column, key: Column, **fixed: Column) -> DataFrame:
    """Rows in the shape of a search cube: unnamed dimensions are wildcards."""
    dims = {d: fixed.get(d, F.lit(ANY)) for d in LEVEL_DIMENSIONS.values()}
    return rows.select(
        *[c.alias(d) for d, c in dims.items()], grp.alias("grp"), key.alias("grpkey"),
        "users", "cnt", "value",
    )


def total_cells(total: DataFrame) -> DataFrame:
    """The overall search measures as an ungrouped cube row."""
    return _as_cells(total, F.lit(GRP_NONE), F.lit(NO_GROUP_KEY))


def level_cells(levels: DataFrame) -> DataFrame:
    """One-dimensional search breakdown as cube rows filtered by each value."""
    fixed = {
        d: F.when(F.col("type") == t, F.col("prop")).otherwise(ANY)
        for t, d in LEVEL_DIMENSIONS.items()
    }
    return _as_cells(levels, F.lit(GRP_NONE), F.lit(NO_GROUP_KEY), **fixed)


def level_groups(levels: DataFrame) -> DataFrame:
    """One-dimensional search breakdown as cube rows grouped by the level."""
    code = F.create_map(
        *[F.lit(x) for t, d in LEVEL_DIMENSIONS.items() for x in (t, GRP_CODES[d])]
    )
    return _as_cells(levels, code[F.col("type")], F.col("prop"))


def reset_rows(spark: SparkSession, project: str, day: str, event: str) -> DataFrame:
    """Zero entries for the summary keys of ``day``, so that stale values disappear.

    The keys are the overall total and one breakdown per dimension.
    """
    codes = local_rows(spark, [(c,) for c in (*GRP_CODES.values(), GRP_NONE)], "grp")
    zero = F.lit(0).cast("bigint")
    cells = _as_cells(
        codes.select("grp", zero.alias("users"), zero.alias("cnt"), zero.alias("value")),
        F.col("grp"), F.lit("null"),
    )
    return search_metrics(cells, project, day, day, day, event)


def reset_then(rows: DataFrame, zeros: DataFrame) -> DataFrame:
    """``rows``, plus the zeros whose key ``rows`` does not write.

    There are five zeros, so their keys can be sent to the rows whatever their number.
    """
    keys = F.broadcast(zeros.select("cache_key"))
    written = rows.select("cache_key").join(keys, "cache_key", "left_semi").distinct()
    return rows.unionByName(zeros.join(written, "cache_key", "left_anti"))


#: Page views give way to the user metrics that carry them on, as do totals by the set rules, and the breakdown by single
#: levels, which counts every path, to the combinations, which count a user's first path.
FAMILY_ORDER = ("page_views", "history", "search_levels", "search_week", "search_day", "users")


def merge_metric_sets(first: DataFrame, *later: DataFrame) -> DataFrame:
    """Union of metric sets; a key written by several keeps the entries of the last one."""
    merged = first.select(*first.columns, F.lit(0).alias("_order"))
    for i, rows in enumerate(later, 1):
        merged = merged.unionByName(rows.withColumn("_order", F.lit(i)))
    last = merged.groupBy("cache_key").agg(F.max("_order").alias("_last"))
    kept = merged.join(last, "cache_key")
    return kept.where(F.col("_order") == F.col("_last")).select(*first.columns)


def _by_family() -> Column:
    """Later families of ``FAMILY_ORDER`` above earlier ones and these above all others."""
    named = F.array(*[F.lit(f) for f in FAMILY_ORDER])
    return F.struct(F.array_position(named, F.col("family")), "family")


def current_metrics(metrics: DataFrame) -> DataFrame:
    """The entries a reader of the store sees: per key those of its latest run.

    There is one entry for each key and label. If several families wrote it that day, it is
    that of the last one in ``FAMILY_ORDER``; families not named there come first, by name.
    """
    last = metrics.groupBy("cache_key").agg(F.max("run_day").alias("_last"))
    latest = metrics.join(last, "cache_key").where(F.col("run_day") == F.col("_last"))
    rest = [c for c in metrics.columns if c not in ("cache_key", "label")]
    entries = latest.groupBy("cache_key", "label").agg(
        F.max_by(F.struct(*rest), _by_family()).alias("_entry"))
    return entries.select("cache_key", "label", "_entry.*").select(*metrics.columns)


def previous_counts(wanted: DataFrame, metrics: DataFrame) -> DataFrame:
    """Stored count of each wanted key, 0 if it has none; of several entries that of the
    latest run, the last label and the last family, as ``current_metrics`` has them."""
    stored = (
        metrics.join(wanted.select("cache_key").distinct(), "cache_key", "left_semi")
        .groupBy("cache_key")
        .agg(F.max_by("cnt", F.struct("run_day", "label", _by_family())).alias("stored"))
    )
    return wanted.join(stored, "cache_key", "left").select(
        *wanted.columns, F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored_cnt")
    )


def with_page_views(rows: DataFrame, metrics: DataFrame, project: str, day: str) -> DataFrame:
    """Keep the page views already stored under the daily-active key of one group."""
    is_dau = _is_daily_active(day) & (F.col("project") == project)
    counted = previous_counts(rows.where(is_dau), metrics)
    counted = counted.withColumn("cnt", F.col("stored_cnt")).drop("stored_cnt")
    return rows.where(~is_dau).unionByName(counted)


def _is_daily_active(day: str) -> Column:
    return (
        (F.col("kind") == K.COMMON) & (F.col("start_day") == day) & (F.col("end_day") == day)
        & (F.col("event_pattern") == VISIT_EVENT) & (F.col("segment") == TOTAL_USER)
    )


def category_alias(
    rows: DataFrame, categories: dict[str, tuple[str, str]], day: str
) -> DataFrame:
    """Daily actives of a group, published again as a category of a roll-up project."""
    target = [
        F.struct(F.lit(g).alias("group"), F.lit(project).alias("to_project"),
                 F.lit('{"category":"%s"}' % category).alias("to_segment"))
        for g, (project, category) in categories.items()
    ]
    aliased = (
        rows.where(_is_daily_active(day))
        .select("*", F.inline(F.array(*target)))
        .where(F.col("project") == F.col("group"))
        .withColumns({"project": F.col("to_project"), "segment": F.col("to_segment")})
    )
    return finish(aliased, F.col("cnt"), F.col("value"))
