"""Text keys and segments of published metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retinue.functions.paths import event_pattern
from retinue.settings import ANY, GRP_CODES, GRP_NONE, KEY_FILTER, NATION, SEARCH_EVENT, TOTAL_USER

COMMON = "COMMON"
GROUP = "GROUP"
PERIOD = "PERIOD"


def register_filter(first: str, last: str) -> str:
    return '"register_time":{"$gte":"%s","$lte":"%s"}' % (first, last)


def value_filter(attr: str, value: Column) -> Column:
    return F.concat(F.lit('"%s":"' % attr), value, F.lit('"'))


def segment(*filters: Column | str) -> Column:
    """JSON filter made of ``filters``; without any it is the all-users segment."""
    if not filters:
        return F.lit(TOTAL_USER)
    parts = [F.lit(f) if isinstance(f, str) else f for f in filters]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def metric_key(kind, project, start, end, event, segment_, grouping) -> Column:
    return F.concat_ws(
        ",", kind, project, start, end, event, segment_, F.lit(KEY_FILTER), grouping
    )


METRIC_KEY_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION metric_key(kind STRING, project STRING, "
    "start_day STRING, end_day STRING, event STRING, segment STRING, grouping STRING) "
    "RETURNS STRING RETURN concat_ws(',', kind, project, start_day, end_day, event, segment, "
    f"'{KEY_FILTER}', grouping)"
)


def metric_entry(cnt, value, users, rate) -> Column:
    """``[count, value, users, rate]`` as stored under a label."""
    number = "decimal(38,18)"
    return F.array(*(c.cast(number) for c in (cnt, value, users, rate)))


def search_key_parts(start: Column, end: Column, event: str = SEARCH_EVENT) -> dict[str, Column]:
    """Kind, event pattern, segment and grouping of a search cube row.

    A total over more than one day is keyed as ``GROUP … EVENT,6``; stored keys rely on it.
    """
    ev3, ev4, ev5, nation, grp = (F.col(c) for c in ("ev3", "ev4", "ev5", NATION, "grp"))
    is_common = (grp == GRP_NONE) & (start == end)
    any_nation = nation == ANY
    by_nation = any_nation & (grp == GRP_CODES["nation"])
    return {
        "kind": F.when(is_common, COMMON).otherwise(GROUP),
        "event_pattern": F.concat(F.lit(event + "."), event_pattern(ev3, ev4, ev5)),
        "segment": F.when(any_nation, TOTAL_USER).otherwise(
            segment(value_filter(NATION, nation))
        ),
        "grouping": F.when(is_common, PERIOD)
        .when(by_nation, "USER_PROPERTIES," + NATION)
        .otherwise(F.concat(F.lit("EVENT,"), grp)),
    }
