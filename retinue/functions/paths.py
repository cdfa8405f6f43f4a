"""Event paths: ``name.name.ev3.ev4.ev5``, missing levels filled with a default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retinue.settings import ANY

LEVELS = ("ev3", "ev4", "ev5")
DIMENSIONS = (*LEVELS, "nation")


def level(event: Column, index: int, missing: str = ANY) -> Column:
    """Segment ``index`` of a path; empty segments at the end do not count as levels."""
    parts = F.split(F.rtrim(event, F.lit(".")), "\\.")
    return F.coalesce(F.get(parts, F.lit(index)), F.lit(missing))


def path_levels(event: Column, missing: str = ANY) -> list[Column]:
    return [level(event, i + 2, missing).alias(name) for i, name in enumerate(LEVELS)]


def event_pattern(ev3: Column, ev4: Column, ev5: Column) -> Column:
    """``a.b.*`` style pattern ending at the deepest level that is set."""
    any_ = F.lit(ANY)
    return (
        F.when(ev5 != any_, F.concat_ws(".", ev3, ev4, ev5, any_))
        .when(ev4 != any_, F.concat_ws(".", ev3, ev4, any_))
        .when(ev3 != any_, F.concat_ws(".", ev3, any_))
        .otherwise(any_)
    )


def next_prefix(prefix: Column) -> Column:
    """Exclusive upper bound of a prefix range: the last character moved up by one."""
    size = F.length(prefix)
    last = F.char(F.ascii(F.substring(prefix, size, F.lit(1))) + 1)
    return F.concat(F.substring(prefix, F.lit(1), size - 1), last)
