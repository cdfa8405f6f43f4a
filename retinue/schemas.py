"""Table schemas of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
# Wide enough to add up single values without rounding any of them first.
VALUE = EVENT_VALUE = T.DecimalType(38, 18)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


USER_EVENT = _schema(
    ("p", STRING), ("uid", STRING), ("event", STRING), ("value", EVENT_VALUE), ("ts", STRING),
    ("day", STRING), ("pid", STRING),
)
USER_PROPERTY = _schema(("uid", STRING), ("val", STRING), ("pid", STRING), ("prop", STRING))
USER_ID = _schema(("uid", STRING), ("orig_id", STRING), ("pid", STRING))
USER_DEVICE = _schema(("uid", STRING), ("orig_id", STRING), ("pid", STRING))
USER_VISIT = _schema(("orig_id", STRING), ("day", STRING), ("pid", STRING))
USER_ACTIVITY = _schema(
    ("orig_id", STRING), ("visit_mask", LONG), ("reg_age", T.IntegerType()),
    ("is_cover", T.BooleanType()), ("day", STRING), ("pid", STRING),
)
USER_REGISTER_TIME = _schema(
    ("orig_id", STRING), ("max_reg_time", STRING), ("min_reg_time", STRING), ("pid", STRING)
)
USER_ATTRIBUTE = _schema(("orig_id", STRING), ("val", STRING), ("attr", STRING), ("pid", STRING))
USER_SEARCH_PATH = _schema(
    ("uid", STRING), ("orig_id", STRING), ("event", STRING), ("nation", STRING),
    ("count", LONG), ("value", VALUE), ("day", STRING), ("pid", STRING),
)
USER_SEARCH = _schema(
    ("uid", STRING), ("events", T.ArrayType(STRING)), ("count", LONG), ("value", VALUE),
    ("day", STRING),
)
USER_SEARCH_BY_TYPE = _schema(
    ("uid", STRING), ("prop", STRING), ("num", LONG), ("count", LONG), ("value", VALUE),
    ("day", STRING), ("type", STRING),
)
METRICS = _schema(
    ("kind", STRING), ("project", STRING), ("start_day", STRING), ("end_day", STRING),
    ("event_pattern", STRING), ("segment", STRING), ("grouping", STRING),
    ("cache_key", STRING), ("label", STRING), ("cnt", LONG), ("value", VALUE),
    ("users", LONG), ("sample_rate", DOUBLE), ("run_day", STRING), ("family", STRING),
)
RUN_COUNTERS = _schema(
    ("source", STRING), ("read", LONG), ("kept", LONG), ("missed", LONG), ("run_day", STRING),
)
TOTALS = ("dau", "wau", "mau", "new_users", "cover_users", "total_new", "ret_day2", "ret_day7",
          "ret_week")
GROUP_TOTALS = _schema(*((m, LONG) for m in TOTALS), ("day", STRING), ("pid", STRING))
SET_TOTALS = _schema(*((m, LONG) for m in TOTALS), ("pid", STRING), ("day", STRING))
BREAKDOWNS = ("active", "new", "new_7d", "ret_day2", "ret_day7", "ret_week", "ladder_5",
              "ladder_4", "ladder_3", "ladder_2")
GROUP_BREAKDOWN = _schema(
    ("pid", STRING), ("attr_value", STRING), *((m, LONG) for m in BREAKDOWNS),
    ("day", STRING), ("attr", STRING),
)
HISTORY_METRICS = ("dau", "wau", "mau", "new_users", "ret_week", "ret_day2", "ret_day7")

# Raw inputs, kept as tab-separated text where others write them.
RAW_TABLES = ("user_event", "user_property", "user_id")

# Table -> (schema, partition columns).
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "user_event": (USER_EVENT, ("day", "pid")),
    "user_property": (USER_PROPERTY, ("pid", "prop")),
    "user_id": (USER_ID, ("pid",)),
    "user_device": (USER_DEVICE, ("pid",)),
    "user_visit": (USER_VISIT, ("day", "pid")),
    "user_activity": (USER_ACTIVITY, ("day", "pid")),
    "user_set_visit": (USER_VISIT, ("day", "pid")),
    "user_register_time": (USER_REGISTER_TIME, ("pid",)),
    "user_attribute": (USER_ATTRIBUTE, ("attr", "pid")),
    "user_search_path": (USER_SEARCH_PATH, ("day", "pid")),
    "user_search": (USER_SEARCH, ("day",)),
    "user_search_by_type": (USER_SEARCH_BY_TYPE, ("day", "type")),
    "group_totals": (GROUP_TOTALS, ("day", "pid")),
    "set_totals": (SET_TOTALS, ("day",)),
    "group_breakdown": (GROUP_BREAKDOWN, ("day", "attr")),
    "metrics": (METRICS, ("run_day", "family")),
    "run_counters": (RUN_COUNTERS, ("run_day",)),
}
