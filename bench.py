"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs on the inputs as a cluster would hold them: staged tables for the counts,
the stored search fact for the combinations. Staging is timed as a query of its own. The
variants at the end compare the chosen plans with their direct forms.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retinue.catalog import common as C
from retinue.catalog.common import DAY, PREFIX, back
from retinue.functions.days import compact
from retinue.operators import registrations, search, segments
from retinue.operators import visits as V
from retinue.operators.profile import group_totals, user_profile
from retinue.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = 3


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(CPUS, CPUS, spark__checkpoint__dir=shared,
                          spark__sql__warehouse__dir=shared + "/warehouse")
    spark.sparkContext.setLogLevel("ERROR")
    x = C.month(spark, SF_DIR)
    warehouse = C.new_warehouse(spark)
    run(x.events.limit(1))

    stored_day = F.replace("day", F.lit("-"), F.lit(""))
    stages = {
        "stage_devices": lambda: warehouse.overwrite("user_device", x.devices),
        "stage_visits": lambda: warehouse.overwrite("user_visit", V.visits(
            x.events, warehouse.table("user_device"), x.groups, back(29), DAY)),
        "stage_registers": lambda: warehouse.overwrite(
            "user_register_time", registrations.register_bounds(
                x.properties, warehouse.table("user_device"), x.groups)),
        "stage_attributes": lambda: warehouse.overwrite("user_attribute", segments.attributes(
            x.properties, warehouse.table("user_device"), x.groups, "nation").drop("attr"),
            attr="nation"),
        "stage_search": lambda: warehouse.overwrite("user_search", search.search_fact(
            search.search_paths(x.events, warehouse.table("user_device"), x.properties,
                                back(29), DAY, PREFIX)).withColumn("day", stored_day)),
    }
    seconds = {name: timed(stage) for name, stage in stages.items()}

    visits = warehouse.table("user_visit")
    bounds = warehouse.table("user_register_time")
    attrs = warehouse.table("user_attribute")
    paths = search.fact_paths(warehouse.table("user_search"), compact(back(29)), compact(DAY))
    profile = user_profile(visits, bounds, DAY)

    def one_count_per_metric() -> None:
        for days in (1, 7, 30):
            run(V.active_users(visits, DAY, days))
        run(registrations.new_users(bounds, DAY))
        run(registrations.cover_users(bounds, DAY))
        for cohort, days in ((1, 1), (6, 1), (7, 7)):
            run(registrations.retention(visits, bounds, back(cohort), back(days - 1), DAY))

    queries = {
        "daily_active": lambda: run(V.active_users(visits, DAY)),
        "monthly_active": lambda: run(V.active_users(visits, DAY, 30)),
        "retention_week": lambda: run(
            registrations.retention(visits, bounds, back(7), back(6), DAY)),
        "group_totals": lambda: run(group_totals(profile)),
        "breakdown": lambda: run(segments.breakdown(profile, attrs, "nation")),
        "search_cube": lambda: run(search.search_cube(paths)),
    }
    variants = {
        "group_totals_one_count_each": one_count_per_metric,
        "search_cube_by_explode": lambda: run(search.search_cube_by_explode(paths)),
    }
    for name, query in {**queries, **variants}.items():
        query()
        seconds[name] = min(timed(query) for _ in range(REPEATS))

    total = sum(seconds[name] for name in (*stages, *queries))
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
