from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from retinue.catalog import common as C
from retinue.local import local_rows
from retinue.operators import metrics as M
from retinue.operators.counters import InputCounters
from retinue.plans.daily import expire_visits, run_daily, stage_devices, write_visits
from retinue.plans.history import run_history
from retinue.plans.search import run_search, stage_search
from retinue.settings import Settings
from retinue.sources.warehouse import shared_dir
from tests.conftest import SF_DIR

SETTINGS = Settings()


def config(x):
    return x.groups.where(F.col("grp") != "all")


@pytest.fixture(scope="module")
def loaded(spark):
    x = C.month(spark, SF_DIR)
    return x, C.new_warehouse(spark, x)


def entries(rows):
    return sorted((r.cache_key, r.label, r.cnt, str(r.value), r.users) for r in rows.collect())


def test_daily_run_is_repeatable(spark, loaded):
    x, warehouse = loaded
    root = shared_dir(spark)
    stage_devices(warehouse, ["p0", "p1", "p2", "p3", "p4"])
    write_visits(warehouse, config(x), SETTINGS, C.back(29), C.back(1))
    first = entries(run_daily(warehouse, config(x), SETTINGS, C.DAY, root))
    second = entries(run_daily(warehouse, config(x), SETTINGS, C.DAY, root))
    assert first == second and len(first) > 30
    keys = [(key, label) for key, label, *_ in first]
    assert len(keys) == len(set(keys))
    totals = warehouse.table("group_totals").where(F.col("day") == C.DAY)
    assert totals.count() == totals.select("pid").distinct().count()


def test_config_names_reach_the_store_without_the_rollup(spark, loaded):
    """A group without members in the log is published with zeros."""
    x, warehouse = loaded
    quiet = config(x).unionByName(local_rows(spark, [("quiet", "nobody")], "grp", "member"))
    rows = run_daily(warehouse, quiet, SETTINGS, C.DAY, shared_dir(spark))
    zero = rows.where("project = 'quiet'").collect()
    assert len(zero) == 7 and {r.users for r in zero} == {0}


def test_search_runs(spark, loaded):
    x, warehouse = loaded
    for n in (1, 0, 0):
        stage_search(warehouse, config(x), SETTINGS, C.back(n))
    stored = warehouse.table("user_search")
    assert {r.day for r in stored.select("day").distinct().collect()} == {
        C.back(2).replace("-", ""), C.back(1).replace("-", "")}
    first = entries(run_search(warehouse, SETTINGS, C.DAY, "day"))
    assert entries(run_search(warehouse, SETTINGS, C.DAY, "day")) == first
    week = run_search(warehouse, SETTINGS, C.DAY, "week")
    assert {(r.start_day, r.end_day) for r in week.select("start_day", "end_day").collect()} == {
        (C.back(6), C.DAY)}
    # The weekly run leaves what the daily run published.
    metrics = warehouse.table("metrics")
    assert entries(metrics.where("family = 'search_day'")) == first
    current = M.current_metrics(metrics)
    assert current.where("family = 'search_week'").count() == week.count()


def test_unknown_period(loaded):
    with pytest.raises(ValueError):
        run_search(loaded[1], SETTINGS, C.DAY, "month")


def test_an_earlier_day_can_be_computed_again(spark):
    x = C.month(spark, SF_DIR)
    warehouse = C.new_warehouse(spark, x)
    stage_devices(warehouse, ["p0", "p1", "p2", "p3", "p4"])
    write_visits(warehouse, config(x), SETTINGS, C.back(29), C.DAY)
    old = warehouse.table("user_visit").limit(1).select(
        F.lit("monthly").alias("orig_id"), F.lit(C.back(31)).alias("day"), F.lit("g1").alias("pid"))
    warehouse.overwrite_found("user_visit", old)
    with pytest.warns(UserWarning):
        for day in (C.DAY, C.back(2)):
            run_daily(warehouse, config(x), SETTINGS, day, shared_dir(spark))
    mau = {(r.day, r.pid): r.mau for r in warehouse.table("group_totals").collect()}
    visits = warehouse.table("user_visit").where("pid = 'g1'")
    for day, first in ((C.DAY, C.back(29)), (C.back(2), C.back(31))):
        users = visits.where(F.col("day").between(first, day)).select("orig_id").distinct()
        assert mau[day, "g1"] == users.count()
    with pytest.raises(ValueError):
        expire_visits(warehouse, C.DAY, 29)


def test_one_entry_for_each_key_and_label(spark):
    rows = [("k", "l", 1, "d1", "users"), ("k", "l", 2, "d2", "page_views"),
            ("k", "l", 3, "d2", "users"), ("k", "m", 4, "d2", "page_views"),
            ("s", "l", 5, "d2", "search_day"), ("s", "l", 6, "d2", "search_levels"),
            ("s", "l", 7, "d1", "other")]
    metrics = spark.createDataFrame(
        rows, "cache_key string, label string, users int, run_day string, family string")
    got = {(r.cache_key, r.label): r.users for r in M.current_metrics(metrics).collect()}
    assert got == {("k", "l"): 3, ("k", "m"): 4, ("s", "l"): 5}


def test_history_keeps_columns_of_added_groups(spark):
    warehouse = C.new_warehouse(spark, C.today(spark, SF_DIR))
    x = C.today(spark, SF_DIR)
    for day, names in ((C.back(1), ["g1"]), (C.DAY, ["g1", "g2"])):
        kept = x.groups.where(F.col("grp").isin(names))
        rows = run_history(warehouse, kept, names, day, ("p1",))
    assert {"dau_g1", "dau_g2"} <= set(rows.columns)
    assert [r.dau_g2 for r in rows.where(F.col("day") == C.back(1)).collect()] == [0]


def small_inputs(spark):
    events = spark.createDataFrame(
        [("a", "1", "visit.x", "1705708800000", C.DAY), ("a", "1", "other", "1", C.DAY),
         ("a", None, None, None, C.DAY)],
        "pid string, uid string, event string, ts string, day string")
    devices = spark.createDataFrame([("a", "1", "d")], "pid string, uid string, orig_id string")
    return events, devices


def test_inputs_are_counted_by_the_read_that_uses_them(spark):
    events, devices = small_inputs(spark)
    counters = InputCounters()
    watched = counters.watch("events", events, F.col("event").startswith("visit."))
    joined = watched.where("event LIKE 'visit.%'").join(devices, ["pid", "uid"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("Scan ExistingRDD") == 2
    assert joined.count() == 1
    assert counters.counts() == [("events", 3, 1, 2)]


def test_an_input_that_a_step_skips_is_counted_by_itself(spark):
    """Without devices the result is known before the log is read."""
    events, devices = small_inputs(spark)
    counters = InputCounters()
    for source, rows, others in (("events", events, devices.where("uid = ''")),
                                 ("none", events.where("uid = ''"), devices),
                                 ("literal", events.limit(0), devices)):
        watched = counters.watch(source, rows, F.col("event").startswith("visit."))
        assert watched.distinct().join(others, ["pid", "uid"]).collect() == []
    assert counters.counts() == [("events", 3, 1, 2), ("none", 0, 0, 0), ("literal", 0, 0, 0)]


def test_counts_of_a_run_are_replaced_by_the_next_and_can_be_left_out(spark, loaded):
    x, warehouse = loaded
    day = C.back(3)
    for _ in range(2):
        run_daily(warehouse, config(x), SETTINGS, day, shared_dir(spark))
    table = warehouse.table("run_counters")
    rows = {r.source: r for r in table.where(F.col("run_day") == day).collect()}
    assert set(rows) == {"events", "id_map", "property register_time", "property nation"}
    assert rows["events"].read == x.events.where(F.col("day") == day).count()
    assert all(r.read == r.kept + r.missed > 0 for r in rows.values())
    plain = replace(SETTINGS, count_inputs=False)
    run_daily(warehouse, config(x), plain, C.back(4), shared_dir(spark))
    assert table.where(F.col("run_day") == C.back(4)).count() == 0
