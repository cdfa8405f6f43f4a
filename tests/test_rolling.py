"""State that is carried from day to day equals what the whole month gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from retinue.catalog.common import new_warehouse
from retinue.functions.days import bounds_ms, compact, shift
from retinue.local import local_rows
from retinue.operators import segments
from retinue.operators.profile import breakdown_flags, group_breakdown, rolled_profile, user_profile
from retinue.plans.daily import missing_days, stage_activity, write_visits
from retinue.plans.history import run_history, set_visits, stage_sets, stored_history
from retinue.settings import Settings

LAST = "2024-03-10"
MEMBERS = ("p0", "p1")
SETTINGS = Settings(combined={})


def days(n):
    return [shift(LAST, k) for k in reversed(range(n))]


def log(spark, visits):
    """(day, pid, uid) visits as log rows."""
    rows = [("p", u, "visit.page", 0.0, str(bounds_ms(d)[0] + 5), d, p) for d, p, u in visits]
    schema = "p string, uid string, event string, value double, ts string, day string, pid string"
    return spark.createDataFrame(rows, schema)


def ids(spark, users):
    rows = [(str(u), f"Dev-{u}", p) for p in MEMBERS for u in users]
    return spark.createDataFrame(rows, "uid string, orig_id string, pid string")


def groups(spark, **named):
    rows = [(g, m) for g, members in named.items() for m in members]
    return local_rows(spark, rows, "grp", "member")


def rows_of(df):
    return sorted(map(tuple, df.select("pid", "orig_id", "visit_mask", "reg_age", "is_cover").collect()))


def warehouse_with(spark, visits, users=20):
    w = new_warehouse(spark)
    w.overwrite_found("user_event", log(spark, visits))
    w.overwrite("user_id", ids(spark, range(users)))
    w.overwrite("user_device", ids(spark, range(users)).withColumn("orig_id", F.lower("orig_id")))
    return w


def some_visits(seed, n_days, users=20):
    rng = random.Random(seed)
    return [(d, rng.choice(MEMBERS), str(u)) for d in days(n_days) for u in range(users)
            if rng.random() < 0.15]


def rebuilt(w, day):
    return rows_of(user_profile(w.table("user_visit"), w.table("user_register_time"), day))


def test_rolled_from_any_day(spark):
    """Over 40 days, from each earlier day of the month, also where days are missing."""
    rng = random.Random(2)
    seen = [(d, f"u{u}", "g") for d in days(40)[:-3] + days(40)[-1:] for u in range(12)
            if rng.random() < 0.1]
    visits = spark.createDataFrame(seen, "day string, orig_id string, pid string").cache()
    bounds = spark.createDataFrame(
        [(f"u{u}", compact(shift(LAST, u % 9)), compact(shift(LAST, u % 9 + u % 2)), "g")
         for u in range(14)],
        "orig_id string, max_reg_time string, min_reg_time string, pid string").cache()
    want = rows_of(user_profile(visits, bounds, LAST))
    for back in (1, 2, 13, 29):
        since = shift(LAST, back)
        before = user_profile(visits.where(F.col("day") <= since), bounds.limit(3), since)
        assert rows_of(rolled_profile(before, since, visits, bounds, LAST)) == want
    # From a profile that was rolled itself, day after day.
    state = user_profile(visits, bounds, shift(LAST, 4))
    for k in (3, 2, 1, 0):
        state = rolled_profile(state, shift(LAST, k + 1), visits, bounds, shift(LAST, k))
    assert rows_of(state) == want
    for since in (LAST, shift(LAST, 30), shift(LAST, -1)):
        with pytest.raises(ValueError):
            rolled_profile(state, since, visits, bounds, LAST)


def test_activity_is_carried_on_and_forgotten_when_late_days_come(spark):
    w = warehouse_with(spark, some_visits(1, 40))
    of_groups = groups(spark, g1=MEMBERS, g2=MEMBERS[:1])
    write_visits(w, of_groups, SETTINGS, days(40)[0], LAST)
    for day in days(3):
        stage_activity(w, day)
        assert rows_of(w.table("user_activity").where(F.col("day") == day)) == rebuilt(w, day)
    assert w.days("user_activity") == set(days(3))
    # The last day needs no visit before it: those of its month could be gone.
    kept = rows_of(stage_activity(w, LAST))
    w.forget("user_visit", days(40)[0], shift(LAST, 1))
    assert rows_of(stage_activity(w, LAST)) == kept and len(missing_days(w, LAST)) == 29
    write_visits(w, of_groups, SETTINGS, days(40)[0], shift(LAST, 1))
    for day in days(3):
        stage_activity(w, day)

    late = [(shift(LAST, 1), "p0", str(u)) for u in range(15, 20)]
    w.overwrite_found("user_event", log(spark, late))
    write_visits(w, of_groups, SETTINGS, shift(LAST, 1), shift(LAST, 1))
    assert w.days("user_activity") == {shift(LAST, 2)}
    now = rows_of(stage_activity(w, LAST))
    assert now == rebuilt(w, LAST) and now != kept
    # An earlier day, computed again, is built from its own month.
    old = shift(LAST, 5)
    assert rows_of(stage_activity(w, old)) == rebuilt(w, old)
    # A group that has lost all its users loses its partition.
    assert {p["pid"] for p in w.partitions("user_activity", LAST, LAST)} == {"g1", "g2"}
    w.forget("user_visit", days(40)[0], LAST)
    w.forget("user_activity", days(40)[0], shift(LAST, 1))
    assert rows_of(stage_activity(w, LAST)) == []


def test_one_day_of_the_log_is_read(spark):
    visits = some_visits(3, 6)
    w = warehouse_with(spark, visits)
    of_groups = groups(spark, g1=MEMBERS)
    first = run_history(w, of_groups, ("g1",), days(2)[0], ()).collect()
    assert w.days("user_set_visit") == set(days(6)[:-1]) and len(first) == 1
    # What is staged already is not looked for in the log again.
    known = {(d, p) for d, p, _ in visits if d != LAST}
    w.overwrite_found("user_event", log(spark, [(d, p, "19") for d, p in known]))
    assert set(stage_sets(w, MEMBERS, LAST, ())) == {LAST}
    last = {r.day: r for r in run_history(w, of_groups, ("g1",), LAST, ()).collect()}
    seen = {(d, u) for d, _, u in visits}
    assert last[LAST].dau_g1 == len({u for d, u in seen if d == LAST})
    assert last[LAST].wau_g1 == last[LAST].mau_g1 == len({u for _, u in seen})
    plan = set_visits(w.table("user_event").where(
        (F.col("day") == LAST) & F.col("pid").isin(*MEMBERS)), w.table("user_id"), LAST, LAST, ())
    files = [f for f in plan.inputFiles() if "user_event" in f]
    assert files and all(f"day={LAST}" in f for f in files)


def test_a_group_that_comes_later_has_its_members_past(spark):
    visits = [*some_visits(4, 5), (LAST, "p0", "1")]
    w = warehouse_with(spark, visits)
    run_history(w, groups(spark, g1=MEMBERS[:1]), ("g1",), shift(LAST, 1), ())
    assert {p["pid"] for p in w.partitions("user_set_visit", days(5)[0], LAST)} == {"p0"}
    rows = run_history(w, groups(spark, g1=MEMBERS[:1], g2=MEMBERS), ("g1", "g2"), LAST, ())
    wide = {r.day: r for r in rows.collect()}
    assert wide[shift(LAST, 1)].dau_g2 == 0 and set(wide) == set(days(2))
    assert wide[LAST].wau_g2 == len({u for _, _, u in visits})
    assert wide[LAST].wau_g1 == len({u for _, p, u in visits if p == "p0"})
    published = w.table("metrics").where("family = 'history' AND run_day = '%s'" % LAST)
    assert published.count() == 14 and stored_history(w, ("g1",), 1).count() == 1
    # A day without any visitor is staged, not missing.
    assert set(stage_sets(w, ("p0", "p9"), LAST, ())) == {LAST}
    assert set(stage_sets(w, ("p0", "p9"), shift(LAST, -1), ())) == {shift(LAST, -1)}


def test_breakdown_of_all_attributes_at_once(spark):
    rng = random.Random(6)
    profile = spark.createDataFrame(
        [(g, f"u{u}", rng.randrange(64), rng.choice([None, 0, 1, 2, 6]), False)
         for g in ("g1", "g2") for u in range(40)],
        "pid string, orig_id string, visit_mask long, reg_age int, is_cover boolean")
    names = ("nation", "language", "nowhere")
    attrs = spark.createDataFrame(
        [(g, a, f"u{u}", v) for g in ("g1", "g2") for a in (*names[:2], "other") for u in range(30)
         for v in sorted({rng.choice("xyz") for _ in range(rng.randrange(3))})],
        "pid string, attr string, orig_id string, val string")
    got = segments.breakdown(profile, attrs, *names)
    counts = list(breakdown_flags())
    for name in names:
        alone = segments.with_attribute(profile, attrs, name).withColumn("attr", F.lit(name))
        want = group_breakdown(alone).where(" + ".join(counts) + " > 0")
        of = [r for r in got.select(*want.columns).collect() if r.attr == name]
        assert sorted(map(tuple, of)) == sorted(map(tuple, want.collect()))


def test_attributes_are_read_once(spark):
    w = new_warehouse(spark)
    plan = segments.breakdown(w.table("user_activity"), w.table("user_attribute"), *"abcd")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("user_attribute") == 1 and text.count("user_activity") == 1
