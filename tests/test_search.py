import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retinue.functions import ids as I
from retinue.functions.ids import md5uid
from retinue.operators import search
from retinue.operators.registrations import register_bounds

PATHS = ("day string, uid string, ev3 string, ev4 string, ev5 string, nation string, "
         "count long, value decimal(38,18)")
MEASURED = [*search.DIMENSIONS, "grp", "grpkey", "users", "cnt", "value"]


def path_rows(spark, rows):
    from decimal import Decimal

    full = [("d", u, *dims, c, Decimal(v)) for u, dims, c, v in rows]
    return spark.createDataFrame(full, PATHS)


def brute_force(rows, drop=False):
    """Every filter and grouping a row takes part in, counted in plain Python."""
    cells = {}
    for uid, dims, count, value in rows:
        dims = list(dims)
        for i in (0, 1):
            if dims[i] == "*":
                dims[i + 1 : 3] = ["*"] * (2 - i)
        if drop and "*" not in dims[:3] and dims[3] == "*":
            continue
        for picks in itertools.product((0, 1), repeat=4):
            if any(p and d == "*" for p, d in zip(picks, dims)):
                continue
            fixed = [d if p else "*" for p, d in zip(picks, dims)]
            groupings = [(search.CODES[i], dims[i]) for i in range(4) if not picks[i]]
            for grp, key in [*groupings, ("6", "-")]:
                cell = cells.setdefault((*fixed, grp, key), [set(), 0, 0])
                cell[0].add(uid)
                cell[1] += count
                cell[2] += value
    return {k: (len(u), c, v) for k, (u, c, v) in cells.items()}


def as_dict(df):
    rows = df.select(*MEASURED).collect()
    assert len({tuple(r)[:6] for r in rows}) == len(rows)
    return {tuple(r)[:6]: (r.users, r.cnt, int(r.value)) for r in rows}


SHAPES = [("abcd", 48), ("abc*", 28), ("ab*d", 28), ("ab**", 16), ("a**d", 16), ("a***", 9),
          ("***d", 9), ("****", 5), ("a*cd", 16), ("*bcd", 9)]


@pytest.mark.parametrize("dims,rows", SHAPES)
def test_expansion_row_counts(spark, dims, rows):
    one = path_rows(spark, [("u", dims, 1, 1)])
    assert search.explode_event_groups(one).count() == rows
    literal = search.explode_event_groups(one, drop_full_path_without_nation=True)
    assert literal.count() == (0 if dims == "abc*" else rows)


def random_rows(seed, users, n):
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    return [(f"u{rng.randrange(users)}", (pick("ab*"), pick("cd*"), pick("ef*"), pick("xy*")),
             rng.randrange(1, 5), rng.randrange(0, 50)) for _ in range(n)]


@pytest.mark.parametrize("drop", [False, True])
@pytest.mark.parametrize("users,n", [(400, 300), (20, 300), (1, 200)])
def test_cube_equals_brute_force(spark, users, n, drop):
    rows = random_rows(users, users, n)
    paths = path_rows(spark, rows)
    expected = brute_force(rows, drop)
    assert as_dict(search.search_cube(paths, drop)) == expected
    assert as_dict(search.search_cube_by_explode(paths, drop)) == expected


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(
    st.sampled_from(["u1", "u2", "u3"]),
    st.tuples(*[st.sampled_from(["v", "w", "*"])] * 4),
    st.integers(1, 9), st.integers(0, 99)), min_size=1, max_size=25))
def test_cube_of_any_rows(spark, rows):
    assert as_dict(search.search_cube(path_rows(spark, rows))) == brute_force(rows)


def test_star_value_and_rolled_up_star_stay_apart(spark):
    """A missing level is a group key of its own and never a filter."""
    cube = as_dict(search.search_cube(path_rows(spark, [
        ("u1", ("sc", "*", "*", "ru"), 1, 522), ("u2", ("sc", "cor", "*", "ru"), 2, 10)])))
    assert cube[("sc", "*", "*", "ru", "3", "*")] == (1, 1, 522)
    assert cube[("sc", "*", "*", "ru", "3", "cor")] == (1, 2, 10)
    assert cube[("sc", "*", "*", "ru", "6", "-")] == (2, 3, 532)
    assert ("*", "*", "*", "*", "6", "-") in cube


def test_one_user_with_many_paths_counts_once(spark):
    rows = [("hot", (f"a{i}", "b", "c", "us"), 1, 1) for i in range(500)]
    cube = as_dict(search.search_cube(path_rows(spark, rows)))
    assert cube[("*", "*", "*", "*", "6", "-")] == (1, 500, 500)
    assert cube[("*", "b", "*", "us", "6", "-")] == (1, 500, 500)


def test_cube_shuffles_cells_not_copies(spark):
    """The rows themselves are exchanged twice, once per key; copies never are."""
    paths = path_rows(spark, random_rows(1, 30, 100))
    plan = search.search_cube(paths)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan
    spread = [line for line in plan.splitlines() if "Exchange hashpartitioning(uid" in line]
    assert not any("mask" in line for line in spread)


EVENTS = "pid string, uid string, event string, value double, day string"


def events_of(spark, *rows):
    return spark.createDataFrame(rows, EVENTS)


def test_prefix_match_and_repeated_events(spark):
    events = events_of(
        spark, ("p", "1", "pay.search2.b", 1.25, "d1"), ("p", "1", "pay.search2.b", 1.25, "d1"),
        ("p", "1", "pay.search20.a", 2.0, "d1"), ("p", "1", "pay.search1", 9.0, "d1"),
        ("p", "1", "pay.search2.a", 0.5, "d2"))
    rollup = {r.day: r for r in search.user_rollup(
        search.search_events(events, "d1", "d2", "pay.search2")).collect()}
    assert rollup["d1"]["count"] == 3 and float(rollup["d1"].value) == 4.5
    assert rollup["d1"].first_event == "pay.search2.b"
    assert rollup["d2"]["count"] == 1


def decorated(uid):
    import hashlib

    return str(int(hashlib.md5(uid.encode()).hexdigest()[:2], 16) * 2**32 + int(uid))


def search_inputs(spark):
    events = events_of(
        spark, ("p", "1", "pay.search2.b.c", 1.0, "d"), ("p", "1", "pay.search2.a", 2.0, "d"),
        ("p", "2", "pay.search2.a.z", 4.0, "d"), ("p", "3", "pay.search2", 8.0, "d"),
        ("q", "1", "pay.search2.q", 16.0, "d"), ("p", "9", "pay.search2", 32.0, "d"))
    devices = spark.createDataFrame(
        [("p", "1", "x"), ("p", "2", "x"), ("p", "3", "y"), ("q", "1", "x")],
        "pid string, uid string, orig_id string")
    properties = spark.createDataFrame(
        [("p", decorated("1"), "nation", "us"), ("p", decorated("2"), "nation", "br"),
         ("p", decorated("3"), "nation", " "), ("q", decorated("1"), "nation", "de")],
        "pid string, uid string, prop string, val string")
    return events, devices, properties


def found(spark):
    return search.search_paths(*search_inputs(spark), "d", "d", "pay.search2")


def test_user_paths_merge_uids_of_a_device(spark):
    """First path per table; unmapped users drop out, unknown nations stay wildcards."""
    paths = search.user_paths(found(spark))
    got = sorted((r.pid, r.uid, r.ev3, r.ev4, r.nation, r["count"], float(r.value))
                 for r in paths.collect())
    assert got == [("p", "x", "a", "*", "br", 3, 7.0), ("p", "y", "*", "*", "*", 1, 8.0),
                   ("q", "x", "q", "*", "de", 1, 16.0)]


def test_levels_keep_every_path(spark):
    typed = search.search_by_type(found(spark))
    got = {(r.type, r.prop): (r.users, r.cnt, float(r.value))
           for r in search.by_level(typed, "d", "d").collect()}
    assert got[("event3", "a")] == (1, 2, 6.0)
    assert got[("event3", "b")] == (1, 1, 1.0)
    assert got[("event4", "XA-NA")] == (2, 3, 26.0)
    # One nation per user: the smallest, with everything the user did.
    assert got[("nation", "br")] == (1, 4, 23.0)
    assert got[("nation", "XA-NA")] == (1, 1, 8.0)
    total = search.search_total(typed, "d", "d").first()
    assert (total.users, total.cnt, float(total.value)) == (2, 5, 31.0)


def test_totals_agree_over_types(spark):
    typed = search.search_by_type(found(spark))
    sums = typed.groupBy("type").agg(F.sum("count").alias("c"), F.sum("value").alias("v"))
    assert {(r.c, float(r.v)) for r in sums.collect()} == {(5, 31.0)}


def test_inputs_may_share_their_origin(spark):
    """Ids and properties cut from one table must not confuse the joins."""
    users = spark.createDataFrame(
        [("p", "1", "x", "us"), ("p", "2", "y", "de")],
        "pid string, uid string, orig_id string, val string")
    devices = users.select("pid", "uid", "orig_id")
    properties = users.select(
        "pid", I.md5uid(F.col("uid")).alias("uid"), F.lit("nation").alias("prop"), "val")
    events = users.select("pid", "uid", F.lit("pay.search2.a").alias("event"),
                          F.lit(1.5).alias("value"), F.lit("d").alias("day"))
    paths = search.user_paths(
        search.search_paths(events, devices, properties, "d", "d", "pay.search2"))
    assert sorted((r.uid, r.nation) for r in paths.collect()) == [("x", "us"), ("y", "de")]


def test_values_are_added_exactly(spark):
    tiny = [("d", "p", "u", "pay.search2", 4e-7)] * 1_000
    rows = spark.createDataFrame(
        [*tiny, ("d", "p", "v", "pay.search2", 2e12)],
        "day string, pid string, uid string, event string, value double")
    found = search.user_rollup(search.search_events(rows, None, None, "pay.search2"))
    got = {r.uid: r.value for r in found.collect()}
    assert float(got["u"]) == 4e-4 and float(got["v"]) == 2e12


def test_uids_that_are_no_numbers_have_no_properties(spark):
    devices = spark.createDataFrame(
        [("p", f"x{i}", f"d{i}") for i in range(1_000)], "pid string, uid string, orig_id string")
    properties = spark.createDataFrame(
        [("", "us", "p", "nation"), (" ", "20240101", "p", "register_time")],
        "uid string, val string, pid string, prop string")
    groups = spark.createDataFrame([("g", "p")], "grp string, member string")
    assert register_bounds(properties, devices, groups).count() == 0
    rows = devices.select("pid", "uid")
    named = search.attach_identity(rows, devices, properties)
    assert named.count() == 1_000 and named.where("nation IS NOT NULL").count() == 0


def test_properties_are_reduced_to_the_uids_of_the_day(spark):
    """A third of all users searched nothing, one stored uid has a third of all rows."""
    stored = md5uid(F.col("id").cast("string"))
    everyone = spark.range(30_000).select(
        F.lit("p").alias("pid"), F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise(stored).alias("uid"),
        F.lit("nation").alias("prop"), F.concat(F.lit("n"), F.col("id") % 50).alias("val"))
    devices = spark.range(40).select(
        F.lit("p").alias("pid"), F.col("id").cast("string").alias("uid"), F.lit("d").alias("orig_id"))
    rows = devices.select("pid", "uid")
    named = search.attach_identity(rows, devices, everyone)
    got = {r.uid: r.nation for r in named.collect()}
    assert got == {str(u): None if u % 3 == 0 else f"n{u}" for u in range(40)}
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    semi, aggregate = plan.index("Join LeftSemi"), plan.index("min(val")
    assert aggregate < semi  # outer nodes come first: the aggregate reads the reduced table
