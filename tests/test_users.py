import hashlib

from pyspark.sql import functions as F

from retinue.catalog import common as C
from retinue.functions.days import bounds_ms, shift
from retinue.local import local_rows
from retinue.operators import identity, registrations, segments
from retinue.operators import visits as V
from retinue.operators.profile import group_totals, user_profile

DAY = "2024-01-20"
SF = "/root/testdata/sf0.01"


def decorated(uid):
    return str(int(hashlib.md5(uid.encode()).hexdigest()[:2], 16) * 2**32 + int(uid))


def events_of(spark, *rows):
    return spark.createDataFrame(rows, "pid string, uid string, event string, ts string, day string")


def devices_of(spark, *rows):
    ids = spark.createDataFrame(rows, "pid string, uid string, orig_id string")
    return identity.device_ids(ids)


def groups_of(spark):
    return local_rows(spark, [("g", "a"), ("g", "b"), ("h", "b")], "grp", "member")


def test_known_values_at_the_test_day(spark):
    """Figures for one day of the sample data, found with another engine."""
    x = C.month(spark, SF)
    bounds = C.bounds_of(x).cache()
    rows = C.visits_of(x).cache()
    totals = {r.pid: r for r in group_totals(user_profile(rows, bounds, DAY)).collect()}
    assert [totals[g].new_users for g in ("g1", "g2", "all")] == [3, 5, 4]
    assert [totals[g].cover_users for g in ("g1", "g2", "all")] == [3, 8, 5]
    assert [totals[g].ret_day2 for g in ("g1", "g2", "all")] == [2, 3, 3]
    assert [totals[g].ret_day7 for g in ("g1", "g2", "all")] == [3, 1, 4]
    assert [totals[g].ret_week for g in ("g1", "g2", "all")] == [4, 3, 4]
    assert totals["g1"].dau == 43
    for r in totals.values():
        assert r.dau <= r.wau <= r.mau
        assert r.total_new == r.new_users + r.cover_users
    assert totals["all"].dau <= totals["g1"].dau + totals["g2"].dau


def test_profile_equals_separate_counts(spark):
    x = C.month(spark, SF)
    bounds, rows = C.bounds_of(x).cache(), C.visits_of(x).cache()
    totals = group_totals(user_profile(rows, bounds, DAY))

    def column(name):
        return {r.pid: r[name] for r in totals.collect() if r[name]}

    def counts(df, name="users"):
        return {r.pid: r[name] for r in df.collect() if r[name]}

    assert column("dau") == counts(V.active_users(rows, DAY))
    assert column("wau") == counts(V.active_users(rows, DAY, 7))
    assert column("mau") == counts(V.active_users(rows, DAY, 30))
    assert column("new_users") == counts(registrations.new_users(bounds, DAY))
    assert column("cover_users") == counts(registrations.cover_users(bounds, DAY), "cover")
    assert column("ret_week") == counts(
        registrations.retention(rows, bounds, shift(DAY, 7), shift(DAY, 6), DAY))


def test_cover_and_new_are_disjoint(spark):
    bounds = C.bounds_of(C.today(spark, SF))
    today = DAY.replace("-", "")
    new = bounds.where(F.col("min_reg_time") == today).select("pid", "orig_id")
    cover = bounds.where((F.col("max_reg_time") == today) & (F.col("min_reg_time") < today))
    assert new.intersect(cover.select("pid", "orig_id")).count() == 0


def test_day_range_is_inclusive_and_numeric(spark):
    first, last = bounds_ms(DAY)
    ts = [str(first - 1), str(first), str(last), str(last + 1), "", "soon", "9"]
    events = events_of(spark, *[("a", str(i), "visit.x", t, DAY) for i, t in enumerate(ts)])
    kept = V.visit_events(events, DAY, DAY).select("uid").collect()
    assert sorted(r.uid for r in kept) == ["1", "2"]


def test_heartbeat_rules(spark):
    ts = str(bounds_ms(DAY)[0])
    events = events_of(spark, ("a", "1", "visit.x", ts, DAY),
                       ("a", "2", "ientheartbeat.x", ts, DAY),
                       ("b", "3", "ientheartbeat.x", ts, DAY), ("b", "4", "visitor", ts, DAY))

    def kept(pids):
        return sorted(r.uid for r in V.visit_events(events, DAY, DAY, pids).collect())

    assert kept(None) == ["1", "2", "3"]
    assert kept(["b"]) == ["1", "3"]
    assert kept([]) == ["1"]


def test_visits_are_distinct_lower_cased_devices_per_group(spark):
    ts = str(bounds_ms(DAY)[0])
    events = events_of(spark, ("a", "1", "visit.x", ts, DAY), ("a", "1", "visit.y", ts, DAY),
                       ("a", "2", "visit.x", ts, DAY), ("b", "5", "visit.x", ts, DAY),
                       ("c", "1", "visit.x", ts, DAY), ("a", "7", "visit.x", ts, DAY))
    devices = devices_of(spark, ("a", "1", "DEV"), ("a", "2", "dev"), ("b", "5", "Other"),
                         ("c", "1", "z"), ("a", "7", None), ("a", "7", " "), ("a", "1", "DEV"))
    got = V.visits(events, devices, groups_of(spark), DAY, DAY).collect()
    assert sorted((r.pid, r.orig_id) for r in got) == [
        ("g", "dev"), ("g", "other"), ("h", "other")]
    assert len(got) == 3


def test_unmapped_visitors_can_share_an_id(spark):
    ids = spark.createDataFrame([("a", "1", None), ("a", "2", ""), ("a", "3", "K")],
                                "pid string, uid string, orig_id string")
    got = identity.device_ids(ids, "***").collect()
    assert sorted((r.uid, r.orig_id) for r in got) == [("1", "***"), ("2", "***"), ("3", "k")]


def test_bounds_compare_full_times_before_cutting(spark):
    devices = devices_of(spark, ("a", "1", "D"), ("b", "5", "d"), ("a", "2", "E"))
    properties = spark.createDataFrame(
        [("a", decorated("1"), "register_time", "20240103110000"),
         ("b", decorated("5"), "register_time", "20240101235959"),
         ("b", decorated("5"), "register_time", "20240105000000"),
         ("a", decorated("2"), "register_time", "  "), ("a", decorated("2"), "nation", "us"),
         ("a", "2", "register_time", "20200101000000")],
        "pid string, uid string, prop string, val string")
    bounds = registrations.register_bounds(properties, devices, groups_of(spark))
    got = {(r.pid, r.orig_id): (r.min_reg_time, r.max_reg_time) for r in bounds.collect()}
    assert got == {("g", "d"): ("20240101", "20240105"), ("h", "d"): ("20240101", "20240105")}
    both = registrations.combine_bounds(bounds, ("g", "h"), "all").collect()
    assert [tuple(r[c] for c in ("pid", "orig_id", "min_reg_time", "max_reg_time"))
            for r in both] == [("all", "d", "20240101", "20240105")]


def test_attribute_values_fan_out_and_default(spark):
    users = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a")], "pid string, orig_id string")
    attrs = spark.createDataFrame(
        [("g", "nation", "a", "us"), ("g", "nation", "a", "br"), ("g", "geoip", "b", "de")],
        "pid string, attr string, orig_id string, val string")
    got = {(r.pid, r.attr_value): r.users
           for r in segments.count_by_attr(users, attrs, "nation").collect()}
    assert got == {("g", "us"): 1, ("g", "br"): 1, ("g", "XA-NA"): 1, ("h", "XA-NA"): 1}


def test_retention_windows(spark):
    """The lower end of a visit window counts; the registration day itself does not."""
    bounds = spark.createDataFrame(
        [("g", u, "20240113", "20240113") for u in "abc"],
        "pid string, orig_id string, max_reg_time string, min_reg_time string")
    visits = spark.createDataFrame(
        [("g", "a", "2024-01-14"), ("g", "b", "2024-01-13"), ("g", "c", "2024-01-20")],
        "pid string, orig_id string, day string")
    kept = registrations.retained_set(visits, bounds, "2024-01-13", "2024-01-14", DAY)
    assert sorted(r.orig_id for r in kept.collect()) == ["a", "c"]
    assert group_totals(user_profile(visits, bounds, DAY)).first().ret_week == 2


def test_groups_do_not_shuffle_the_log(spark):
    x = C.today(spark, SF)
    plan = V.visits(x.events, x.devices, x.groups, DAY, DAY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(pid#" not in "".join(
        line.split(", uid")[0] for line in text.splitlines() if "hashpartitioning(pid#" in line
        and "uid" not in line)
    assert "CartesianProduct" not in text


def test_day_filter_reaches_the_scan(spark):
    events = C.today(spark, SF).events
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_skewed_inputs_equal_brute_force(spark):
    """A third of the log is one uid, a third of the uids share one device."""
    ts = bounds_ms(DAY)[0]
    log = [("a" if i % 4 else "b", "0" if i % 3 == 0 else str(i % 200), "visit.x", str(ts + i), DAY)
           for i in range(6_000)]
    ids = [(p, str(u), "shared" if u % 3 == 0 else f"d{u}") for p in "ab" for u in range(150)]
    groups = {"g": "ab", "h": "b"}
    expected = {
        (g, device) for p, uid, *_ in log for i, u, device in ids if (i, u) == (p, uid)
        for g, members in groups.items() if p in members
    }
    events, devices = events_of(spark, *log), devices_of(spark, *ids)
    got = V.visits(events, devices, groups_of(spark), DAY, DAY).collect()
    assert sorted((r.pid, r.orig_id) for r in got) == sorted(expected)
