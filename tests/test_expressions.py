import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retinue.functions import days as D
from retinue.functions import ids as I
from retinue.functions import keys as K
from retinue.functions import paths as P
from retinue.functions.registry import register_functions
from retinue.local import local_rows

RELAXED = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "v string").select(*columns).first()


def decorated(uid: int) -> int:
    return int(hashlib.md5(str(uid).encode()).hexdigest()[:2], 16) * 2**32 + uid


def test_day_arithmetic():
    assert D.shift("2024-03-01", 1) == "2024-02-29"
    assert D.bounds_ms("2014-08-11") == (1407715200000, 1407801599999)
    # The same day eight hours east starts eight hours earlier.
    assert D.bounds_ms("2014-08-11", 8)[0] == 1407686400000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/Los_Angeles"])
def test_day_bounds_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        v = F.col("v")
        row = one(spark, "2014-08-11", D.day_start_ms(v), D.day_end_ms(v), D.day_start_ms(v, 8),
                  D.days_before(v, 11), D.days_before(v, 10, D.COMPACT), D.compact_day(v),
                  D.expand_day(D.compact_day(v)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (1407715200000, 1407801599999, 1407686400000, "2014-07-31", "20140801",
                          "20140811", "2014-08-11")


@pytest.mark.parametrize("uid", ["0", "7", "12345", "4294967295"])
def test_md5uid_round_trip(spark, uid):
    v = F.col("v")
    row = one(spark, uid, I.md5uid(v), I.truncate_uid(I.md5uid(v)))
    assert row[0] == str(decorated(int(uid)))
    assert row[1] == int(uid)


@pytest.mark.parametrize("uid", ["x", "", "1.5", None])
def test_md5uid_of_no_number_is_empty(spark, uid):
    assert one(spark, uid, I.md5uid(F.col("v")))[0] == ""


def test_sql_functions_match_the_expressions(spark):
    register_functions(spark)
    row = one(spark, "12", I.md5uid(F.col("v")), F.expr("md5uid(v)"), F.expr("md5uid('x')"))
    assert row[0] == row[1] and row[2] == ""
    key = spark.sql("SELECT metric_key('COMMON','p','d','d','visit.*','TOTAL_USER','PERIOD')")
    assert key.first()[0] == "COMMON,p,d,d,visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD"


@RELAXED
@given(uid=st.integers(0, 2**40 - 1), event=st.text("abc.", min_size=1, max_size=12))
def test_row_key_round_trip(spark, uid, event):
    row = spark.createDataFrame([(event, uid)], "e string, u long").select(
        I.decode_row_key(I.search_row_key(F.lit("20141207"), F.col("e"), F.col("u")))
    ).first()[0]
    assert (row.day, row.event, row.uid) == ("20141207", event, uid)


def expected_levels(event, missing):
    parts = event.rstrip(".").split(".")
    return [parts[i] if len(parts) > i else missing for i in (2, 3, 4)]


@RELAXED
@given(events=st.lists(st.text("ab.", min_size=1, max_size=12), min_size=1, max_size=20))
def test_path_levels(spark, events):
    rows = spark.createDataFrame([(e,) for e in events], "v string")
    got = rows.select("v", *P.path_levels(F.col("v"))).collect()
    for r in got:
        assert [r.ev3, r.ev4, r.ev5] == expected_levels(r.v, "*")


@pytest.mark.parametrize("event,levels", [
    ("pay.search2", ["XA-NA"] * 3),
    ("pay.search2.a..", ["a", "XA-NA", "XA-NA"]),
    ("pay.search2.a.b.c.d", ["a", "b", "c"]),
    ("pay.search2.a..c", ["a", "", "c"]),
])
def test_path_levels_by_hand(spark, event, levels):
    assert list(one(spark, event, *P.path_levels(F.col("v"), "XA-NA"))) == levels


@pytest.mark.parametrize("levels,pattern", [
    (("*", "*", "*"), "*"), (("a", "*", "*"), "a.*"), (("a", "b", "*"), "a.b.*"),
    (("a", "b", "c"), "a.b.c.*"), (("*", "b", "*"), "*.b.*"), (("*", "*", "c"), "*.*.c.*"),
])
def test_event_pattern(spark, levels, pattern):
    row = spark.createDataFrame([levels], "a string, b string, c string")
    assert row.select(P.event_pattern(F.col("a"), F.col("b"), F.col("c"))).first()[0] == pattern


def test_next_prefix(spark):
    assert one(spark, "pay.search2", P.next_prefix(F.col("v")))[0] == "pay.search3"


def test_segments(spark):
    by_nation = K.segment(K.value_filter("nation", F.lit("us")),
                          K.register_filter("2014-08-22", "2014-08-28"))
    row = one(spark, "x", K.segment(), by_nation)
    assert row[0] == "TOTAL_USER"
    assert row[1] == ('{"nation":"us","register_time":'
                      '{"$gte":"2014-08-22","$lte":"2014-08-28"}}')


def test_local_rows_are_small_to_the_planner(spark):
    rows = local_rows(spark, [("g", "p")], "grp", "member")
    assert "LocalTableScan" in rows._jdf.queryExecution().toString()
    assert [tuple(r) for r in rows.collect()] == [("g", "p")]
