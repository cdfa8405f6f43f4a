import json
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retinue import schemas
from retinue.catalog.common import new_warehouse
from retinue.operators import history
from retinue.operators import metrics as M
from retinue.operators.search import search_events
from retinue.schemas import TABLES
from retinue.settings import Settings
from retinue.sources import logs, store
from retinue.sources.warehouse import Warehouse, cut_lineage, shared_dir
from tests.file_store import FileStore

DAY = "2024-01-20"
VISIT = "orig_id string, day string, pid string"


def visits(spark, *rows):
    return spark.createDataFrame(rows, VISIT)


def stored(warehouse, table="user_visit"):
    return sorted(tuple(r) for r in warehouse.table(table).collect())


def write_lines(path, lines, name="part-0"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("".join(line + "\n" for line in lines))


# --- raw text ------------------------------------------------------------------------


def test_read_events_slices_days_and_pids(spark, tmp_path):
    for day in ("2024-01-18", "2024-01-19", "2024-01-20", "2024-01-21"):
        for pid in ("a", "b"):
            write_lines(f"{tmp_path}/day={day}/pid={pid}",
                        [f'p\t{pid}1\tvisit."quoted"\t1.5\t{day}'])
    write_lines(f"{tmp_path}/day=2024-01-20/pid=a", ["p\tx\ty\t1\t1"], name="notes.txt")
    one = logs.read_events(spark, str(tmp_path), DAY, ["a"]).collect()
    assert [(r.uid, r.event, r.value, r.day, r.pid) for r in one] == [
        ("a1", 'visit."quoted"', 1.5, DAY, "a")]
    assert logs.read_events(spark, str(tmp_path), DAY, ["a", "b"], days=2).count() == 4
    assert logs.read_events(spark, str(tmp_path), DAY, ["b"], days=30).count() == 3


def test_values_are_read_digit_by_digit(spark, tmp_path):
    """Digits that a double cannot hold arrive, text that is no number does not."""
    texts = ["12345678901234567.123456789012345678", "0.000000000000000001", "1.5E3", "x", ""]
    write_lines(f"{tmp_path}/day={DAY}/pid=a",
                [f"p\t{i}\tpay.search2\t{text}\t1" for i, text in enumerate(texts)])
    found = search_events(logs.read_events(spark, str(tmp_path), DAY, ["a"]), DAY, DAY, "pay")
    assert [r.value for r in found.orderBy("uid").collect()] == [
        Decimal(texts[0]), Decimal("1E-18"), Decimal(1500), None, None]


def test_only_the_wanted_partitions_are_looked_at(spark, tmp_path):
    """A folder of another day that is no partition, or of another project, does no harm."""
    for day in ("2024-01-19", "2024-01-20"):
        write_lines(f"{tmp_path}/day={day}/pid=a", ["p\t1\tvisit.x\t1\t1"])
    write_lines(f"{tmp_path}/day=2024-01-18/broken=1/pid=a/deeper=2", ["no log"])
    write_lines(f"{tmp_path}/other", ["no log"])
    write_lines(f"{tmp_path}/day=2024-01-20/pid=b", ["\0"])
    rows = logs.read_events(spark, str(tmp_path), DAY, ["a", "absent"], days=2)
    assert {r.day for r in rows.collect()} == {"2024-01-19", "2024-01-20"}
    assert all("/pid=a/" in f for f in rows.inputFiles()) and len(rows.inputFiles()) == 2
    assert logs.read_events(spark, str(tmp_path), "2025-01-01", ["a"]).collect() == []
    write_lines(f"{tmp_path}/props/pid=a/prop=nation", ["1\tus"])
    write_lines(f"{tmp_path}/props/pid=broken", ["no partition"])
    got = logs.read_properties(spark, f"{tmp_path}/props", "nation", ["a", "c"]).collect()
    assert [(r.uid, r.val, r.pid, r.prop) for r in got] == [("1", "us", "a", "nation")]


def test_names_of_partitions_may_hold_any_character(spark, tmp_path):
    odd = ["a b", "x=y", "50%", "q?[1]{2}*", "c,d", "e/f"]
    rows = spark.createDataFrame([("p", "1", "visit.x", Decimal(1), "1", DAY, p) for p in odd],
                                 schemas.USER_EVENT)
    rows.write.partitionBy("day", "pid").option("sep", "\t").csv(f"{tmp_path}/log")
    for name in odd:
        got = logs.read_events(spark, f"{tmp_path}/log", DAY, [name]).collect()
        assert [r.pid for r in got] == [name]


def test_id_map_lines_need_two_fields(spark, tmp_path):
    write_lines(f"{tmp_path}/pid=a", ["1\tDev", "2", "3\tx\ty", "4\t"])
    got = {r.uid: r.orig_id for r in logs.read_id_map(spark, str(tmp_path)).collect()}
    assert got == {"1": "Dev", "2": None, "3": None, "4": None}


def test_jobs_read_the_id_map_by_the_rule_of_its_reader(spark, tmp_path):
    write_lines(f"{tmp_path}/raw/user_id/pid=a", ["1\tDev", "2", "3\tx\ty", "4\t", "\t5", ""])
    write_lines(f"{tmp_path}/raw/user_id/pid=b", ["1\tOther"])
    warehouse = Warehouse(spark, f"lines_{uuid.uuid4().hex}", f"{tmp_path}/tables")
    for _ in range(2):
        warehouse.create_tables(f"{tmp_path}/raw")
    done = warehouse.add_partitions("user_id", [{"pid": "a"}, {"pid": "none"}])
    assert [r.error for r in done] == [None, None]
    key = lambda r: (r.pid, r.uid, r.orig_id or "")
    of_table = sorted(map(key, warehouse.table("user_id").collect()))
    read = logs.read_id_map(spark, f"{tmp_path}/raw/user_id").where("pid = 'a'")
    assert of_table == sorted(map(key, read.collect()))
    assert ("a", "1", "Dev") in of_table and ("a", "3", "") in of_table
    only = warehouse.table("user_id").where("pid = 'a'")
    assert "PartitionFilters: [isnotnull(pid" in only._jdf.queryExecution().toString()
    assert warehouse.discover("user_id").count() == 3
    warehouse.drop_partitions("user_id", [{"pid": "a"}])
    assert [r.pid for r in warehouse.table("user_id").collect()] == ["b"]


def test_properties_of_one_kind(spark, tmp_path):
    write_lines(f"{tmp_path}/pid=a/prop=nation", ["1\tus", "2\t"])
    write_lines(f"{tmp_path}/pid=a/prop=register_time", ["1\t20240101000000"])
    write_lines(f"{tmp_path}/pid=b/prop=nation", ["1\tde"])
    got = logs.read_properties(spark, str(tmp_path), "nation", ["a"]).collect()
    assert sorted((r.uid, r.val) for r in got) == [("1", "us"), ("2", None)]


def test_group_config(spark, tmp_path):
    path = f"{tmp_path}/groups.json"
    with open(path, "w") as f:
        json.dump([{"project": "g1", "members": "a:x,b:y"}, {"project": "g2", "members": "c"}], f)
    got = sorted(tuple(r) for r in logs.read_groups(spark, path).collect())
    assert got == [("g1", "a"), ("g1", "b"), ("g2", "c")]


def test_dimension_read_is_split_by_key():
    options = logs.dimension_options("jdbc:x", "(SELECT 1) t", "id", 0, 1000, 8, 500)
    assert options == {"url": "jdbc:x", "dbtable": "(SELECT 1) t", "partitionColumn": "id",
                       "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
                       "fetchsize": "500"}


def test_lookup_keeps_dimension_rows_once(spark):
    keys = spark.createDataFrame([("1",), ("1",), ("9",)], "uid string")
    dim = spark.createDataFrame([("1", "x"), ("2", "y")], "uid string, v string")
    assert [tuple(r) for r in logs.lookup(keys, dim, ["uid"]).collect()] == [("1", "x")]


# --- warehouse -------------------------------------------------------------------------


def test_create_tables_twice(spark):
    warehouse = new_warehouse(spark)
    assert warehouse.create_tables() == list(TABLES)
    for name, (schema, partitions) in TABLES.items():
        table = warehouse.table(name)
        assert set(table.columns) == {f.name for f in schema}
        assert table.columns[-len(partitions):] == list(partitions)


def test_overwrite_replaces_only_the_fixed_part(spark):
    warehouse = new_warehouse(spark)
    rows = visits(spark, ("a", "2024-01-19", "g"), ("b", DAY, "g"), ("c", DAY, "h"))
    warehouse.overwrite_found("user_visit", rows)
    again = visits(spark, ("z", DAY, "g")).drop("day")
    for _ in range(2):
        warehouse.overwrite("user_visit", again, day=DAY)
    # Group h no longer has visitors on the day, so its old partition is gone.
    assert stored(warehouse) == [("a", "2024-01-19", "g"), ("z", DAY, "g")]
    warehouse.overwrite("user_visit", again.limit(0), day=DAY)
    assert stored(warehouse) == [("a", "2024-01-19", "g")]


def test_overwrite_found_keeps_other_partitions(spark):
    warehouse = new_warehouse(spark)
    warehouse.overwrite_found("user_visit", visits(spark, ("a", "d1", "g"), ("b", "d1", "h")))
    warehouse.overwrite_found("user_visit", visits(spark, ("c", "d1", "g")))
    assert stored(warehouse) == [("b", "d1", "h"), ("c", "d1", "g")]


def test_expire_drops_old_days_and_their_files(spark):
    warehouse = new_warehouse(spark)
    days = ("2023-12-20", "2023-12-21", "2024-01-19", DAY)
    warehouse.overwrite_found("user_visit", visits(spark, *[("a", d, "g") for d in days]))
    assert warehouse.expire("user_visit", DAY) == ["day=2023-12-20/pid=g"]
    warehouse.discover("user_visit")
    assert [r[1] for r in stored(warehouse)] == list(days[1:])
    assert warehouse.expire("user_visit", DAY) == []


def test_partition_values_with_special_characters(spark):
    warehouse = new_warehouse(spark)
    name = "it's a:b\\c"
    warehouse.overwrite_found("user_visit", visits(spark, ("a", "2023-01-01", name)))
    rows = visits(spark, ("b", DAY, name)).drop("day")
    warehouse.overwrite("user_visit", rows, day=DAY)
    warehouse.expire("user_visit", DAY)
    assert stored(warehouse) == [("b", DAY, name)]
    values = spark.createDataFrame([("a", "v", "g")], "orig_id string, val string, pid string")
    for _ in range(2):
        warehouse.overwrite("user_attribute", values, attr=name)
    assert stored(warehouse, "user_attribute") == [("a", "v", name, "g")]


def test_partitions_are_discovered_and_added(spark, tmp_path):
    for day in ("2024-01-19", DAY):
        write_lines(f"{tmp_path}/user_event/day={day}/pid=a", ["p\t1\tvisit.x\t1\t5"])
    name = shared_dir(spark)
    warehouse = Warehouse(spark, name.rsplit("/", 1)[1].replace("-", "_"), name)
    warehouse.create_tables(str(tmp_path))
    assert warehouse.table("user_event").count() == 0
    for _ in range(2):
        warehouse.add_partitions("user_event", [{"day": DAY, "pid": "a"},
                                                {"day": DAY, "pid": "not-there"}])
        assert warehouse.table("user_event").count() == 1
    for _ in range(2):
        found = warehouse.discover("user_event").collect()
        assert warehouse.table("user_event").count() == 2
    assert "day=2024-01-19/pid=a" in [r.partition for r in found]


def test_checkpoint_goes_to_the_shared_folder(spark):
    cut = cut_lineage(spark.range(5).withColumn("x", F.lit(1)))
    assert cut.count() == 5
    assert "ExistingRDD" in cut._jdf.queryExecution().toString()
    assert os.listdir(spark.conf.get("spark.checkpoint.dir"))


# --- metric rows -------------------------------------------------------------------------


def totals(spark, **values):
    names = [s.metric for s in (*M.TOTALS, *M.COVER)]
    row = ("shop", *[values.get(n, 0) for n in names])
    return spark.createDataFrame([row], "pid string, " + ", ".join(f"{n} long" for n in names))


def by_key(rows):
    return {(r.cache_key, r.label): r.users for r in rows.collect()}


def test_total_keys(spark):
    """Keys as readers of the store know them."""
    rows = by_key(M.total_metrics(totals(spark, dau=5, wau=9, ret_week=2), "2014-08-13"))
    label = "2014-08-13 00:00"
    assert rows[("COMMON,shop,2014-08-13,2014-08-13,visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD",
                 label)] == 5
    assert rows[("COMMON,shop,2014-08-06,2014-08-13,visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD",
                 label)] == 9
    assert rows[("COMMON,shop,2014-07-14,2014-08-13,visit.*,TOTAL_USER,VF-ALL-0-0,PERIOD",
                 label)] == 0
    week = ('COMMON,shop,2014-08-07,2014-08-13,visit.*,{"register_time":'
            '{"$gte":"2014-08-06","$lte":"2014-08-06"}},VF-ALL-0-0,PERIOD')
    assert rows[(week, label)] == 2
    assert len(rows) == 7


def test_cover_keys(spark):
    rows = by_key(M.total_metrics(totals(spark, cover_users=3, total_new=7), "2014-08-24", M.COVER))
    tail = ('{"register_time":{"$gte":"2014-08-24","$lte":"2014-08-24"}},VF-ALL-0-0,PERIOD',
            "2014-08-24 00:00")
    head = "COMMON,shop,2014-08-24,2014-08-24,"
    assert rows == {(head + "int1cover.*," + tail[0], tail[1]): 3,
                    (head + "int1totalnew.*," + tail[0], tail[1]): 7}


def test_breakdown_keys(spark):
    names = [s.metric for s in M.BREAKDOWN]
    row = ("shop", "us", *[1 if n in ("active", "new_7d", "ladder_2") else 0 for n in names])
    counts = spark.createDataFrame(
        [row], "pid string, attr_value string, " + ", ".join(f"{n} long" for n in names))
    rows = by_key(M.breakdown_metrics(counts, "2015-01-08", "geoip"))
    assert set(rows) == {
        ('COMMON,shop,2015-01-08,2015-01-08,visit.*,{"geoip":"us"},VF-ALL-0-0,PERIOD',
         "2015-01-08 00:00"),
        ("GROUP,shop,2015-01-08,2015-01-08,visit.*,TOTAL_USER,VF-ALL-0-0,"
         "USER_PROPERTIES,geoip", "us"),
        ('GROUP,shop,2015-01-02,2015-01-08,visit.*,{"register_time":{"$gte":"2015-01-02",'
         '"$lte":"2015-01-08"}},VF-ALL-0-0,USER_PROPERTIES,geoip', "us"),
        ('GROUP,shop,2015-01-06,2015-01-08,visit.*,{"register_time":{"$gte":"2015-01-06",'
         '"$lte":"2015-01-06"}},VF-ALL-0-0,USER_PROPERTIES,geoip', "us"),
    }


CUBE = "ev3 string, ev4 string, ev5 string, nation string, grp string, grpkey string, " \
       "users long, cnt long, value decimal(38,18)"


# The layout of a key is fixed, as readers of the store depend on it; the values are invented.
@pytest.mark.parametrize("cells,start,end,key,label", [
    (("shoes", "red", "mail", "*", "6", "-"), "2024-02-03", "2024-02-03",
     "COMMON,shop,2024-02-03,2024-02-03,pay.search2.shoes.red.mail.*,TOTAL_USER,"
     "VF-ALL-0-0,PERIOD", "2024-02-05 00:00"),
    (("hats", "*", "mail", "*", "3", "blue"), "2024-02-03", "2024-02-03",
     "GROUP,shop,2024-02-03,2024-02-03,pay.search2.hats.*.mail.*,TOTAL_USER,VF-ALL-0-0,"
     "EVENT,3", "blue"),
    (("*", "*", "*", "peru", "6", "-"), "2024-02-03", "2024-02-03",
     'COMMON,shop,2024-02-03,2024-02-03,pay.search2.*,{"nation":"peru"},VF-ALL-0-0,PERIOD',
     "2024-02-05 00:00"),
    (("*", "*", "*", "*", "5", "fiji"), "2024-01-28", "2024-02-03",
     "GROUP,shop,2024-01-28,2024-02-03,pay.search2.*,TOTAL_USER,VF-ALL-0-0,"
     "USER_PROPERTIES,nation", "fiji"),
    (("*", "*", "*", "*", "6", "-"), "2024-01-28", "2024-02-03",
     "GROUP,shop,2024-01-28,2024-02-03,pay.search2.*,TOTAL_USER,VF-ALL-0-0,EVENT,6",
     "2024-02-05 00:00"),
])
def test_search_keys(spark, cells, start, end, key, label):
    from decimal import Decimal

    cube = spark.createDataFrame([(*cells, 1, 2, Decimal(3))], CUBE)
    row = M.search_metrics(cube, "shop", start, end, "2024-02-05", "pay.search2").first()
    assert (row.cache_key, row.label) == (key, label)
    assert (row.users, row.cnt, int(row.value), row.sample_rate) == (1, 2, 3, 1.0)


def test_reset_rows_do_not_touch_written_keys(spark):
    zeros = M.reset_rows(spark, "g1", DAY, "pay.search2")
    assert {r.label for r in zeros.collect()} == {"null", DAY + " 00:00"}
    assert zeros.count() == 5
    written = zeros.limit(1).withColumn("users", F.lit(9).cast("bigint"))
    merged = M.reset_then(written, zeros)
    assert merged.count() == 5
    assert merged.agg(F.sum("users")).first()[0] == 9


def test_missing_groups_are_published_as_zero(spark):
    rows = M.with_all_groups(totals(spark, dau=5), ["shop", "quiet"])
    assert {r.pid: r.dau for r in rows.collect()} == {"shop": 5, "quiet": 0}


# --- store ----------------------------------------------------------------------------


def metric_rows(spark, **values):
    return M.total_metrics(totals(spark, **values), DAY)


def test_publish_twice_and_read_the_latest(spark):
    warehouse = new_warehouse(spark)
    store.publish(warehouse, metric_rows(spark, dau=1), "2024-01-19", "users")
    for dau in (2, 3):
        store.publish(warehouse, metric_rows(spark, dau=dau), DAY, "users")
    store.publish(warehouse, metric_rows(spark).limit(0), DAY, "search_day")
    metrics = warehouse.table("metrics")
    assert metrics.count() == 14
    current = M.current_metrics(metrics)
    assert current.count() == 7
    assert current.agg(F.max("users")).first()[0] == 3


def test_later_set_replaces_whole_keys(spark):
    first, later = metric_rows(spark, dau=1), metric_rows(spark, dau=2).where("users = 2")
    merged = M.merge_metric_sets(first, later)
    assert merged.count() == 7
    assert merged.agg(F.sum("users")).first()[0] == 2


def test_previous_counts(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "cache_key string")
    stored_rows = spark.createDataFrame(
        [("a", "d1", "x", 5, "users"), ("a", "d2", "x", 3, "page_views"), ("a", "d2", "x", 7, "users"),
         ("a", "d2", "x", 9, "another"), ("a", "d2", "w", 6, "users"), ("c", "d1", "x", 1, "users")],
        "cache_key string, run_day string, label string, cnt long, family string")
    got = {r.cache_key: r.stored_cnt
           for r in M.previous_counts(wanted, stored_rows).collect()}
    assert got == {"a": 7, "b": 0}


def test_json_round_trip(spark, tmp_path):
    rows = metric_rows(spark, dau=11, mau=12).withColumn("value", F.lit("1.25").cast("decimal(38,18)"))
    for _ in range(2):
        store.export_json(rows, str(tmp_path), DAY, "users")
    back = store.reload_json(spark, str(tmp_path), DAY, "users")
    assert back.columns == rows.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    line = json.loads(store.to_documents(rows.where("users = 11")).first().value)
    assert list(next(iter(line.values())).values()) == [[0.0, 1.25, 11.0, 1.0]]


def test_reload_keeps_commas_inside_values(spark):
    names = [s.metric for s in M.BREAKDOWN]
    counts = spark.createDataFrame(
        [("g", "a,b\"c", *[1] * len(names))],
        "pid string, attr_value string, " + ", ".join(f"{n} long" for n in names))
    rows = M.breakdown_metrics(counts, DAY, "nation")
    again = store.from_documents(store.to_documents(rows))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_external_store_gets_every_entry(spark, tmp_path):
    at = FileStore(str(tmp_path), None)
    rows = metric_rows(spark, dau=4).repartition(3)
    for _ in range(2):
        store.upsert(rows, "tests.file_store:connect", path=at.path)
        assert {k for k, _ in at.entries()} == {r.cache_key for r in rows.collect()}
        assert [0, 0.0, 4, 1.0] in at.entries().values() and not at.parts()
    store.upsert(metric_rows(spark, dau=5).limit(1), "tests.file_store:connect", path=at.path)
    assert [0, 0.0, 5, 1.0] in at.entries().values() and len(at.entries()) == rows.count()


def test_a_failed_upsert_shows_nothing(spark, tmp_path):
    at = FileStore(str(tmp_path), None)
    store.upsert(metric_rows(spark, dau=4), "tests.file_store:connect", path=at.path)
    before = at.entries()
    rows = metric_rows(spark, dau=9)
    bad = rows.limit(1).withColumn("label", F.lit("poison"))
    with pytest.raises(Exception, match="refused"):
        store.upsert(rows.unionByName(bad), "tests.file_store:connect", path=at.path,
                     poison="poison")
    assert at.entries() == before


def test_a_repeated_task_counts_once(spark, tmp_path):
    at = FileStore(str(tmp_path), None)
    writer = store.KeyValueWriter({"client": "tests.file_store:connect", "path": at.path})
    rows = metric_rows(spark, dau=4).collect()
    lost, kept = writer.write(iter(rows[:3])), writer.write(iter(rows))
    assert (lost.entries, kept.entries) == (3, len(rows)) and len(at.parts()) == 2
    writer.commit([kept, None])
    assert len(at.entries()) == len(rows)
    writer.commit([kept])  # a commit that is repeated changes nothing
    writer.abort([lost, None])
    assert len(at.entries()) == len(rows) and not at.parts()


# --- history ------------------------------------------------------------------------------


def test_history_keeps_the_newest_rows(spark):
    groups = ("g1", "g2")
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3, 4) for d in range(1, 29)]
    rows = [(day, g, *[i + j] * 7) for i, day in enumerate(days) for j, g in enumerate(groups)]
    columns = ", ".join(f"{m} long" for m in history.HISTORY_METRICS)
    totals_ = spark.createDataFrame(rows, f"day string, pid string, {columns}")
    wide = history.newest(history.history_row(totals_, groups))
    kept = [r.day for r in wide.collect()]
    assert len(kept) == 91 and kept == sorted(days, reverse=True)[:91]
    assert len(wide.columns) == 1 + 7 * 2
    back = history.unpivot_newest(wide, groups).collect()
    assert len(back) == 14 and {r.day for r in back} == {"2024-04-28"}
    assert {r.users for r in back if r.pid == "g2"} == {len(days)}


def test_default_settings():
    settings = Settings()
    assert settings.combined == {"all": ("g1", "g2")}
    assert settings.heartbeat_pids is None
