"""Panes, bucketed tables, SQL functions, inferred records, file sink, loss accounting, salting."""

import datetime as dt
import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

from linepulse import session
from linepulse.functions import sql
from linepulse.operators import lookups, panes, skew
from linepulse.plans import continuous
from linepulse.session import clean_shared, finished_folders, fresh_path
from linepulse.sources import inferred, tables
from linepulse.streaming import events, ingest, progress
from linepulse.streaming import kpi as kpi_stream
from linepulse.streaming.bucket_store import BucketStore

VERSIONS = "k string, version long, v string"
FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- panes --------------------------------------------------------------------------


def points(seed, n):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        unit = ("M1", "Top") if rng.random() < 0.6 else (f"M{rng.randint(2, 4)}", rng.choice(["Top", None]))
        at = start + dt.timedelta(minutes=rng.choice([0, 15, 30, rng.randint(0, 4000)]))
        rows.append((*unit, rng.choice([0.5, 0.25, rng.random()]), at, f"{k:05d}"))
    rows += rows[:5]  # copies
    rows += [("M1", "Top", None, start, "x"), ("M1", "Top", 0.5, None, "y")]
    return rows


SCHEMA = "machine_id string, pcb_side string, result double, max_inspection_end_time timestamp, generated_key string"


def test_sliding_limits_match_each_window(spark):
    rows = points(1, 500)
    found = panes.sliding_limits(spark.createDataFrame(rows, SCHEMA).repartition(5), hours=6).collect()
    known = [r for r in rows if r[2] is not None and r[3] is not None]

    def end(at):
        return at.replace(minute=at.minute // 15 * 15, second=0) + dt.timedelta(minutes=15)

    assert {(r.machine_id, r.pcb_side, r.window_end) for r in found} == {(r[0], r[1], end(r[3])) for r in known}
    assert len(found) == len({(r.machine_id, r.pcb_side, r.window_end) for r in found})
    for r in found:
        inside = sorted(
            (p[3], p[4], p[2])
            for p in known
            if p[:2] == (r.machine_id, r.pcb_side) and r.window_end - dt.timedelta(hours=6) <= p[3] < r.window_end
        )
        values = [v for _, _, v in inside]
        mean = sum(values) / len(values)
        assert r.points == len(values) and r.mean == pytest.approx(mean)
        if len(values) == 1:
            assert r.ucl is None and r.lcl is None
        else:
            step = sum(abs(a - b) for a, b in zip(values, values[1:])) / (len(values) - 1)
            assert r.ucl == pytest.approx(min(100.0, (mean + 2.66 * step) * 100))
            assert r.lcl == pytest.approx(max(0.0, (mean - 2.66 * step) * 100))


def test_panes_need_no_range_exchange(spark):
    plan = plan_of(continuous.xmr_sliding(spark, FOLDER))
    assert "rangepartitioning" not in plan
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange ") <= 3


# --- bucket store -------------------------------------------------------------------


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_bucket_store_equals_batch_and_writes_what_changes(spark, rows):
    many = [(f"k{n}", 0, "a") for n in range(200)] + [(None, 0, "null key")]
    parts = [many, [("k7", 1, "b"), ("k7", 1, "b")], [("new", 2, "c"), ("k8", 2, "d")], [], [("k7", 0, "late")]]
    path = fresh_path(spark, "bucket-store")
    schema = spark.createDataFrame([], VERSIONS).schema
    store = BucketStore(path, ["k"], schema, buckets=16, keep_versions=2)
    assert store.current(spark).count() == 0
    total, folder = [], path.removeprefix("file:")
    for number, part in enumerate(parts):
        before = files_of(folder)
        store.merge(spark.createDataFrame(part, VERSIONS), number)
        total += part
        want = rows(lookups.one_per_key(spark.createDataFrame(total, VERSIONS), ["k"], ["version"]))
        assert rows(store.current(spark)) == want
        new = [p for p in files_of(folder).keys() - before.keys() if "/data/" in p]
        buckets = {p.split("bucket=")[1].split("/")[0] for p in new}
        assert len(buckets) <= max(1, len({r[0] for r in part})) if number else len(buckets) > 10
        store.merge(spark.createDataFrame(part, VERSIONS), number)  # the batch is run again
        assert rows(store.current(spark)) == want
    assert len(store.versions(spark)) == 2
    data = {p.split("/data/")[1].rsplit("/", 1)[0] for p in files_of(folder) if "/data/" in p}
    assert len(data) <= 16 + 3  # versions that nothing names are gone


def test_bucket_store_prunes_and_knows_its_number(spark, rows):
    path = fresh_path(spark, "bucket-store")
    schema = spark.createDataFrame([], VERSIONS).schema
    store = BucketStore(path, ["k"], schema, buckets=16)
    store.merge(spark.createDataFrame([(f"k{n}", 0, "a") for n in range(200)], VERSIONS), 0)
    some = store.current(spark, keys=spark.createDataFrame([("k3",), ("k4",), ("none",)], "k string"))
    assert {"k3", "k4"} <= {r.k for r in some.collect()}
    assert len(some.inputFiles()) <= 3 < len(store.current(spark).inputFiles())
    with pytest.raises(ValueError, match="buckets"):
        BucketStore(path, ["k"], schema, buckets=8).current(spark)


def test_merge_that_died_leaves_the_store(spark, rows):
    path = fresh_path(spark, "bucket-store")
    schema = spark.createDataFrame([], VERSIONS).schema
    store = BucketStore(path, ["k"], schema, buckets=4)
    store.merge(spark.createDataFrame([("a", 0, "x")], VERSIONS), 0)
    half = spark.createDataFrame([("a", 9, "half")], VERSIONS)
    half.withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{path}/data/v1")
    assert rows(store.current(spark)) == [("a", 0, "x")]
    store.merge(spark.createDataFrame([("b", 1, "y")], VERSIONS), 1)
    assert rows(store.current(spark)) == [("a", 0, "x"), ("b", 1, "y")]


def test_streams_take_either_store(spark):
    kinds = {type(s).__name__ for s in events.lookup_stores("p", buckets=4).values()}
    assert kinds == {"BucketStore"}
    assert {type(s).__name__ for s in events.lookup_stores("p").values()} == {"LookupStore"}


# --- tables and functions -----------------------------------------------------------


def test_bucketed_join_has_no_exchange_below(spark):
    plan = plan_of(continuous.volume_bucketed(spark, FOLDER))
    joins = [part for part in plan.split("SortMergeJoin")[1:] if "generated_key" in part.split("\n")[0]]
    assert joins and all("Exchange" not in part for part in joins)
    assert plan.count("Bucketed: true") == plan.count("Scan parquet")


def test_counts_come_from_footers(spark):
    rows = tables.footer_table(spark, f"{FOLDER}/lineitem.parquet")
    counted = rows.agg(F.count("*"))
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    assert counted.first()[0] == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_sql_functions_run_no_python(spark):
    plan = plan_of(continuous.sql_functions(spark, FOLDER))
    assert "Python" not in plan and "Arrow" not in plan


def test_sql_functions_of_nulls_and_odd_texts(spark):
    sql.register(spark)
    row = spark.sql(
        "SELECT changer_hole('0,x,2') a, changer_hole(NULL) b, workcentre_side('M1') c, converts('1.5', 'Int') d, "
        "converts('x', NULL) e, inspection_time('nonsense') f, interval_id(NULL) g, location_part('1', 5) h, "
        "converts('TRUE', 'Boolean') i, slot_label(NULL, '0,1,2') j"
    ).first()
    assert tuple(row) == (None, None, "", False, False, None, None, None, True, None)


def test_inferred_fields(spark):
    tag = '"xml_tag_name":"c1-smt-m-timers"'
    texts = [f'{{{tag},"ulIdleTime":5,"n":1}}', f'{{{tag},"n":2.5,"o":{{"a":[1]}}}}', "broken", "[]", "null", f'{{{tag},"n":null}}']
    found = inferred.fields(inferred.variants(spark.createDataFrame([(t,) for t in texts], "value string")))
    assert {(r["field"], r["kind"], r["row_count"], r["nested"], r["known"]) for r in found.collect()} == {
        ("xml_tag_name", "STRING", 3, False, True),
        ("ulIdleTime", "BIGINT", 1, False, True),
        ("n", "DECIMAL(21,1)", 3, False, False),
        ("o", "OBJECT<a: ARRAY<BIGINT>>", 1, True, False),
    }


# --- streams ------------------------------------------------------------------------


def test_file_sink_log_is_the_table(spark):
    root = fresh_path(spark, "sink")
    spark.createDataFrame([('{"xml_tag_name":"c1-smt-m-timers","Product_ID":"p"}',), ("odd",)], "value string").write.parquet(
        f"{root}/in"
    )
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in")
    ingest.sink_records(inlet, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    spark.range(1).selectExpr("'stray' raw").write.parquet(f"{root}/out/record_type=ea_pap_timers/stray")
    both = ingest.sunk(spark, f"{root}/out").collect()
    assert sorted(str(r["record_type"]) for r in both) == ["None", "ea_pap_timers"]
    assert [r["product_id"] for r in ingest.landed(spark, f"{root}/out", "ea_pap_timers").collect()] == ["p"]


INSPECTIONS = "machine_id string, pcb_side string, pcb_result string, inspection_end timestamp"


@pytest.mark.parametrize("cuts", [(20, 40, 60), (7, 23, 24, 60), (59, 60)])
def test_interval_yields_do_not_depend_on_cuts(spark, cuts):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [("M1", "Top", rng.choice(["GOOD", "PASS", "FAIL"]), start + dt.timedelta(minutes=4 * k)) for k in range(60)]
    late = [("M1", "Top", "GOOD", start)] * 3
    root = fresh_path(spark, "cuts")
    came = 0
    for number, (low, high) in enumerate(zip((0, *cuts), (*cuts, None))):
        part = rows[low:high] if high else late
        spark.createDataFrame(part, INSPECTIONS).write.parquet(f"{root}/in/{number}")
        inlet = progress.counted(spark.readStream.schema(INSPECTIONS).parquet(f"{root}/in/*"))
        query = kpi_stream.interval_yield_stream(inlet, f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
        came += progress.rows_in(query)
    out = spark.read.parquet(f"{root}/out").collect()
    past = rows[-1][3] - dt.timedelta(minutes=30)
    want = {}
    for _, _, result, at in rows:
        first = at.replace(minute=at.minute // 15 * 15)
        if first + dt.timedelta(minutes=15) <= past:
            want.setdefault(first, []).append(result)
    assert sorted(r.boards for r in out) == sorted(map(len, want.values()))
    assert len(out) == len(want)
    given, kept = sum(r.boards for r in out), progress.waiting(spark, f"{root}/checkpoint")
    assert came == 63 and came - given - kept == 3 and progress.dropped_groups(query) > 0
    assert progress.state_operators(spark, f"{root}/checkpoint").first()["operatorName"] == "stateStoreSave"


def test_refreshed_reads_by_batches_and_time(spark):
    path = fresh_path(spark, "cost")
    calls = []

    def read(session):
        calls.append(1)
        return session.range(len(calls))

    kept = events.Refreshed(read, batches=2)
    assert [kept(spark).count() for _ in range(5)] == [1, 1, 2, 2, 3]
    assert events.Refreshed(read, seconds=1000)(spark).count() == 4 and path


# --- salting ------------------------------------------------------------------------


def test_salting_bounds_the_largest_task(spark, rows):
    hot = [("hot", n) for n in range(3000)] + [(f"k{n % 500}", n) for n in range(3000)] + [(None, 1)]
    left = spark.createDataFrame(hot, "user_name string, n int")
    master = spark.createDataFrame([(k, "x") for k in ("hot", "hot", *(f"k{n}" for n in range(500)))], "m string, v string")
    found = skew.salting(left, "user_name", share=0.1, parts=8)
    assert found.keys == ("hot",)
    salted = found.spread(left, "user_name")
    copies = found.repeat(master, "m").withColumnRenamed(skew.SALT, "s")
    joined = salted.join(copies, (F.col("user_name") == F.col("m")) & (F.col(skew.SALT) == F.col("s")))
    assert rows(joined, "user_name", "n", "v") == rows(left.join(master, F.col("user_name") == F.col("m")), "user_name", "n", "v")
    most = salted.groupBy("user_name", skew.SALT).count().agg(F.max("count")).first()[0]
    assert most <= 3000 / 8 * 1.5
    assert skew.salting(left.where("false"), "user_name").keys == ()


# --- written folders ----------------------------------------------------------------


def test_old_folders_of_the_shared_folder_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))  # a folder of its own, as others go on reading theirs
    kept = fresh_path(spark, "kept")
    for path in (kept, f"{tmp_path}/named-by-hand"):
        spark.range(1).write.mode("overwrite").parquet(path)
    assert clean_shared(spark, hours=1) == []
    name = kept.rsplit("/", 1)[-1]
    other = fresh_path(spark, "other")
    found = clean_shared(spark, hours=1, now=time.time() + 2 * 3600)
    assert name in found and "named-by-hand" not in found
    assert finished_folders(spark, str(tmp_path)) == ["named-by-hand"] and other
