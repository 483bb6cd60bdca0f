"""Indicators and control limits: worked examples, skew and brute force."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linepulse.functions import times
from linepulse.operators import kpi, limits, slices

HEADER = "generated_key string, machine_id string, pcb_side string, pcb_name string, pcb_result string, inspection_end timestamp"
POINTS = "machine_id string, pcb_side string, result double, max_inspection_end_time timestamp, generated_key string"
T0 = dt.datetime(2024, 1, 1, 10, 7)


def headers(spark, *boards):
    rows = [(f"K{i}", m, s, "B", r, T0 + dt.timedelta(minutes=i)) for i, (m, s, r) in enumerate(boards)]
    return spark.createDataFrame(rows, HEADER)


def points(spark, *series):
    rows = []
    for machine, values in series:
        rows += [
            (machine, "Top", v, T0 + dt.timedelta(minutes=i), f"K{i:06d}") for i, v in enumerate(values)
        ]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, POINTS)


def test_ratios(spark):
    df = headers(
        spark,
        ("M1", "Top", "GOOD"), ("M1", "Top", "PASS"), ("M1", "Top", "FAIL"), ("M1", "Top", "PASS"),
        ("M1", "Bottom", "GOOD"), ("M2", "Top", "FAIL"), ("M3", "Top", "SKIPPED"), (None, "Top", "PASS"),
    )
    got = {}
    for r in kpi.yields(df, as_of="2024-01-02 00:00:00").collect():
        got.setdefault((r.machine_id, r.pcb_side), set()).add((r.fpy_result, r.ffr_result))
    assert got == {
        ("M1", "Top"): {(0.75, 0.5)}, ("M1", "Bottom"): {(1.0, 0.0)}, ("M2", "Top"): {(0.0, 0.0)},
        ("M3", "Top"): {(0.0, 0.0)}, (None, "Top"): {(1.0, 1.0)},
    }
    assert kpi.fpy(df).count() == kpi.ffr(df).count() == 8


def test_boards_have_their_own_times(spark):
    df = headers(spark, ("M1", "Top", "GOOD"), ("M1", "Top", "GOOD")).withColumn("generated_key", F.lit("K"))
    (row,) = kpi.fpy(df).collect()
    assert (row.min_inspection_end_time, row.max_inspection_end_time) == (T0, T0 + dt.timedelta(minutes=1))
    assert row.machineId_side == "M1-Top"


def test_compat_pairs_sides(spark):
    boards = [("M1", "Top", "GOOD")] * 4 + [("M1", "Bottom", "PASS")] * 2
    # two counts times two counts, each on all six boards
    assert kpi.fpy(headers(spark, *boards), compat=True).count() == 24
    assert kpi.fpy(headers(spark, *boards)).count() == 6


@pytest.mark.parametrize(
    "minute, ours, old", [(7, 0, 45), (15, 15, 45), (16, 15, 15), (31, 30, 30), (46, 45, 45)]
)
def test_intervals(spark, minute, ours, old):
    at = dt.datetime(2024, 1, 1, 10, minute, 9, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(at,)], "t timestamp").select(
        times.interval_id(F.col("t")).alias("a"), times.interval_id(F.col("t"), compat=True).alias("b")
    )
    row = df.first()
    a, b = (dt.datetime.fromtimestamp(x / 1000, dt.timezone.utc) for x in row)
    assert (a.hour, a.minute, a.second) == (10, ours, 0)
    assert (b.hour, b.minute, b.second) == (10, old, 9)


def test_volume_of_joined_rows(spark):
    df = headers(spark, ("M1", "Top", "GOOD"), ("M1", "Top", "FAIL"), ("M2", "Top", "GOOD"))
    pads = spark.createDataFrame(
        [("K0", 10.0), ("K0", 20.0), ("K1", 60.0), ("K1", None), ("K9", 5.0)], "generated_key string, volume double"
    )
    got = {r.generated_key: (r.volume_result, r.machineId_side) for r in kpi.volume(pads, df).collect()}
    assert got == {"K0": (30.0, "M1-Top"), "K1": (30.0, "M1-Top")}


def test_volume_with_one_hot_board(spark):
    df = headers(spark, *[("M1", "Top", "GOOD")] * 50)
    pads = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 'K0', concat('K', id % 50)) AS generated_key", "double(id) AS volume"
    )
    result = kpi.volume(pads, df)
    assert {round(r.volume_result, 6) for r in result.collect()} == {2999.5}
    plan = kpi.board_volumes(pads, df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(volume" in plan


def test_interval_yields_batch(spark):
    df = headers(spark, *[("M1", "Top", "GOOD")] * 8, ("M1", "Top", "FAIL"))
    got = sorted((r.interval_id % 3_600_000 // 60_000, r.boards, r.fpy_result) for r in kpi.interval_yields(df).collect())
    assert got == [(0, 8, 1.0), (15, 1, 0.0)]


def test_raw_records(spark):
    raw = spark.createDataFrame(
        [("K", "M", "Top", "B", "GOOD", "01/01/2024 01:05:00 PM")],
        "GeneratedKey string, MachineID string, Side string, PCBName string, PCBResult string, InspectionEndTime string",
    )
    assert kpi.header_records(raw).first().inspection_end == dt.datetime(2024, 1, 1, 13, 5)
    pads = spark.createDataFrame([("K", "98.5"), ("K", "x")], "GeneratedKey string, Volume string")
    assert [r.volume for r in kpi.detail_records(pads).collect()] == [98.5, None]


# --- limits ---------------------------------------------------------------------------


def one(df):
    (row,) = df.collect()
    return tuple(None if v is None else round(v, 6) for v in (row.ucl, row.lcl, row["mean"]))


def test_xmr_examples(spark):
    assert one(limits.xmr(points(spark, ("M", [0.90, 0.92, 0.89])))) == (96.983333, 83.683333, 0.903333)
    assert one(limits.xmr(points(spark, ("M", [0.99, 0.90])))) == (100.0, 70.56, 0.945)
    assert one(limits.xmr(points(spark, ("M", [0.5])))) == (None, None, 0.5)
    assert one(limits.xmr(points(spark, ("M", [0.5, None])))) == (None, None, 0.5)


def brute(values):
    steps = [abs(b - a) for a, b in zip(values, values[1:])]
    return len(values), sum(values), sum(steps)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(st.integers(0, 1000), min_size=1, max_size=60), min_size=1, max_size=4),
    st.integers(1, 7),
)
def test_moving_ranges_match_brute_force(spark, series, parts):
    named = [(f"M{i}", [v / 8 for v in s]) for i, s in enumerate(series)]
    df = points(spark, *named)
    got = slices.moving_ranges(df, ["machine_id"], ["max_inspection_end_time"], "result", parts)
    for row in got.collect():
        want = brute(dict(named)[row.machine_id])
        assert (row.n, row.total, row.range_sum) == pytest.approx(want)


def test_hot_group_covers_many_tasks(spark):
    df = spark.range(30000).selectExpr(
        "if(id % 3 < 2, 'HOT', concat('M', id % 11)) AS m", "id AS at", "double(id % 17) AS v"
    )
    sizes = slices.sliced(df, ["m"], ["at"], 12).groupBy("slice_no").count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) < 6000
    got = {r.m: r for r in slices.moving_ranges(df, ["m"], ["at"], "v", 12).collect()}
    hot = [float(i % 17) for i in range(30000) if i % 3 < 2]
    assert (got["HOT"].n, got["HOT"].total, got["HOT"].range_sum) == pytest.approx(brute(hot))


def test_copies_of_a_point_do_not_pile_up(spark):
    df = spark.range(9000).selectExpr(
        "'M' AS m", "if(id % 3 < 2, 50, id % 100) AS at", "if(id % 3 < 2, 7.0, double(id % 100)) AS v"
    )
    (got,) = slices.moving_ranges(df, ["m"], ["at"], "v", 6).collect()
    plain = sorted((50, 7.0) if i % 3 < 2 else (i % 100, float(i % 100)) for i in range(9000))
    assert (got.n, got.total, got.range_sum) == pytest.approx(brute([v for _, v in plain]))


def test_numbering_of_hot_group(spark):
    df = spark.range(5000).selectExpr("if(id % 3 < 2, 'HOT', 'M') AS m", "5000 - id AS at")
    got = slices.numbered(df, ["m"], ["at"], slices=8).collect()
    for name in ("HOT", "M"):
        rows = sorted((r.at, r.row_no) for r in got if r.m == name)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))


def test_point_lists_are_bounded_and_whole(spark):
    values = [i / 4 for i in range(25)]
    made = limits.point_lists(points(spark, ("M", values)), size=10).orderBy("list_no").collect()
    assert [r.points for r in made] == [10, 10, 5]
    assert [float(x) for r in made for x in r.datapoints.split(",")] == values


def test_control_limits_full_and_compat(spark):
    schema = "machine_id string, pcb_side string, interval_id long, result double, max_inspection_end_time timestamp, generated_key string, bicoe_load_dttm timestamp"
    now = dt.datetime(2024, 1, 2)

    def store(machine, values, hours=1):
        return [
            (machine, "Top", i, v, T0 + dt.timedelta(minutes=i), f"K{i}{j}", now - dt.timedelta(hours=hours))
            for i, v in enumerate(values)
            for j in range(2)
        ]

    fpy = spark.createDataFrame(store("A", [0.9, 0.8]) + store("B", [0.5, 0.6]) + store("OLD", [0.1], 30), schema)
    ffr = spark.createDataFrame(store("A", [0.1, 0.2]), schema)
    volume = spark.createDataFrame(store("A", [0.3, 0.4]), schema)
    stores = {"fpy": fpy, "ffr": ffr, "volume": volume}
    full = {r.machine_id: r for r in limits.control_limits(stores, kpi.machines(fpy), now).collect()}
    assert set(full) == {"A", "B", "OLD"}
    assert full["A"].fpy_mean == pytest.approx(0.85) and full["A"].fpy_lcl == pytest.approx(58.4)
    assert full["B"].fpy_mean == pytest.approx(0.55) and full["B"].ffr_mean is None
    assert full["OLD"].fpy_mean is None and full["OLD"].machineId_side == "OLD-Top"
    old = {r.machine_id: r for r in limits.control_limits(stores, kpi.machines(fpy), now, compat=True).collect()}
    assert old["B"].fpy_mean is None
    # repeated points shrink the moving range: steps 0, 0.1, 0
    assert old["A"].fpy_lcl == pytest.approx((0.85 - 2.66 * 0.1 / 3) * 100)


def test_order_of_arrival_does_not_matter(spark):
    df = points(spark, ("M", [0.1, 0.9, 0.2, 0.8]))
    assert one(limits.xmr(df)) == one(limits.xmr(df.orderBy(F.desc("result")).coalesce(1)))
