"""Master data and enrichment."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from linepulse import session
from linepulse.functions import text
from linepulse.operators import enrich, lookups, wide


def cell(spark, expression, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(expression).first()[0]


def test_location(spark):
    place, m = F.col("l"), F.col("m")
    assert cell(spark, text.changer_hole(place), l="0,21,22", m="M1") == "22-23"
    assert cell(spark, text.machine_changer_hole(m, place), l="0,21,22", m="M1") == "M1 - 22-23"
    assert cell(spark, text.changer_hole(place, 0), l="0,21,22", m="M1") == "21-22"
    assert cell(spark, text.machine_changer_hole(m, place, 0, "-"), l="0,21,22", m="M1") == "M1-21-22"
    assert cell(spark, text.changer_hole(place), l="0,x", m="M1") is None
    assert cell(spark, text.slot_track(place), l="0,1,0", m="") == "2"
    assert cell(spark, text.slot_label(F.lit(5), place), l="0,1,0", m="") == "5.1"


@pytest.mark.parametrize(
    "code, side, machine",
    [("AB_TOP_M7", "Top", "M7"), ("P_BOT_M1", "Bottom", "M1"), ("M7", "", "M7"), ("A_MID_M", "", "M"), ("TOP", "", "TOP")],
)
def test_work_centre(spark, code, side, machine):
    assert cell(spark, text.workcentre_side(F.col("c")), c=code) == side
    assert cell(spark, text.workcentre_machine(F.col("c")), c=code) == machine


def test_small_functions(spark):
    assert cell(spark, text.product_prefix(F.col("p")), p="WO77.a.b") == "WO77"
    assert cell(spark, text.strip_leading_zeros(F.col("p")), p="000123") == "123"
    assert cell(spark, text.tag_location(F.col("t")), t="c1-smt-meq-nozzle") == "meq"
    assert cell(spark, text.tag_location(F.col("t")), t="c1") is None
    c, r = F.col("c"), F.col("r")
    assert cell(spark, text.panel_circuit(c, r), c="12", r="12-R10") == "12-"
    assert cell(spark, text.ref_designator(c, r), c="12", r="12-R10") == "R10"
    url = text.work_order_url("http://x/wo", F.col("w"), F.col("p"))
    assert cell(spark, url, w="7", p="P") == "http://x/wo?wo=7&Location=P&Section="
    assert cell(spark, text.unit_url("http://x/u", F.col("p"), F.col("s")), p="P", s="S") == "http://x/u?Location=P&SN=S"


EQUIP = "machine_name string, plant string, equipment_make string, equipment_model string, equipment_type string, head_1 string, head_2 string, hdfs_file_name string"


def equipment(spark, *rows):
    made = [(m, p, make, "mod", "typ", h, "", v) for m, p, make, h, v in rows]
    return lookups.load(spark.createDataFrame(made, EQUIP), "equipment")


def test_latest_and_ties(spark, rows):
    got = equipment(
        spark, ("M1", "P", "old", "A", "f1"), ("M1", "P", "new", "B", "f2"), ("M1", "P", "newer", "B", "f2"), ("M1", "Q", "x", "C", "f0")
    )
    assert rows(got, "plant", "equipment_make") == [("P", "newer"), ("Q", "x")]
    assert rows(lookups.version_counts(got)) == [("f0", 1), ("f2", 1)]


def test_one_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(20000).selectExpr("if(id % 3 < 2, 0, id) AS k", "id AS v", "id % 5 AS o")
    got = lookups.one_per_key(df, ["k"], ["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert got.filter("k = 0").first().v == 19999
    first = lookups.one_per_key(df, ["k"], ["v"], "first").filter("k = 0").first()
    assert first.v == 0


def test_merge_latest_and_first(spark, rows):
    schema = "plant string, machine string, part_number string, head_type string, pins double, nozzle1 string, package string, version long"
    old = spark.createDataFrame([("P", "M", "1", "H", 1.0, "n", "k", 1)], schema)
    new = spark.createDataFrame([("P", "M", "1", "H", 2.0, "n", "k", 2), ("P", "M", "2", "H", 3.0, "n", "k", 2)], schema)
    assert rows(lookups.merge(old, new, "comptype"), "part_number", "pins") == [("1", 2.0), ("2", 3.0)]
    assert rows(lookups.merge(old, new, "comptype", compat=True), "part_number", "pins") == [("1", 1.0), ("2", 3.0)]
    again = lookups.merge(lookups.merge(old, new, "comptype"), new, "comptype")
    assert rows(again, "part_number", "pins") == [("1", 2.0), ("2", 3.0)]


def orders(spark, *rows):
    raw = spark.createDataFrame(
        list(rows), "optel_schedule_wo string, sap_wo string, side string, assembly string, plant string, setup double, hdfs_file_name string"
    )
    return lookups.load(raw, "wodetail", report_base="http://x/wo")


NOZZLE = "xml_tag_name string, product_id string, date_time timestamp, user_name string, location string, tooltype int, ul_picks int, ul_placements int, ul_comp_missing int, ul_possible_missing int, ul_rejects int"
AT = dt.datetime(2024, 1, 1)


def nozzle_inputs(spark):
    events = spark.createDataFrame(
        [
            ("c1-smt-meq-nozzle", "W1.a", AT, "E1", "0,21,22", 5, 9, 8, 1, 0, 0),
            ("c1-smt-sng-nozzle", "W1.a", None, "E1", "0,1,2", 5, 9, 8, 1, 0, 0),
            ("c1-smt-meq-nozzle", "W9.a", AT, "E1", "0,1,2", 5, 9, 8, 1, 0, 0),
        ],
        NOZZLE,
    )
    machines = equipment(spark, ("M1", "1020", "E1", "A", "f1"), ("M1", "5170", "E1", "A", "f1"))
    info = lookups.load(
        spark.createDataFrame(
            [(5, "T5", "d", "1020", "M1", "f"), (5, "T5b", "d", "5170", "M1", "f")],
            "crc_id int, name string, description string, plant_code string, machine string, hdfs_file_name string",
        ),
        "info",
    )
    return events, machines, info, orders(spark, ("W1", "S1", "Top", "A1", "1020", 2.0, "f"))


def test_nozzle_with_and_without_plant(spark, rows):
    events, machines, info, wo = nozzle_inputs(spark)
    loose = enrich.nozzle(events, machines, info, wo, as_of="2024-02-02 00:00:00")
    assert loose.count() == 4
    xref = spark.createDataFrame([("meq", "1020"), ("sng", "5170")], "location string, plant string")
    strict = enrich.nozzle(events, machines, info, wo, xref)
    assert rows(strict, "plant", "tooltypenozzle", "nozzle_mach_ch_hole", "wo_detail") == [
        ("1020", "T5", "M1 - 22-23", "http://x/wo?wo=S1&Location=1020&Section="),
        ("5170", "T5b", "M1 - 2-3", "http://x/wo?wo=S1&Location=1020&Section="),
    ]
    assert loose.filter("date_time = '2024-02-02'").count() == 2


def test_hot_machine_is_split_when_lookups_are_too_large_to_broadcast(spark):
    """The join of a lookup that does not fit a broadcast splits the rows of a hot machine."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        events = spark.range(0, 30000, 1, 8).selectExpr(
            "'t' AS xml_tag_name", "concat('W', id % 40, '.x') AS product_id",
            "timestamp'2024-01-01' AS date_time",
            "if(id % 3 < 2, 'E0', concat('E', id % 300)) AS user_name",
            *(f"int(id % {n}) AS {c}" for n, c in (
                (5, "ul_production_time"), (6, "ul_setup_time"), (7, "ul_idle_time"),
                (8, "ul_diagnostic_time"), (9, "ul_waiting_for_operator"),
                (10, "ul_waiting_for_interrupt_recovery"), (11, "ul_waiting_for_board_in_workarea"),
            )),
        )
        machines = spark.range(300).selectExpr(
            "concat('M', id) AS machine_name", "'P' AS plant", "concat('E', id) AS equipment_make", "'A' AS head_1"
        )
        made = spark.range(40).selectExpr(
            "concat('W', id) AS optel_schedule_wo", "concat('S', id) AS sap_wo", "'Top' AS side",
            "'A' AS assembly", "'P' AS plant", "1.0 AS setup", "'u' AS wo_detail",
        )
        got = enrich.timers(events, machines, made)
        assert len(got.collect()) == 30000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(df):
    """Keys of the shuffles in a plan without broadcasts, outermost first."""
    spark, key = df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    return [re.findall(r"(\w+)#", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def test_events_meet_machines_and_tools_at_once(spark):
    """Nozzle events are dealt for their machine and its tools, and for their order: not three times."""
    events, machines, info, wo = nozzle_inputs(spark)
    found = exchanges(enrich.nozzle(events, machines, info, wo))
    assert sorted(k for k in found if {"user_name", "tooltype", "split_plant_id"} & set(k)) == [
        ["split_plant_id"], ["user_name", "tooltype"],
    ]


def test_tools_of_machines_with_one_name(spark, rows):
    """Each machine of a name has its own tools; machines and tools without partners give no rows."""
    events, _, _, wo = nozzle_inputs(spark)
    machines = equipment(spark, *(("M1", p, "E1", "A", "f") for p in ("1020", "5170")), ("M2", "1020", "E1", "A", "f"), ("M3", "1020", None, "A", "f"))
    tools = [(5, "a", "1020", "M1"), (5, "b", "1020", "M2"), (6, "c", "1020", "M2"), (5, "d", "1020", "M3"), (None, "e", "5170", "M1")]
    info = spark.createDataFrame(tools, "crc_id int, name string, plant_code string, machine string")
    got = enrich.nozzle(events.union(events), machines, info, wo)
    assert rows(got.groupBy("machine_name", "plant", "tooltypenozzle").count()) == [("M1", "1020", "a", 4), ("M2", "1020", "b", 4)]


def test_slot_meets_orders_last(spark):
    """Columns of the order make events much wider, so the other joins come first."""
    cost = spark.createDataFrame([("10", "1020", 7.5)], "material string, plant string, unit_cost double")
    keys = [k for k in exchanges(slot_result(spark, cost)) if {"user_name", "component_name", "split_plant_id"} & set(k)]
    assert keys[0] == ["split_plant_id"]


def test_links_are_made_for_chosen_orders_only(spark, rows):
    names = "optel_schedule_wo string, sap_wo string, side string, assembly string, plant string, setup double, hdfs_file_name string"
    made = [("W1", "S1", "Top", "A", "P", 1.0, "f1"), ("W1", "S2", "Top", "A", "P", 1.0, "f1"), ("W2", None, "Top", "A", "P", 1.0, "f1")]
    got = lookups.load(spark.createDataFrame(made, names), "wodetail", report_base="u")
    assert got.columns == [*lookups.LOOKUPS["wodetail"].columns, lookups.VERSION]
    assert rows(got, "sap_wo", "wo_detail") == [("S2", "u?wo=S2&Location=P&Section="), (None, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "wo_detail" not in plan[plan.index("Window ") :]


def test_limit_is_repeatable(spark, rows):
    events, machines, info, wo = nozzle_inputs(spark)
    picked = [rows(enrich.nozzle(events.repartition(n), machines, info, wo, limit=2)) for n in (1, 5)]
    assert picked[0] == picked[1] and len(picked[0]) == 2


def test_defects_keep_unmatched(spark):
    schema = "placing_plant_code string, placing_wc_code string, order_no string, fault_board_no int, ref_designator string, cmpnt_part_no string, defect_date timestamp, defect_code string, fail_type string, assem_serial_no string, defect_count double"
    events = spark.createDataFrame(
        [
            ("P", "X_TOP_M1", "S1", 3, "R10", "c", AT, "d", "f", "SN1", 1.0),
            ("P", "X_BOT_M1", "S1", 3, "R10", "c", AT, "d", "f", "SN2", 1.0),
            ("P", "X_TOP_M1", "S1", 4, "R10", "c", AT, "d", "f", None, 1.0),
        ],
        schema,
    )
    raw = spark.createDataFrame(
        [("M1", "P", "W1", "12-R10", 3, "12", "H1", "2", "f")],
        "machine string, plant string, work_order string, ref_id string, silkscreen long, circuit string, head string, spindle string, hdfs_file_name string",
    )
    got = enrich.defects(
        events, orders(spark, ("W1", "S1", "Top", "A1", "P", 2.0, "f")), lookups.load(raw, "progorderlist"), "http://x/u"
    ).collect()
    by = {r.assem_serial_no: r for r in got}
    assert by["SN1"].optel_schedule_wo == "W1" and by["SN1"].head_spindle == "H1-2" and by["SN1"].ref_id == "12-R10"
    assert by["SN2"].optel_schedule_wo is None and by["SN2"].ref_id is None and by["SN2"].side == "Bottom"
    assert by[None].optel_schedule_wo == "W1" and by[None].ref_id is None and by[None].sn_detail is None


SLOT = "xml_tag_name string, product_id string, date_time timestamp, user_name string, component_name string, slot_number int, location string, ul_possible_missing int, ul_slot_picks int, ul_slot_placements int, ul_slot_vision_failures int"


def slot_result(spark, cost):
    events = spark.createDataFrame(
        [("c1-smt-meq-slot", "W1.a", AT, "E1", part, 5, "0,1,0", 0, 9, 8, 1) for part in ("10", "11")], SLOT
    )
    raw = spark.createDataFrame(
        [("1020", "M1", p, "A", 4.0, "N1", "PK", "f") for p in ("10", "11")],
        "plant string, machine string, part_number string, head_type string, pins double, nozzle1 string, package string, hdfs_file_name string",
    )
    return enrich.slot(
        events,
        equipment(spark, ("M1", "1020", "E1", "A", "f1")),
        lookups.load(raw, "comptype"),
        orders(spark, ("W1", "S1", "Top", "A1", "1020", 2.0, "f")),
        cost,
    )


def test_sorts_begin_with_the_key_that_tells_rows_apart(spark):
    def sorts(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"Sort \[(\w+)#", plan)

    schema = "plant string, machine string, part_number string, head_type string, pins double, nozzle1 string, package string, hdfs_file_name string"
    parts = lookups.load(spark.createDataFrame([("1020", "M1", "10", "A", 4.0, "N1", "PK", "f")], schema), "comptype")
    assert set(sorts(parts)) == {"part_number"}
    assert set(sorts(orders(spark, ("W1", "S1", "Top", "A1", "P", 2.0, "f")))) == {"optel_schedule_wo"}
    assert set(lookups.LOOKUPS["comptype"].sorted_by) == set(lookups.LOOKUPS["comptype"].keys)
    assert lookups.LOOKUPS["info"].sorted_by == lookups.LOOKUPS["info"].keys
    cost = spark.createDataFrame([("10", "1020", 7.5)], "material string, plant string, unit_cost double")
    with session.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = slot_result(spark, cost)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [component_name#" in plan and "[part_number#" in plan and "[cost_material#" in plan


def test_slot_cost_default(spark, rows):
    cost = spark.createDataFrame([("10", "1020", 7.5)], "material string, plant string, unit_cost double")
    assert rows(slot_result(spark, cost), "component_name", "unit_cost", "slot", "track") == [
        ("10", 7.5, "5.1", "2"), ("11", 0.2, "5.1", "2"),
    ]
    assert rows(slot_result(spark, None), "unit_cost") == [(0.2,), (0.2,)]


def test_wide_events(spark):
    events, machines, info, wo = nozzle_inputs(spark)
    made = wide.events(nozzle=enrich.nozzle(events, machines, info, wo), slot=slot_result(spark, None))
    assert made.columns == list(wide.WIDE_COLUMNS) and len(made.columns) == 43
    texts = made.select(wide.event_json().alias("full"), wide.event_json(sparse=True).alias("sparse")).collect()
    for row in texts:
        full, sparse = json.loads(row.full), json.loads(row.sparse)
        assert len(full) == 43 and None not in sparse.values()
        assert {k: v for k, v in full.items() if v is not None} == sparse
    quoted = made.withColumn("side", F.lit('a"b')).select(wide.event_json()).first()[0]
    assert json.loads(quoted)["side"] == 'a"b'
    row = made.filter("table_name = 'slot'").first()
    assert row.slot_pins == 4.0 and row.picks == 9.0 and row.slot_number == "5" and row.comp_missing is None


def test_nozzle_v1_keeps_unknown_machines(spark, rows):
    events = spark.createDataFrame(
        [("t", "p", AT, "E1", "0,21,22", 1, 9, 8, 1, 0, 2), ("t", "p", AT, None, "0,1,2", 1, 9, 8, 1, 0, 2)], NOZZLE
    )
    got = enrich.nozzle_by_equipment(events, equipment(spark, ("M1", "P", "E1", "A", "f")))
    assert rows(got, "ch_hole", "mach_ch_hole", "ulrejects") == [("1-2", None, 2.0), ("21-22", "M1-21-22", 2.0)]
