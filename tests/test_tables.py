"""Registry, landing, routing and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from linepulse import registry
from linepulse.functions import text, times
from linepulse.operators import kpi, landing, report, routing
from linepulse.registry import SPECS
from linepulse.session import fresh_path, shared_dir
from linepulse.sinks import files, payloads, topics
from linepulse.sources import records, tables

# Columns of each table with the seven lineage columns.
WIDTHS = {
    "ea_spi_header": 18, "ea_spi_detail": 21, "ea_pap_gen": 22, "ea_pap_slot": 40,
    "ea_pap_timers": 21, "ea_pap_info": 15, "ea_pap_nozzle": 35, "ea_progorderlist": 21,
    "ea_ftdefects": 32, "ea_assydetail": 22, "ea_units": 11, "ea_wodetail": 24,
    "ea_assycircuitsilk": 13, "ea_parentchild": 11, "ea_comptype": 32, "ea_workorder": 17,
    "ea_equipmentoutline": 17,
}


def test_registry_widths():
    assert {name: len(spec.schema) for name, spec in SPECS.items()} == WIDTHS


def test_registry_types():
    kinds = {f.name: f.dataType.simpleString() for f in SPECS["ea_spi_header"].schema}
    assert kinds["inspection_end_dttm"] == "timestamp"
    assert kinds["inspection_test_duration_sec"] == "decimal(5,2)"
    assert SPECS["ea_progorderlist"].schema["silkscreen"].dataType.simpleString() == "bigint"
    assert SPECS["ea_pap_info"].schema["is_keyed"].dataType.simpleString() == "boolean"
    assert SPECS["ea_equipmentoutline"].schema["timestamp"].dataType.simpleString() == "timestamp"
    assert SPECS["ea_pap_slot"].schema["ul_slot_rejects"].dataType.simpleString() == "int"


def test_ddl_takes_the_environment():
    ddl = registry.table_ddl(SPECS["ea_pap_gen"], "q_", "/warehouse")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS q_elec_assy.ea_pap_gen (`xml_tag_name` string")
    assert ddl.endswith("USING parquet LOCATION '/warehouse/ea_pap_gen'")
    assert registry.KPI_TABLES["fpy"] == "ea_spi_fpy" and registry.KPI_TABLES["ffr"] == "ea_spi_ffr"


def test_field_keys_agree(spark):
    names = ["Head #", "# Pins", "PiPPlc/panel", "Setup#", "ulVPSHeightFailure", "Time Stamp"]
    df = spark.createDataFrame([(names,)], "n array<string>")
    keys = dict(zip(names, df.select(text.keys_of(F.col("n"))).first()[0]))
    assert keys["Head #"] == SPECS["ea_progorderlist"].field_key("head")
    assert keys["# Pins"] == SPECS["ea_comptype"].field_key("pins")
    assert keys["PiPPlc/panel"] == SPECS["ea_wodetail"].field_key("pipplc_panel")
    assert keys["Setup#"] == SPECS["ea_wodetail"].field_key("setup")
    assert keys["ulVPSHeightFailure"] == SPECS["ea_pap_nozzle"].field_key("ul_vps_height_failure")
    assert keys["Time Stamp"] == SPECS["ea_progorderlist"].field_key("time_stamp")


def _record(tag, **fields):
    return (json.dumps({"xml_tag_name": tag, "bicoe_load_dttm": "2024-01-02T03:04:05.678Z", **fields}),)


def test_landing_all_tables(spark):
    made = []
    for spec in SPECS.values():
        fields = {spec.source.get(c, c): "1" for c in spec.columns}
        made.append(_record(f"x{spec.route if spec.route[0] == '-' else '-' + spec.route}", **fields))
    read = routing.classify(records.json_records(spark.createDataFrame(made, "value string"))).cache()
    assert {r.record_type for r in read.collect()} == set(SPECS)
    for name, spec in SPECS.items():
        (row,) = landing.land_table(read, name).collect()
        assert row.bicoe_load_dttm.isoformat() == "2024-01-02T03:04:05"
        for column in spec.columns:
            kind = spec.kind(column)
            if kind == "timestamp" or kind == "boolean":
                assert row[column] is None
            else:
                assert row[column] is not None, (name, column)


def test_landing_values(spark):
    made = [
        _record("a-info", Name="n", IsKeyed="TRUE", CRCId="12", Shape="x", Description=""),
        _record("a-info", Name="m", IsKeyed="no", CRCId=7, Shape=" 4 "),
    ]
    read = records.json_records(spark.createDataFrame(made, "value string"))
    got = {r.name: tuple(r)[-7:] for r in landing.land(read, "ea_pap_info").collect()}
    assert got["n"] == (True, 12, "", None, None, None, None)
    assert got["m"] == (None, 7, None, 4, None, None, None)


def test_header_times(spark):
    made = [_record("x-spiTest-header", InspectionEndTime="10/20/2017 14:36:49", InspectionTestTime="12.345")]
    read = records.json_records(spark.createDataFrame(made, "value string"))
    row = landing.land(read, "ea_spi_header").first()
    assert row.inspection_end_dttm.isoformat() == "2017-10-20T14:36:49"
    assert float(row.inspection_test_duration_sec) in (12.34, 12.35)


def test_inspection_times(spark):
    df = spark.createDataFrame(
        [("10/20/2017 02:36:49 PM",), ("10/20/2017 14:36:49",), ("20.10.2017",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(times.inspection_time(F.col("t"))).collect()]
    assert got[0] == got[1] and got[0].hour == 14 and got[2:] == [None, None]


def test_routing_first_match_and_compat(spark):
    df = spark.createDataFrame(
        [("x-nozzle", "note -info"), ("x-orders", ""), ("x-none", "")], "xml_tag_name string, raw string"
    )
    got = {r.xml_tag_name: r.record_type for r in routing.classify(df).collect()}
    assert got == {"x-nozzle": "ea_pap_nozzle", "x-orders": "ea_workorder", "x-none": None}
    whole = df.withColumn("raw", F.concat_ws(" ", "xml_tag_name", "raw"))
    loose = sorted((r.xml_tag_name, str(r.record_type)) for r in routing.classify(whole, compat=True).collect())
    assert loose == [
        ("x-none", "None"), ("x-nozzle", "ea_pap_info"), ("x-nozzle", "ea_pap_nozzle"), ("x-orders", "ea_workorder"),
    ]
    assert "ea_workorder" not in routing.shared_topics()
    assert routing.per_type_topics()["ea_pap_slot"] == ["ea_pap_slot"]
    assert routing.to_topics(routing.classify(df)).select("topic").collect()[0][0] == "records"


def test_create_tables_and_append_by_name(spark, rows):
    names = tables.create_tables(spark, "d_")
    assert len(names) == 17
    read = records.json_records(spark.createDataFrame([_record("x-units", SERIAL_NO="S1")], "value string"))
    landed = landing.land(read, "ea_units")
    files.append_table(landed.select(*reversed(landed.columns)), "d_elec_assy.ea_units")
    again = tables.catalog_table(spark, "ea_units", "d_")
    assert rows(again, "serial_no", "order_no") == [("S1", None)]
    assert again.schema.names == SPECS["ea_units"].schema.names
    with pytest.raises(ValueError):
        registry.full_name("x_", "ea_units")


def test_batch_folders_are_replaced(spark):
    path = fresh_path(spark, "t")
    df = spark.range(5)
    files.append_parquet(df, path, 0)
    files.append_parquet(df, path, 1)
    files.append_parquet(df, path, 1)
    assert spark.read.parquet(path).count() == 10
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partitioned_append_prunes(spark):
    path = fresh_path(spark, "k")
    df = spark.range(100).selectExpr(
        "concat('M', id % 3) AS machine_id", "if(id % 2 = 0, 'Top', 'Bottom') AS pcb_side", "id"
    )
    files.append_partitioned(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 100 and set(back.columns) == {"id", "machine_id", "pcb_side"}
    plan = back.filter("machine_id = 'M1'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(machine_id" in plan


def test_messages_and_fan_out(spark, rows):
    df = spark.createDataFrame([(1, "a")], "id int, topic string")
    assert rows(topics.as_messages(df.drop("topic"), topic="t")) == [('{"id":1}', "t")]
    assert rows(topics.as_messages(df, F.lit("v"))) == [("v", "a")]
    sent = topics.fan_out(topics.as_messages(df.drop("topic")), ["x", "y"])
    assert rows(sent) == [('{"id":1}', "x"), ('{"id":1}', "y")]


def test_payloads_cover_rows_in_bounded_bodies(spark):
    df = spark.range(1050).selectExpr("id", "id % 7 AS v", "cast(null AS string) AS n")
    made = payloads.payloads(df, ["id"], 10, service="s", envelope=True).collect()
    assert sum(r.row_count for r in made) == 1050 and max(r.row_count for r in made) <= 10
    seen = [row["id"] for r in made for row in json.loads(r.payload)["inputJson"]]
    assert sorted(seen) == list(range(1050))
    assert len({(r.service, r.bucket, r.chunk) for r in made}) == len(made)
    buckets = {r.bucket for r in made}
    assert len(buckets) == 2 and len(made) <= 105 + len(buckets)


def test_payloads_do_not_depend_on_partitions(spark):
    df = spark.range(300).selectExpr("id", "id * 2 AS v")
    one = payloads.payloads(df.coalesce(1), ["id"], 7).collect()
    many = payloads.payloads(df.repartition(9), ["id"], 7).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_kpi_store_from_messages(spark, rows):
    messages = spark.createDataFrame(
        [
            ('{"generated_key":"K","machine_id":"M","pcb_side":"Top","fpy_result":0.5,"interval_id":9}',),
            ('{"generated_key":"K","machine_id":"M","pcb_side":"Top","volume_result":98.5}',),
        ],
        "value string",
    )
    assert rows(kpi.from_json(messages, "fpy"), "generated_key", "result", "interval_id") == [("K", 0.5, 9)]
    assert rows(kpi.from_json(messages, "volume"), "result") == [(98.5,)]
    assert kpi.from_json(messages, "ffr").count() == 0


def test_reports(spark, rows):
    offsets = spark.createDataFrame(
        [("a", 0, 5), ("a", 0, 9), ("a", 1, 4), ("b", 0, 1)], "topic string, partition int, offset long"
    )
    assert rows(report.topic_progress(offsets)) == [("a", 13), ("b", 1)]
    counts = report.row_counts({"x": spark.range(3), "y": spark.range(0)})
    assert rows(counts) == [("x", 3), ("y", 0)]
    assert report.newest(spark.range(5), "id", 2).count() == 2


def test_xref_and_cost(spark, rows):
    assert rows(tables.location_plant(spark)) == [
        ("meq", "1020"), ("mmc", "1150"), ("sng", "5170"), ("meq", "1020"),
    ]
    cost = spark.createDataFrame([("000123", "p", 1.5), ("0", "p", 2.0)], "material string, plant string, unit_cost double")
    assert rows(tables.material_cost(cost)) == [("", "p", 2.0), ("123", "p", 1.5)]
