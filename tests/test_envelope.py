"""Parsing of XML envelopes, rule by rule."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linepulse.operators import landing, routing
from linepulse.sources import envelope, records


def node(text, names=None, types=None, sep=",", tag="c1-smt-meq-spiTest-detail", tag_id="1"):
    about = "" if names is None else f' fieldnames="{names}" fieldtypes="{types}" separator="{sep}"'
    return (
        f"<LiveTextData><TagName>{tag}</TagName><Status>Good</Status><TagId>{tag_id}</TagId>"
        f"<TimeStamp>2017-10-20T10:36:49Z</TimeStamp><TagValue{about}>{text}</TagValue></LiveTextData>"
    )


def message(*nodes, filename="line4_001.txt"):
    name = "" if filename is None else f' filename="{filename}"'
    return f"<ArrayOfLiveTextData{name}>{''.join(nodes)}</ArrayOfLiveTextData>"


def parse(spark, *messages):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return envelope.parse(df, "xml_in", "line_7")


def values(df):
    return [
        (list(r.field_names or []), list(r.field_values or []), r.reason)
        for r in df.orderBy("raw").collect()
    ]


HEADER = node(
    "K1,M1,Top,BRD-A,GOOD,12.5",
    "GeneratedKey,MachineID,side,PCBName,PCBResult,InspectionTestTime",
    "String,String,String,String,String,Double",
    tag="c1-smt-meq-spiTest-header",
)
DETAIL_NAMES = "GeneratedKey,ModuleNo,RefDesignator,Volume"
DETAIL_TYPES = "String,Int,String,Double"


def test_header_and_details(spark):
    text = "K1,1,R10,98.5\nK1,2,R11,bad\n\nK1,3"
    parsed = parse(spark, message(HEADER, node(text, DETAIL_NAMES, DETAIL_TYPES))).cache()
    assert parsed.count() == 4
    head = parsed.filter("xml_tag_name like '%header'").first()
    assert head.file_name == "line4_001.txt" and head.kafka_topic == "xml_in"
    assert head.hdfs_file_name == "line_7" and head.xml_status == "Good"
    assert head.field_values == ["K1", "M1", "Top", "BRD-A", "GOOD", "12.5"]
    bad = {r.raw: (r.reason, r.bad_fields) for r in parsed.filter("xml_tag_name like '%detail'").collect()}
    assert bad == {
        "K1,1,R10,98.5": (None, []),
        "K1,2,R11,bad": ("bad_fields", ["Volume"]),
        "K1,3": ("bad_fields", ["RefDesignator", "Volume"]),
    }
    landed = landing.land(
        routing.with_tag(envelope.records(parsed), "spiTest-detail"), "ea_spi_detail"
    )
    got = {r.module_nbr: (r.ref_designator, r.solder_paste_volume) for r in landed.collect()}
    assert {k: (a, b if b is None else float(b)) for k, (a, b) in got.items()} == {
        1: ("R10", 98.5),
        2: ("R11", None),
        3: (None, None),
    }


def test_single_node_has_only_details(spark):
    parsed = parse(spark, message(node("a,1\nb,2", "K,N", "String,Int"), filename=None))
    assert values(parsed) == [(["K", "N"], ["a", "1"], None), (["K", "N"], ["b", "2"], None)]
    assert {r.file_name for r in parsed.collect()} == {""}


def test_header_block_is_one_record(spark):
    parsed = parse(
        spark, message(node("a,1\nb", "K,N,L", "String,String,String"), node("x", "K", "String"))
    )
    heads = [r for r in parsed.collect() if len(r.field_names) == 3]
    assert len(heads) == 1 and heads[0].field_values == ["a", "1\nb"]


def test_description_carries_over(spark):
    parsed = parse(
        spark,
        message(node("h", "K", "String"), node("a|1", "K,N", "String,Int", r"\|"), node("b|2")),
    )
    assert values(parsed)[1:] == [(["K", "N"], ["b", "2"], None), (["K"], ["h"], None)]


def test_separators(spark):
    ok = [("a  1", r"\s+"), ("a|1", r"\|"), ("a;1", ";"), ("a--1", "--"), ("a;,1", "[;,]+")]
    for text, sep in ok:
        assert values(parse(spark, message(node(text, "K,N", "String,Int", sep)))) == [
            (["K", "N"], ["a", "1"], None)
        ], sep
    for sep in ("(", "[", "*", "a{", "\\"):
        (row,) = parse(spark, message(node("a1", "K,N", "String,Int", sep))).collect()
        assert row.reason == "bad_separator" and not row.readable and row.raw == "a1"


def test_trailing_blanks_and_long_rows(spark):
    parsed = parse(spark, message(node("a,,\nb, 5 ,x,extra,more", "K,N,S", "String,Int,String")))
    assert values(parsed) == [
        (["K", "N", "S"], ["a", "", ""], None),
        (["K", "N", "S"], ["b", "5", "x"], None),
    ]


def test_crlf_and_inner_blanks(spark):
    parsed = parse(spark, message(node("a,1&#13;\n \t \nb,  \n", "K,N", "String,Int")))
    assert values(parsed) == [(["K", "N"], ["a", "1"], None), (["K", "N"], ["b", "  "], None)]


def test_type_words(spark):
    names = "a,b,c,d,e,f"
    types = "Decimal,INT,boolean,Int64,float,Double"
    parsed = parse(
        spark,
        message(
            node("1.5,x,TRUE,9999999999,2.5,1e3", names, types),
            node("x,x,yes,1.5,x,x", names, types),
        ),
    )
    by_raw = {r.raw: r.bad_fields for r in parsed.collect()}
    assert by_raw["1.5,x,TRUE,9999999999,2.5,1e3"] == []
    assert by_raw["x,x,yes,1.5,x,x"] == ["a", "c", "d", "e", "f"]


def test_malformed_message_is_kept(spark):
    good = message(node("a,1", "K,N", "String,Int"))
    parsed = parse(spark, "<ArrayOfLiveTextData><Live", good)
    assert envelope.records(parsed).count() == 1
    (lost,) = envelope.quarantine(parsed).collect()
    assert lost.reason == "malformed_xml" and lost.raw == "<ArrayOfLiveTextData><Live"


def test_duplicate_field_last_wins(spark):
    parsed = parse(
        spark,
        message(node("S1,P1,S2", "SERIAL_NO,PANEL_NO,SERIAL_NO", "String,String,String", tag="x-units")),
    )
    row = landing.land(parsed, "ea_units").first()
    assert (row.serial_no, row.panel_no, row.order_no) == ("S2", "P1", None)


def test_record_json(spark):
    parsed = parse(
        spark,
        message(node('a"b,5,2.50,true,x, ', "K,N,D,B,I,E", "String,Int,Double,Boolean,Int,Int")),
    )
    text = parsed.select(envelope.record_json(with_uuid=True)).first()[0]
    data = json.loads(text)
    assert data["K"] == 'a"b' and data["N"] == 5 and data["D"] == 2.5 and data["B"] is True
    assert data["I"] == "" and data["E"] == " "
    assert data["xml_tag_name"] == "c1-smt-meq-spiTest-detail" and len(data["uuid"]) == 64


_cell = st.text("abcXYZ019 -.", max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_cell, _cell, _cell), min_size=1, max_size=15))
def test_round_trip(spark, table):
    lines = ["|".join(row) for row in table]
    names = "alpha,beta,gamma"
    parsed = parse(spark, message(node("\n".join(lines), names, "String,String,String", r"\|")))
    want = sorted(
        tuple(c if not c.strip() else c.strip() for c in row) for row in table
    )
    assert sorted(tuple(r.field_values) for r in parsed.collect()) == want


def test_json_records(spark):
    rows = [
        ('{"xml_tag_name":"t-units","SERIAL_NO":"S","ORDER_NO":7,"xml_status":"Good"}',),
        ("not json",),
    ]
    read = records.json_records(spark.createDataFrame(rows, "value string"))
    landed = landing.land_table(routing.classify(read), "ea_units").collect()
    assert [(r.serial_no, r.order_no, r.xml_status, r.panel_no) for r in landed] == [
        ("S", "7", "Good", None)
    ]
    assert routing.unrouted(routing.classify(read)).select("raw").collect()[0][0] == "not json"


def test_typed_json_and_values(spark):
    df = spark.createDataFrame([(b"k", b'{"a":1}')], "key binary, value binary")
    read = records.typed_json(records.values(df), "a int, b string")
    assert [tuple(r) for r in read.collect()] == [(1, None)]
