"""Registered queries: every operator on plant relations derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions import convert, text, times
from linepulse.operators import enrich, kpi, landing, limits, lookups, report, routing, wide
from linepulse.plans.views import table, view
from linepulse.registry import KPI_SCHEMA, KPI_TABLES, ROUTES, SPECS
from linepulse.session import fresh_path, materialize, spread
from linepulse.sinks import files, payloads, topics
from linepulse.sources import envelope, records, tables
from linepulse.streaming import events as event_stream
from linepulse.streaming import kpi as kpi_stream
from linepulse.streaming.ingest import ingest, land_json
from linepulse.streaming.lookup_store import LookupStore
from linepulse.streaming.runner import start

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAY = "2024-01-30 00:00:00"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- indicators ---------------------------------------------------------------------


@query
def fpy_by_machine(spark, d):
    return _round(kpi.fpy(view(spark, d, "header")), "fpy_result")


@query
def ffr_by_machine(spark, d):
    return _round(kpi.ffr(view(spark, d, "header")), "ffr_result")


@query
def yields_one_pass(spark, d):
    ratios = kpi.unit_ratios(view(spark, d, "header"))
    return _round(ratios, "fpy_result", "ffr_result")


@query
def fpy_compat_fanout(spark, d):
    rows = kpi.fpy(view(spark, d, "header"), compat=True)
    return _round(rows, "fpy_result")


@query
def volume_by_machine(spark, d):
    rows = kpi.volume(view(spark, d, "detail"), view(spark, d, "header"))
    return _round(rows, "volume_result")


@query
def interval_yield(spark, d):
    points = view(spark, d, "kpi_points").select(
        "machine_id",
        "pcb_side",
        F.col("max_inspection_end_time").alias("inspection_end"),
        F.when(F.col("result") < 0.02, "GOOD").when(F.col("result") < 0.06, "PASS").otherwise(
            "FAIL"
        ).alias("pcb_result"),
    )
    return _round(kpi.interval_yields(points), "fpy_result", "ffr_result")


@query
def interval_15min(spark, d):
    ids = view(spark, d, "kpi_points").select(
        times.interval_id(F.col("max_inspection_end_time")).alias("interval_id"), "result"
    )
    return ids.groupBy("interval_id").agg(
        F.count("*").alias("points"), F.round(F.max("result"), 6).alias("top")
    )


@query
def interval_compat(spark, d):
    return view(spark, d, "kpi_points").select(
        "generated_key",
        times.interval_id(F.col("max_inspection_end_time"), compat=True).alias("interval_id"),
    )


@query
def distinct_machines(spark, d):
    return kpi.machines(view(spark, d, "header"))


@query
def kpi_routing(spark, d):
    """KPI records of one topic, told apart by their content."""
    messages = kpi.messages(kpi.yields(view(spark, d, "header"), as_of=DAY))
    return kpi.from_json_all(messages).groupBy("kpi", "machine_id", "pcb_side").agg(
        F.count("*").alias("row_count"), F.round(F.max("result"), 6).alias("result")
    )


# --- control limits -------------------------------------------------------------------


@query
def xmr_limits(spark, d):
    return _round(limits.xmr(view(spark, d, "kpi_points")), "ucl", "lcl", "mean")


@query
def xmr_by_user(spark, d):
    """Many small groups, some of one point."""
    points = table(spark, d, "events").select(
        F.col("user_id"), F.col("event_type"), F.col("ts").cast("timestamp").alias("ts"),
        "event_id", (F.col("value") / 1000).alias("result"),
    )
    out = limits.xmr(points, ["ts", "event_id"], ["user_id", "event_type"])
    return _round(out, "ucl", "lcl", "mean")


def _stores(spark, d) -> dict[str, DataFrame]:
    store = view(spark, d, "kpi_store")
    return {
        "fpy": store.filter(F.col("machine_id") != "error"),
        "ffr": store.filter(F.col("machine_id") != "view"),
        "volume": store,
    }


_LIMITS = [f"{k}_{c}" for k in ("fpy", "ffr", "volume") for c in ("ucl", "lcl", "mean")]


@query
def kpi_limits_all(spark, d):
    out = limits.control_limits(
        _stores(spark, d), kpi.machines(view(spark, d, "kpi_store")), DAY
    )
    return _round(out, *_LIMITS)


@query
def kpi_limits_compat(spark, d):
    out = limits.control_limits(
        _stores(spark, d), kpi.machines(view(spark, d, "kpi_store")), DAY, compat=True
    )
    return _round(out, *_LIMITS)


@query
def kpi_listagg(spark, d):
    points = view(spark, d, "kpi_points").withColumn("result", F.round("result", 5))
    return _round(limits.point_lists(points, size=200), "mean")


@query
def last_24h(spark, d):
    recent = limits.recent(view(spark, d, "kpi_store"), DAY)
    return recent.groupBy("machine_id", "pcb_side").agg(
        F.count("*").alias("points"), F.round(F.avg("result"), 6).alias("mean")
    )


# --- scalar expressions ---------------------------------------------------------------


def _event_times(spark, d, pattern: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select(
        "event_id", F.date_format(stamp, pattern).alias("txt")
    )


@query
def ts_parse_12h(spark, d):
    rows = _event_times(spark, d, times.SPI_12H)
    return rows.select("event_id", times.inspection_time(F.col("txt")).alias("parsed"))


@query
def ts_parse_24h(spark, d):
    rows = _event_times(spark, d, times.SPI_24H)
    return rows.select("event_id", times.inspection_time(F.col("txt")).alias("parsed"))


@query
def ts_parse_iso(spark, d):
    rows = _event_times(spark, d, times.ISO)
    parsed = times.parse_time(F.col("txt"))
    epoch = F.unix_seconds(parsed)
    return rows.select(
        "event_id", parsed.alias("parsed"), times.from_epoch(epoch).alias("from_epoch")
    )


@query
def ref_split(spark, d):
    circuit, ref = F.col("circuit"), F.col("ref_id")
    return view(spark, d, "progorderlist_raw").groupBy(
        text.panel_circuit(circuit, ref).alias("panel_circuit"),
        text.ref_designator(circuit, ref).alias("ref_des"),
    ).agg(F.count("*").alias("row_count"))


@query
def url_concat(spark, d):
    return view(spark, d, "wodetail_raw").select(
        "optel_schedule_wo",
        text.work_order_url(lookups.REPORT_BASE, F.col("sap_wo"), F.col("plant")).alias("wo_detail"),
        text.machine_side(F.col("plant"), F.col("side")).alias("plant_side"),
    ).distinct()


@query
def location_decode(spark, d):
    place, machine = F.col("location"), F.col("user_name")
    return view(spark, d, "nozzle_events").groupBy(
        text.changer_hole(place).alias("ch_hole"),
        text.changer_hole(place, shift=0).alias("ch_hole_plain"),
        text.machine_changer_hole(machine, place).alias("mach_ch_hole"),
        text.slot_track(place).alias("track"),
        text.slot_label(F.col("tooltype"), place).alias("slot"),
        text.tag_location(F.col("xml_tag_name")).alias("tag_location"),
    ).agg(F.count("*").alias("row_count"))


@query
def workcentre_decode(spark, d):
    code = F.col("placing_wc_code")
    return view(spark, d, "defect_events").groupBy(
        text.workcentre_side(code).alias("side"), text.workcentre_machine(code).alias("machine")
    ).agg(F.count("*").alias("row_count"))


@query
def typed_convert(spark, d):
    value, word = F.col("txt"), F.col("word")
    rows = view(spark, d, "words").select(
        "word", "txt", convert.converts(value, word).alias("ok"),
        convert.json_value(value, word).alias("as_json"),
        convert.cast_text(value, "double").alias("number"),
    )
    return rows.groupBy("word", "ok").agg(
        F.count("*").alias("row_count"),
        F.count("number").alias("numbers"),
        F.round(F.sum("number"), 2).alias("total"),
        F.count_if(F.col("as_json") == '""').alias("empty"),
    )


@query
def material_cost(spark, d):
    return tables.material_cost(view(spark, d, "material_cost_raw"))


@query
def location_plant(spark, d):
    """The fixed cross-reference against the plants of the tags."""
    tags = view(spark, d, "tagged").select(text.tag_location(F.col("xml_tag_name")).alias("location"))
    xref = tables.xref(tables.location_plant(spark))
    # tags are counted before the join: nearly all of them name one of a few locations
    counted = tags.groupBy("location").agg(F.count("*").alias("row_count"))
    return counted.join(xref, "location").groupBy("location", "plant").agg(
        F.sum("row_count").alias("row_count")
    )


# --- master data ----------------------------------------------------------------------


def _event_versions(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("version"), "event_id", "value"
    )


@query
def latest_version(spark, d):
    return lookups.one_per_key(
        _event_versions(spark, d), ["user_id", "event_type"], ["version"]
    )


@query
def first_version(spark, d):
    return lookups.one_per_key(
        _event_versions(spark, d), ["user_id", "event_type"], ["version"], "first"
    )


def _lookup(spark, d, name: str, compat: bool = False) -> DataFrame:
    return lookups.load(view(spark, d, f"{name}_raw"), name, compat=compat)


@query
def lookup_equipment(spark, d):
    return _lookup(spark, d, "equipment")


@query
def lookup_info(spark, d):
    return _lookup(spark, d, "info")


@query
def lookup_wodetail(spark, d):
    return _lookup(spark, d, "wodetail")


@query
def lookup_wodetail_first(spark, d):
    return _lookup(spark, d, "wodetail", compat=True)


@query
def lookup_progorderlist(spark, d):
    return _lookup(spark, d, "progorderlist")


@query
def lookup_comptype(spark, d):
    return _lookup(spark, d, "comptype")


@query
def lookup_merge(spark, d):
    """Rows up to 1998 as the snapshot, later ones merged into it."""
    rows = lookups.versions(view(spark, d, "wodetail_raw"), "wodetail")
    early = F.col("version") < "line_1998-01-01"
    snapshot = lookups.one_per_key(
        rows.filter(early), lookups.LOOKUPS["wodetail"].keys, ["version"]
    )
    return lookups.merge(snapshot, rows.filter(~early), "wodetail")


@query
def lookup_merge_first(spark, d):
    rows = lookups.versions(view(spark, d, "comptype_raw"), "comptype")
    early = F.col("version") < "line_1998-01-01"
    snapshot = lookups.one_per_key(
        rows.filter(early), lookups.LOOKUPS["comptype"].keys, ["version"], "first"
    )
    return lookups.merge(snapshot, rows.filter(~early), "comptype", compat=True)


@query
def version_counts(spark, d):
    return lookups.version_counts(_lookup(spark, d, "equipment"))


# --- enrichment -----------------------------------------------------------------------


def _xref(spark, d) -> DataFrame:
    return tables.xref(view(spark, d, "xref_raw"))


def _lookups(spark, d, *names: str) -> dict[str, DataFrame]:
    return {name: _lookup(spark, d, name) for name in names}


def _nozzle(spark, d, now, xref=None) -> DataFrame:
    events = view(spark, d, "nozzle_events")
    return enrich.nozzle(events, now["equipment"], now["info"], now["wodetail"], xref)


def _timers(spark, d, now, xref=None) -> DataFrame:
    return enrich.timers(view(spark, d, "timer_events"), now["equipment"], now["wodetail"], xref)


def _defects(spark, d, now) -> DataFrame:
    return enrich.defects(view(spark, d, "defect_events"), now["wodetail"], now["progorderlist"])


def _slot(spark, d, now) -> DataFrame:
    cost = tables.material_cost(view(spark, d, "material_cost_raw"))
    return enrich.slot(
        view(spark, d, "slot_events"), now["equipment"], now["comptype"], now["wodetail"], cost
    )


@query
def nozzle_enriched(spark, d):
    return _nozzle(spark, d, _lookups(spark, d, "equipment", "info", "wodetail"))


@query
def nozzle_enriched_xref(spark, d):
    now = _lookups(spark, d, "equipment", "info", "wodetail")
    return _nozzle(spark, d, now, _xref(spark, d))


@query
def nozzle_v1(spark, d):
    """Only the machines with heads 0 and 2 are known here."""
    known = _lookup(spark, d, "equipment").withColumn(
        "equipment_make",
        F.when(F.col("head_1").isin("H0", "H2"), F.col("equipment_make")),
    )
    return enrich.nozzle_by_equipment(view(spark, d, "nozzle_events"), known)


@query
def timers_enriched(spark, d):
    return _timers(spark, d, _lookups(spark, d, "equipment", "wodetail"))


@query
def timers_enriched_xref(spark, d):
    return _timers(spark, d, _lookups(spark, d, "equipment", "wodetail"), _xref(spark, d))


@query
def defects_enriched(spark, d):
    return _defects(spark, d, _lookups(spark, d, "wodetail", "progorderlist"))


@query
def slot_enriched(spark, d):
    """The machines are written first: while their size is not known, all events are sent to meet them."""
    now = _lookups(spark, d, "equipment", "comptype", "wodetail")
    now["equipment"] = materialize(now["equipment"], "equipment")
    return _slot(spark, d, now)


@query
def comma_join(spark, d):
    return enrich.machine_nozzles(view(spark, d, "nozzle_events"), _lookup(spark, d, "equipment"))


@query
def limited_newest(spark, d):
    """The result cap, with an order that makes it repeatable."""
    rows = view(spark, d, "timer_events").select("date_time", "product_id", "user_name", "ul_idle_time")
    newest = [F.col("date_time").desc(), "product_id", "user_name", "ul_idle_time"]
    return enrich.limited(rows, 100, newest)


def _wide(spark, d) -> DataFrame:
    """All four event types; the lookups that several of them read are written once."""
    now = _lookups(spark, d, *lookups.LOOKUPS)
    for name in ("equipment", "wodetail"):
        now[name] = materialize(now[name], name)
    return wide.events(
        nozzle=_nozzle(spark, d, now),
        timers=_timers(spark, d, now),
        defects=_defects(spark, d, now),
        slot=_slot(spark, d, now),
    )


@query
def wide_events(spark, d):
    return _wide(spark, d)


@query
def wide_event_json(spark, d):
    """Size of the full and the sparse JSON shape per event type."""
    shapes = _wide(spark, d).select(
        "table_name",
        F.size(F.json_object_keys(wide.event_json())).alias("full_keys"),
        F.size(F.json_object_keys(wide.event_json(sparse=True))).alias("sparse_keys"),
    )
    return shapes.groupBy("table_name", "full_keys", "sparse_keys").agg(
        F.count("*").alias("row_count")
    )


# --- messages, routes, landing ----------------------------------------------------------


def _spi_message() -> Column:
    """One envelope per order: a header block and two detail lines."""
    key = F.col("o_orderkey").cast("string")
    return F.concat(
        F.lit('<ArrayOfLiveTextData filename="f'), F.col("o_custkey").cast("string"), F.lit('.txt">'),
        F.lit("<LiveTextData><TagName>c1-smt-sng-spiTest-header</TagName><Status>Good</Status><TagId>"),
        F.col("o_custkey").cast("string"),
        F.lit("</TagId><TimeStamp>t1</TimeStamp>"),
        F.lit('<TagValue fieldnames="GeneratedKey,MachineID,PCBResult,InspectionEndTime" '
              'fieldtypes="String,String,String,String" separator=",">'),
        key, F.lit(",M1, "), F.col("o_orderpriority"), F.lit(" ,"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), times.SPI_24H),
        F.lit("</TagValue></LiveTextData>"),
        F.lit("<LiveTextData><TagName>c1-smt-sng-spiTest-detail</TagName><Status>Good</Status><TagId>2"
              "</TagId><TimeStamp>t2</TimeStamp>"),
        F.lit('<TagValue fieldnames="GeneratedKey,ModuleNo,Volume,RefDesignator" '
              'fieldtypes="String,Int,Double,String" separator="\\|">'),
        key, F.lit("|1|"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("|R1&#13;\n\n"),
        key, F.lit("|2|"), F.col("o_custkey").cast("string"), F.lit("|R2|long\n"),
        F.lit("</TagValue></LiveTextData></ArrayOfLiveTextData>"),
    )


#: Messages for a task; each is several records.
MESSAGES = 20_000


def _spi_records(spark, d) -> DataFrame:
    messages = spread(table(spark, d, "orders"), MESSAGES).select(_spi_message().alias("value"))
    return envelope.parse(messages, "xml_in", "line_0", F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query
def xml_roundtrip(spark, d):
    parsed = envelope.records(_spi_records(spark, d))
    return parsed.select(
        "xml_tag_name",
        "file_name",
        "xml_tag_id",
        "file_timestamp",
        "bicoe_load_dttm",
        F.get("field_values", F.lit(0)).alias("first_value"),
        F.get("field_values", F.lit(2)).alias("third_value"),
        F.size("field_values").alias("value_count"),
        F.size("bad_fields").alias("bad_count"),
    )


@query
def xml_landed_detail(spark, d):
    good = routing.classify(envelope.records(_spi_records(spark, d)))
    rows = landing.land_table(good, "ea_spi_detail")
    return rows.select(
        "generated_key",
        "module_nbr",
        "ref_designator",
        F.col("solder_paste_volume").cast("double").alias("solder_paste_volume"),
        "pad_result",
        "bicoe_load_dttm",
    )


@query
def xml_landed_header(spark, d):
    good = routing.classify(envelope.records(_spi_records(spark, d)))
    rows = landing.land_table(good, "ea_spi_header")
    return rows.select("generated_key", "machine_id", "pcb_result", "inspection_end_dttm", "barcode")


def _odd_message() -> Column:
    """Messages with one fault each, by order number."""
    case = F.col("o_orderkey") % 6
    key = F.col("o_orderkey").cast("string")
    head = ('<ArrayOfLiveTextData filename="f"><LiveTextData><TagName>c1-smt-sng-units</TagName>'
            '<Status>Good</Status><TagId>1</TagId><TimeStamp>t</TimeStamp>')
    tail = F.lit("</TagValue></LiveTextData></ArrayOfLiveTextData>")

    def block(sep: str, body) -> Column:
        about = f'<TagValue fieldnames="SERIAL_NO,QTY" fieldtypes="String,Int" separator="{sep}">'
        return F.concat(F.lit(head + about), body, tail)

    return (
        F.when(case == 0, F.concat(F.lit("<ArrayOfLiveTextData><LiveTextData>"), key))
        .when(case == 1, block("(", F.concat(key, F.lit("(5"))))
        .when(case == 2, block(",", F.concat(key, F.lit(",five"))))
        .when(case == 3, block(",", key))
        .when(case == 4, block(",", F.concat(key, F.lit(",5,6\n \n"), key, F.lit(",7"))))
        .otherwise(block("\\s+", F.concat(key, F.lit("  8"))))
    )


@query
def xml_bad_rows(spark, d):
    messages = spread(table(spark, d, "orders"), MESSAGES).select(_odd_message().alias("value"))
    parsed = envelope.parse(messages, "xml_in", "line_0")
    return parsed.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.size("bad_fields")), F.lit(0)).alias("bad_fields"),
        F.countDistinct("raw").alias("texts"),
    )


@query
def record_json(spark, d):
    """Parsed records as JSON and read again without their types."""
    good = envelope.records(_spi_records(spark, d))
    messages = good.select(envelope.record_json(with_uuid=True).alias("value"))
    again = records.json_records(messages)
    rows = landing.land(routing.with_tag(again, SPECS["ea_spi_detail"].route), "ea_spi_detail")
    return rows.select(
        "generated_key",
        "module_nbr",
        "ref_designator",
        F.col("solder_paste_volume").cast("double").alias("solder_paste_volume"),
        "xml_tag_id",
    )


@query
def json_landed_timers(spark, d):
    source = spread(view(spark, d, "timer_events"))
    message = F.to_json(
        F.struct(
            "xml_tag_name",
            F.col("product_id").alias("Product_ID"),
            F.date_format("date_time", times.ISO).alias("Date_Time"),
            F.col("user_name").alias("User_Name"),
            F.col("ul_production_time").alias("ulProductionTime"),
            F.col("ul_idle_time").cast("string").alias("ulIdleTime"),
            F.col("ul_waiting_for_board_in_workarea").alias("ulWaitingForBoardInWorkArea"),
        )
    )
    rows = routing.classify(records.json_records(source.select(message.alias("value"))))
    return landing.land_table(rows, "ea_pap_timers").select(
        "xml_tag_name",
        "product_id",
        "date_time",
        "user_name",
        "ul_production_time",
        "ul_idle_time",
        "ul_waiting_for_board_in_workarea",
        "ul_setup_time",
    )


@query
def routed_counts(spark, d):
    routed = routing.classify(view(spark, d, "tagged"))
    return routed.groupBy("record_type").agg(F.count("*").alias("row_count"))


@query
def routed_compat(spark, d):
    whole = F.concat_ws(" ", "xml_tag_name", "note")
    routed = routing.classify(view(spark, d, "tagged"), compat=True, whole_record=whole)
    return routed.groupBy("record_type").agg(F.count("*").alias("row_count"))


@query
def routed_by_topic(spark, d):
    """The routes of an inlet that carries machine events only."""
    kinds = {"events": ("ea_pap_timers", "ea_pap_slot", "ea_pap_nozzle", "ea_pap_gen", "ea_pap_info")}
    routed = routing.classify(view(spark, d, "tagged"), routing.of_topic("events", kinds))
    return routed.groupBy("record_type").agg(F.count("*").alias("row_count"))


@query
def tag_filter(spark, d):
    rows = routing.with_tag(view(spark, d, "tagged"), "-nozzle")
    return rows.select("xml_tag_name", "l_orderkey", "l_linenumber", "note")


@query
def unrouted(spark, d):
    lost = routing.unrouted(routing.classify(view(spark, d, "tagged")))
    return lost.groupBy("xml_tag_name").agg(F.count("*").alias("row_count"))


@query
def topic_routing(spark, d):
    routed = routing.classify(view(spark, d, "tagged"))
    shared = routing.to_topics(routed).withColumn("layout", F.lit("shared"))
    own = routing.to_topics(routed, routing.per_type_topics()).withColumn("layout", F.lit("per_type"))
    return shared.unionByName(own).groupBy("layout", "topic").agg(F.count("*").alias("row_count"))


@query
def topic_fanout(spark, d):
    messages = topics.as_messages(view(spark, d, "tagged").select("l_orderkey", "l_linenumber"))
    return topics.fan_out(messages, ["alpha", "beta"]).groupBy("topic", "value").agg(
        F.count("*").alias("row_count")
    )


# --- sinks ------------------------------------------------------------------------------


def _order_rows(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")


@query
def payload_chunks(spark, d):
    rows = _order_rows(spark, d)
    return payloads.payloads(
        rows,
        ["o_orderkey"],
        100,
        service="orders",
        bucket=F.floor(F.col("o_orderkey") / 1250),
        envelope=True,
    )


@query
def payload_sizes(spark, d):
    """Hashed buckets: no payload above its size, no row lost."""
    bodies = payloads.payloads(_order_rows(spark, d), ["o_orderkey"], 100, service="orders")
    return bodies.groupBy("service").agg(
        F.sum("row_count").alias("row_count"),
        F.max(F.col("row_count") > 100).alias("too_large"),
        F.sum(F.size(F.from_json("payload", "array<struct<o_orderkey:bigint>>"))).alias("json_rows"),
    )


@query
def payload_tables(spark, d):
    """Landed tables pushed to a service each, and the cost table."""
    landed = {
        "ea_pap_timers": view(spark, d, "timer_events"),
        "ea_wodetail": _lookup(spark, d, "wodetail"),
    }
    keys = {
        "ea_pap_timers": landed["ea_pap_timers"].columns,
        "ea_wodetail": ["plant", "optel_schedule_wo"],
    }
    cost = tables.material_cost(view(spark, d, "material_cost_raw"))
    bodies = payloads.table_payloads(landed, keys, 500).unionByName(
        payloads.payloads(cost, ["material", "plant"], 500, service=payloads.COST_SERVICE)
    )
    return bodies.groupBy("service").agg(F.sum("row_count").alias("row_count"))


@query
def payload_cost(spark, d):
    """The cost table, read from the text of its request bodies."""
    cost = tables.material_cost(view(spark, d, "material_cost_raw"))
    bodies = payloads.payloads(
        cost, ["material", "plant"], 100, service=payloads.COST_SERVICE, envelope=True
    )
    rows = F.from_json(
        F.get_json_object("payload", "$.inputJson"),
        "array<struct<material: string, plant: string, unit_cost: double>>",
    )
    return bodies.select("service", F.explode(rows).alias("r")).select("service", "r.*")


@query
def payload_nozzle_v1(spark, d):
    """All events, also equal ones; the times in the payloads' text are read back."""
    rows = nozzle_v1(spark, d)
    bodies = payloads.payloads(rows, rows.columns, 1000)
    each = F.explode(F.from_json("payload", "array<struct<date_time:timestamp,ch_hole:string>>"))
    read = bodies.select(F.col("row_count"), each.alias("e"))
    return read.groupBy(F.col("e.ch_hole").alias("ch_hole")).agg(
        F.count("*").alias("row_count"), F.max("e.date_time").alias("last_time")
    )


@query
def partitioned_append(spark, d):
    path = fresh_path(spark, "kpi-store")
    rows = kpi.fpy(view(spark, d, "header"), DAY).withColumnRenamed("machineId_side", "machineid_side")
    files.append_partitioned(kpi.stored(rows, "fpy"), path)
    stored = spark.read.schema(KPI_SCHEMA).parquet(path)
    return stored.groupBy("machine_id", "pcb_side").agg(
        F.count("*").alias("row_count"),
        F.round(F.max("result"), 6).alias("result"),
        F.min("machineid_side").alias("machineid_side"),
    )


@query
def catalog_append(spark, d):
    """Rows appended by name to a catalog table; each run finds its own by the batch name."""
    path = fresh_path(spark, "catalog")
    tables.create_tables(spark, "q_", path)
    name = path.rsplit("/", 1)[-1]
    messages = spread(table(spark, d, "orders"), MESSAGES).select(_spi_message().alias("value"))
    parsed = envelope.records(envelope.parse(messages, "xml_in", name))
    rows = landing.land(routing.with_tag(parsed, "spiTest-header"), "ea_spi_header")
    files.append_table(rows.select(*reversed(rows.columns)), "q_elec_assy.ea_spi_header")
    stored = tables.catalog_table(spark, "ea_spi_header", "q_")
    return stored.filter(F.col("hdfs_file_name") == name).select(
        "generated_key", "machine_id", "pcb_result", "inspection_end_dttm"
    )


@query
def table_append(spark, d):
    """A landed table in parquet, appended twice by name and read with its schema."""
    path = fresh_path(spark, "tables")
    rows = landing.land(
        routing.with_tag(envelope.records(_spi_records(spark, d)), "spiTest-detail"), "ea_spi_detail"
    )
    for batch_id in (0, 1, 1):
        files.append_parquet(rows, f"{path}/ea_spi_detail", batch_id)
    stored = tables.parquet_table(spark, path, "ea_spi_detail")
    return stored.groupBy("module_nbr", "ref_designator").agg(F.count("*").alias("row_count"))


@query
def archive_roundtrip(spark, d):
    path = fresh_path(spark, "archive")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("value"))
    files.archive(rows, path, files.batch_name("line", 0))
    return spark.read.text(f"{path}/*").select(F.col("value").alias("c_name"))


# --- reports ----------------------------------------------------------------------------

_COUNTED = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@query
def row_count_report(spark, d):
    return report.row_counts({name: table(spark, d, name) for name in _COUNTED})


@query
def freshness_report(spark, d):
    loaded = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    frames = {name: table(spark, d, name) for name in loaded}
    out = report.freshness(frames, loaded)
    return out.withColumn("last_updated", F.col("last_updated").cast("timestamp"))


@query
def file_freshness_report(spark, d):
    names = ("orders", "lineitem")
    out = report.file_freshness({name: table(spark, d, name) for name in names})
    return out.select("table_name", F.col("last_updated").isNotNull().alias("known"))


@query
def newest_event(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return report.newest(rows, "ts", 10)


@query
def offset_progress(spark, d):
    offsets = table(spark, d, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return report.topic_progress(offsets)


# --- streams ----------------------------------------------------------------------------


ORDER_CUTS = ("1997-01-01", "1999-01-01")
EVENT_CUTS = ("2024-01-10", "2024-01-20")


def _spans(time: str, cuts: tuple[str, str]) -> list[Column]:
    """Conditions that cut a table into three spans of time, in order."""
    first, second = (F.lit(cut).cast("timestamp") for cut in cuts)
    at = F.col(time).cast("timestamp")
    return [at < first, (at >= first) & (at < second), (at >= second) | at.isNull()]


def _arrivals(spark, root: str, sources: dict[str, tuple[DataFrame, str]], cuts, run) -> None:
    """Let tables arrive span by span in folders that file streams read.

    `run` gets the streams, starts a query on them and gives it back; it works through
    what has arrived, stops, and goes on from its checkpoint after the next span.
    """
    streams = {
        name: spark.readStream.schema(df.schema).parquet(f"{root}/in/{name}/*")
        for name, (df, _) in sources.items()
    }
    for number in range(len(cuts) + 1):
        for name, (df, time) in sources.items():
            df.filter(_spans(time, cuts)[number]).write.parquet(f"{root}/in/{name}/{number}")
        run(streams).awaitTermination()


@query
def stream_latest(spark, d):
    """Latest version per key, merged batch by batch."""
    rows = _event_versions(spark, d)
    root = fresh_path(spark, "latest")
    store = LookupStore(f"{root}/store", ["user_id", "event_type"], rows.schema, compact_every=2)
    _arrivals(
        spark, root, {"versions": (rows, "version")}, EVENT_CUTS,
        lambda streams: start(streams["versions"], store.merge, f"{root}/checkpoint"),
    )
    return store.current(spark)


@query
def stream_kpi(spark, d):
    """Mean volume from two streams joined on the board key."""
    root = fresh_path(spark, "volume")
    _board_volumes(spark, d, root)
    boards = spark.read.parquet(f"{root}/boards")
    return _round(kpi.unit_means(boards), "volume_result")


def _board_volumes(spark, d, root: str, **options) -> None:
    """Headers and pads as they are sent, each with its own load time; a pad may come years off."""
    pads = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("generated_key"),
        F.col("l_quantity").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("loaded_at"),
    )
    _arrivals(
        spark,
        root,
        {"headers": (view(spark, d, "header"), "inspection_end"), "pads": (pads, "loaded_at")},
        ORDER_CUTS,
        lambda streams: kpi_stream.board_volume_stream(
            streams["headers"],
            streams["pads"],
            f"{root}/boards",
            f"{root}/checkpoint",
            span="3000 days",
            pad_time="loaded_at",
            **options,
        ),
    )


@query
def stream_kpi_limits(spark, d):
    """Records of all indicators from streams to a topic, to the KPI store, to limits."""
    root = fresh_path(spark, "limits")
    _board_volumes(spark, d, f"{root}/volume", topic="kpi", as_of=DAY)
    _arrivals(
        spark,
        f"{root}/ratios",
        {"headers": (view(spark, d, "header"), "inspection_end")},
        ORDER_CUTS,
        lambda streams: kpi_stream.ratio_stream(
            streams["headers"], f"{root}/ratios/topics", f"{root}/ratios/checkpoint", "kpi", DAY
        ),
    )
    for name, path in (("volume", "volume/boards_topics"), ("ratios", "ratios/topics")):
        messages = spark.readStream.schema("value string").parquet(f"{root}/{path}/*/*/topic=kpi")
        kpi_stream.store_stream(
            messages, f"{root}/store", f"{root}/checkpoint-{name}"
        ).awaitTermination()
    stores = {
        name: spark.read.schema(KPI_SCHEMA).parquet(f"{root}/store/{kept}")
        for name, kept in KPI_TABLES.items()
    }
    out = limits.control_limits(stores, kpi.machines(view(spark, d, "header")), DAY)
    return _round(out, *_LIMITS)


@query
def stream_ingest(spark, d):
    """XML messages through the whole ingest: landed, forwarded and quarantined rows."""
    orders = spread(table(spark, d, "orders"), MESSAGES)
    messages = orders.select(
        "o_orderdate",
        F.when(F.col("o_orderkey") % 10 == 0, _odd_message()).otherwise(_spi_message()).alias("value"),
    )
    root = fresh_path(spark, "ingest")
    _arrivals(
        spark,
        root,
        {"messages": (messages, "o_orderdate")},
        ORDER_CUTS,
        lambda streams: ingest(
            streams["messages"], f"{root}/out", f"{root}/checkpoint", "xml_in", "line"
        ),
    )
    out = f"{root}/out"
    counted = {
        name: spark.read.schema(SPECS[name].schema).parquet(f"{out}/tables/{name}")
        for name in ("ea_spi_header", "ea_spi_detail", "ea_units")
    }
    counted["quarantine"] = spark.read.parquet(f"{out}/quarantine")
    counted["records"] = spark.read.parquet(f"{out}/topics").filter("topic = 'records'")
    return report.row_counts(counted)


#: Message texts of the columns of each type; strings hold the order number.
MESSAGE_TEXTS = {
    "int": "17",
    "bigint": "5000000000",
    "boolean": "true",
    "decimal(5,2)": "12.50",
    "decimal(10,5)": "7.25",
}
MESSAGE_TIME = "2024-01-05 06:07:08"


def _full_message() -> Column:
    """A message with a block for each raw table, which fills all its columns."""
    key = F.col("o_orderkey").cast("string")
    parts = [F.lit('<ArrayOfLiveTextData filename="f">')]
    for spec in SPECS.values():
        route = spec.route if spec.route.startswith("-") else f"-{spec.route}"
        names = ",".join(spec.source.get(c, c) for c in spec.columns)
        kinds = ",".join("String" for _ in spec.columns)
        parts.append(
            F.lit(
                f"<LiveTextData><TagName>c1-smt-m{route}</TagName><Status>Good</Status><TagId>1</TagId>"
                f'<TimeStamp>t</TimeStamp><TagValue fieldnames="{names}" fieldtypes="{kinds}" '
                'separator=",">'
            )
        )
        moment = F.date_format(F.lit(MESSAGE_TIME).cast("timestamp"), spec.time_format)
        values = [
            key
            if spec.kind(c) == "string"
            else moment if spec.kind(c) == "timestamp" else F.lit(MESSAGE_TEXTS[spec.kind(c)])
            for c in spec.columns
        ]
        parts += [F.concat_ws(",", *values), F.lit("</TagValue></LiveTextData>")]
    return F.concat(*parts, F.lit("</ArrayOfLiveTextData>"))


def _full_ingest(spark, d, **options) -> str:
    root = fresh_path(spark, "full")
    orders = spread(table(spark, d, "orders"), MESSAGES)
    orders.select(_full_message().alias("value")).write.option("compression", "zstd").parquet(f"{root}/in")
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in")
    ingest(
        inlet, f"{root}/out", f"{root}/checkpoint", "xml_in", "line", **options
    ).awaitTermination()
    return f"{root}/out"


@query
def xml_landed_all(spark, d):
    """Landed rows of all raw tables, their columns as one text."""
    out, union = _full_ingest(spark, d), None
    for name, spec in SPECS.items():
        rows = spark.read.schema(spec.schema).parquet(f"{out}/tables/{name}")
        texts = rows.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in spec.columns]).alias("row_text"),
        )
        union = texts if union is None else union.unionByName(texts)
    return union


@query
def stream_push(spark, d):
    """Landed rows of the nine tables with a service, read from the text of their request bodies."""
    bodies = spark.read.parquet(f"{_full_ingest(spark, d, push=50)}/payloads")
    each = F.explode(F.from_json(F.get_json_object("payload", "$.inputJson"), "array<map<string,string>>"))
    rows = bodies.select("service", (F.col("row_count") <= 50).alias("bounded"), each.alias("m"))
    union = None
    for name, service in payloads.SERVICES.items():
        columns = F.concat_ws("|", *[F.col("m").getItem(c) for c in SPECS[name].columns])
        part = rows.filter(F.col("service") == service).select(
            "service", "bounded", columns.alias("row_text")
        )
        union = part if union is None else union.unionByName(part)
    return union


@query
def stream_enriched(spark, d):
    """Master data and then timer events in one stream of records."""
    timers = spread(view(spark, d, "timer_events"))
    equipment = _lookup(spark, d, "equipment")
    orders = _lookup(spark, d, "wodetail")

    def message(tag: str | Column, **fields: str) -> Column:
        first = F.lit(tag) if isinstance(tag, str) else tag
        named = [F.col(c).alias(n) for n, c in fields.items()]
        return F.to_json(F.struct(first.alias("xml_tag_name"), *named)).alias("value")

    parts = (
        equipment.select(
            message(
                "c1-smt-sng-machine",
                MachineName="machine_name",
                EquipmentMake="equipment_make",
                Head1="head_1",
                PLANT="plant",
            )
        ),
        orders.select(
            message(
                "c1-smt-sng-wodetail",
                OptelScheduleWO="optel_schedule_wo",
                SAPWO="sap_wo",
                Side="side",
                Assembly="assembly",
                PLANT="plant",
                Setup="setup",
            )
        ),
        timers.select(
            message(
                F.col("xml_tag_name"),
                Product_ID="product_id",
                User_Name="user_name",
                ulIdleTime="ul_idle_time",
                ulProductionTime="ul_production_time",
            )
        ),
    )
    root = fresh_path(spark, "enriched")
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in/*")
    for number, part in enumerate(parts):
        part.write.parquet(f"{root}/in/{number}")
        event_stream.enrich_stream(
            records.json_records(inlet),
            f"{root}/out",
            f"{root}/checkpoint",
            event_stream.lookup_stores(f"{root}/lookups"),
        ).awaitTermination()
    out = spark.read.parquet(f"{root}/out/wide")
    return out.select(
        "table_name", "machine_name", "product_id", "plant", "sap_wo", "side", "assembly",
        "setup", "timer_idle_time", "timer_production_time",
    )




def _record_messages(df: DataFrame, tag: str | Column) -> DataFrame:
    """Rows as JSON records."""
    kinds = dict(df.dtypes)
    fields = [
        F.date_format(c, times.ISO).alias(c) if kinds[c].startswith("timestamp") else F.col(c)
        for c in df.columns
        if c != "xml_tag_name"
    ]
    first = F.lit(tag) if isinstance(tag, str) else tag
    return df.select(F.to_json(F.struct(first.alias("xml_tag_name"), *fields)).alias("value"))


def _wide_stream(spark, d) -> str:
    """All master data by one inlet, then all four event types by another one; the folder."""
    root = fresh_path(spark, "wide")
    derived = ("version", "wo_detail", "head_spindle", "ref_des", "Pcircuit")
    for name, spec in lookups.LOOKUPS.items():
        rows = _record_messages(_lookup(spark, d, name).drop(*derived), f"c1-smt-m{ROUTES[spec.table]}")
        rows.write.parquet(f"{root}/master/{name}")
    for kind in ("nozzle", "timer", "defect", "slot"):
        events = spread(view(spark, d, f"{kind}_events"))
        if kind == "timer":  # some come without a time
            late = F.length("product_id") % 3 == 0
            events = events.withColumn("date_time", F.when(~late, F.col("date_time")))
        _record_messages(events, F.col("xml_tag_name")).write.parquet(f"{root}/events/{kind}")
    stores = event_stream.lookup_stores(f"{root}/lookups")
    for inlet in ("master", "events"):
        messages = spark.readStream.schema("value string").parquet(f"{root}/{inlet}/*")
        event_stream.enrich_stream(
            records.json_records(messages),
            f"{root}/out",
            f"{root}/checkpoint-{inlet}",
            stores,
            cost=lambda s: tables.material_cost(view(s, d, "material_cost_raw")),
            as_of=DAY,
            topic="wide",
            service="wide_service",
            size=100,
        ).awaitTermination()
    return f"{root}/out"


_WIDE_SCHEMA = ", ".join(f"{c} {kind}" for c, kind in wide.WIDE_KINDS.items())


@query
def stream_wide(spark, d):
    """The wide events of a stream, read from the messages of their topic."""
    messages = spark.read.schema("value string").parquet(f"{_wide_stream(spark, d)}/topics")
    return records.typed_json(messages, _WIDE_SCHEMA)


@query
def stream_payloads(spark, d):
    """The same events, read from the text of their request bodies."""
    bodies = spark.read.parquet(f"{_wide_stream(spark, d)}/payloads")
    fields = ", ".join(f"{c}: {kind}" for c, kind in wide.WIDE_KINDS.items())
    each = F.explode(F.from_json("payload", f"array<struct<{fields}>>"))
    most = bodies.groupBy("service").agg((F.max("row_count") <= 100).alias("bounded"))
    # an answer for each service, which its bodies look up where they lie
    answers = most.select(F.map_from_entries(F.collect_list(F.struct("service", "bounded")))).scalar()
    return bodies.select("service", F.element_at(answers, F.col("service")).alias("bounded"), each.alias("e")).select(
        "service", "bounded", "e.*"
    )


def _timer_messages(spark, d) -> DataFrame:
    """Timer records as JSON; the idle time of every seventh is no number, every ninth has no route."""
    timers = spread(view(spark, d, "timer_events")).withColumn("n", F.length("product_id") + F.col("ul_idle_time"))
    idle = F.when(F.col("n") % 7 == 0, "n/a").otherwise(F.col("ul_idle_time").cast("bigint").cast("string"))
    tag = F.when(F.col("n") % 9 == 0, "c1-smt-other").otherwise(F.col("xml_tag_name"))
    fields = F.struct(
        tag.alias("xml_tag_name"),
        F.col("product_id").alias("Product_ID"),
        F.col("user_name").alias("User_Name"),
        idle.alias("ulIdleTime"),
    )
    return timers.select(F.to_json(fields).alias("value"))


def _landed_timers(spark, path: str) -> DataFrame:
    rows = spark.read.schema(SPECS["ea_pap_timers"].schema).parquet(f"{path}/tables/ea_pap_timers")
    return rows.select("product_id", "user_name", F.col("ul_idle_time").cast("bigint"))


@query
def stream_two_inlets(spark, d):
    """Two topics that land in one set of tables: the rows of both are there."""
    root = fresh_path(spark, "inlets")
    made = _timer_messages(spark, d)
    for name, own in (("a", F.length("value") % 2 == 0), ("b", F.length("value") % 2 == 1)):
        made.filter(own).write.parquet(f"{root}/in/{name}")
        inlet = spark.readStream.schema("value string").parquet(f"{root}/in/{name}")
        land_json(inlet, f"{root}/out", f"{root}/checkpoint-{name}").awaitTermination()
    return _landed_timers(spark, f"{root}/out")


@query
def stream_reset(spark, d):
    """A second query with a fresh checkpoint: earlier rows stay and all rows come once more."""
    root = fresh_path(spark, "reset")
    _timer_messages(spark, d).write.parquet(f"{root}/in")
    for checkpoint in ("first", "second", "second"):
        inlet = spark.readStream.schema("value string").parquet(f"{root}/in")
        land_json(inlet, f"{root}/out", f"{root}/{checkpoint}").awaitTermination()
    return _landed_timers(spark, f"{root}/out")


@query
def stream_quarantine(spark, d):
    """Landed and quarantined records of a stream are together all that came in."""
    root = fresh_path(spark, "quarantine")
    _timer_messages(spark, d).write.parquet(f"{root}/in")
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in")
    land_json(inlet, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    lost = spark.read.parquet(f"{root}/out/quarantine")
    fields = F.from_json("raw", "Product_ID string, User_Name string, ulIdleTime string")
    return lost.select(
        "reason", F.array_join("bad_columns", ",").alias("bad_columns"), fields.alias("f")
    ).select(
        "reason",
        "bad_columns",
        F.col("f.Product_ID").alias("product_id"),
        F.col("f.User_Name").alias("user_name"),
        F.col("f.ulIdleTime").alias("idle_text"),
    )


@query
def stream_latest_after_reset(spark, d):
    """The store keeps its rows, and newer ones win, when a query starts with a fresh checkpoint."""
    rows = _event_versions(spark, d)
    root = fresh_path(spark, "latest")
    store = LookupStore(f"{root}/store", ["user_id", "event_type"], rows.schema, compact_every=2)
    for number, part in enumerate(_spans("version", EVENT_CUTS)):
        rows.filter(part).write.parquet(f"{root}/in/{number}")
        inlet = spark.readStream.schema(rows.schema).parquet(f"{root}/in/{number}")
        start(inlet, store.merge, f"{root}/checkpoint-{number}").awaitTermination()
    return store.current(spark)
