"""Registered queries of panes, bucketed tables, SQL functions, inferred records and live streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import sql, times
from linepulse.operators import enrich, kpi, lookups, panes, report, skew
from linepulse.plans.catalog import (
    _COUNTED,
    DAY,
    EVENT_CUTS,
    ORDER_CUTS,
    _arrivals,
    _event_versions,
    _lookup,
    _lookups,
    _record_messages,
    _round,
    _spans,
    _spi_records,
    _timer_messages,
    _WIDE_SCHEMA,
    nozzle_v1,
    query,
)
from linepulse.plans.views import table, view
from linepulse.registry import ROUTES
from linepulse.session import delete_folder, fresh_path, materialize, spread
from linepulse.sinks import payloads
from linepulse.sinks.files import append_parquet
from linepulse.sources import envelope, inferred, records, tables
from linepulse.streaming import events as event_stream
from linepulse.streaming import kpi as kpi_stream
from linepulse.streaming import progress
from linepulse.streaming.bucket_store import BucketStore
from linepulse.streaming.ingest import landed, lost_records, sink_records, sunk
from linepulse.streaming.runner import start

UNIT = ["kpi", "machine_id", "pcb_side"]


@query
def xmr_sliding(spark, d):
    """Limits of the trailing day at the end of every quarter of an hour, all indicators in one pass."""
    out = panes.sliding_limits(view(spark, d, "kpi_records"), UNIT)
    # means of few points often lie half-way between two rounded values
    return _round(out.withColumns({c: F.col(c) + 1e-9 for c in ("ucl", "lcl", "mean")}), "ucl", "lcl", "mean")


@query
def stream_latest_buckets(spark, d):
    """Latest version per key, merged batch by batch into buckets; read by the keys of the last batch too."""
    rows = _event_versions(spark, d)
    root = fresh_path(spark, "buckets")
    store = BucketStore(f"{root}/store", ["user_id", "event_type"], rows.schema, buckets=32)
    _arrivals(
        spark, root, {"versions": (rows, "version")}, EVENT_CUTS,
        lambda streams: start(streams["versions"], store.merge, f"{root}/checkpoint"),
    )
    last = spark.read.schema(rows.schema).parquet(f"{root}/in/versions/{len(EVENT_CUTS)}")
    keys = last.select(*store.keys).distinct()
    whole = store.current(spark).withColumn("reader", F.lit("all"))
    own = store.current(spark, keys=keys).join(keys, store.keys, "left_semi")
    return whole.unionByName(own.withColumn("reader", F.lit("last batch")))


@query
def volume_bucketed(spark, d):
    """Headers and pads in buckets of the board key: their join and the sums below it don't shuffle."""
    root, run = fresh_path(spark, "bucketed"), uuid.uuid4().hex
    header, detail = (
        tables.bucketed_table(spark, view(spark, d, name), f"{name}_{run}", "generated_key", 8, f"{root}/{name}")
        for name in ("header", "detail")
    )
    return _round(kpi.volume(detail, header.hint("merge")), "volume_result")


@query
def sql_functions(spark, d):
    """All scalar functions and a table function in plain SQL."""
    sql.register(spark)
    names = ("nozzle_events", "defect_events", "progorderlist_raw", "words", "wodetail_raw", "header", "orders")
    found = {n: table(spark, d, n) if n == "orders" else view(spark, d, n) for n in names}
    found["wodetail_raw"].createOrReplaceTempView("line_wodetail")
    sql.register_tables(spark, wodetail="line_wodetail")
    return spark.sql(
        """
        SELECT 'location' AS part, changer_hole(location) AS a, changer_hole(location, 0) AS b,
               machine_changer_hole(user_name, location) AS c, slot_track(location) AS d,
               slot_label(tooltype, location) AS e, tag_location(xml_tag_name) AS f,
               product_prefix(product_id) AS g, count(*) AS row_count
        FROM {nozzle_events} GROUP BY ALL
        UNION ALL
        SELECT 'centre', workcentre_side(placing_wc_code), workcentre_machine(placing_wc_code),
               unit_url('u', placing_plant_code, assem_serial_no), NULL, NULL, NULL, NULL, count(*)
        FROM {defect_events} GROUP BY ALL
        UNION ALL
        SELECT 'reference', panel_circuit(circuit, ref_id), ref_designator(circuit, ref_id),
               machine_side(head, spindle), strip_leading_zeros(concat('00', work_order)), NULL, NULL, NULL,
               count(*)
        FROM {progorderlist_raw} GROUP BY ALL
        UNION ALL
        SELECT 'words', word, CAST(converts(txt, word) AS STRING), CAST(CAST(sum(as_number(txt)) AS DECIMAL(18, 2)) AS STRING),
               NULL, NULL, NULL, NULL, count(*)
        FROM {words} GROUP BY word, converts(txt, word)
        UNION ALL
        SELECT 'times', CAST(interval_id(inspection_time(written)) AS STRING),
               CAST(interval_id(parse_time(iso), 60) AS STRING),
               CAST(trailing(parse_time(iso), TIMESTAMP '1998-01-01 00:00:00', 720) AS STRING),
               NULL, NULL, NULL, NULL, count(*)
        FROM (SELECT date_format(inspection_end, {clock}) AS written, date_format(inspection_end, {iso}) AS iso
              FROM {header}) GROUP BY ALL
        UNION ALL
        SELECT 'orders', work_order_url('r', sap_wo, 'NATION_3'), side, assembly, version, NULL, NULL, NULL, 1L
        FROM work_orders_of('NATION_3')
        """,
        clock=times.SPI_12H,
        iso=times.ISO,
        **{n: df for n, df in found.items() if n not in ("wodetail_raw", "orders")},
    )


def _loose_messages(spark, d) -> DataFrame:
    """Machine records with fields that the registry does not know, nested ones and ones of mixed type."""
    idle = F.col("ul_idle_time").cast("bigint")
    timers = spread(view(spark, d, "timer_events")).select(
        F.struct(
            "xml_tag_name",
            F.col("product_id").alias("Product_ID"),
            idle.alias("ulIdleTime"),
            F.struct(F.col("user_name").alias("line"), (idle > 50).alias("late")).alias("operator"),
            F.array(idle, idle + 1).alias("samples"),
        ).alias("r")
    )
    slots = spread(view(spark, d, "slot_events")).select(
        F.struct(
            "xml_tag_name",
            F.col("component_name").alias("Component_Name"),
            F.col("slot_number").cast("bigint").alias("SlotNumber"),
            F.when(F.col("slot_number") == 7, F.col("slot_number").cast("double") + 0.5).alias("angle"),
        ).alias("r")
    )
    mixed = spread(view(spark, d, "nozzle_events")).select(
        F.concat(
            F.lit('{"xml_tag_name":"'), F.col("xml_tag_name"), F.lit('","ulPicks":'),
            F.when(F.col("ul_picks") % 2 == 0, F.col("ul_picks").cast("string")).otherwise('"none"'),
            F.lit("}"),
        ).alias("value")
    )
    broken = spread(table(spark, d, "orders")).select(F.concat(F.lit('{"xml_tag_name":'), F.col("o_orderkey").cast("string")).alias("value"))
    made = [df.select(F.to_json("r").alias("value")) for df in (timers, slots)]
    return made[0].unionByName(made[1]).unionByName(mixed).unionByName(broken)


@query
def json_inferred(spark, d):
    """Fields, types and counts of each record type, from all records."""
    return inferred.fields(inferred.variants(_loose_messages(spark, d)))


@query
def json_typed_paths(spark, d):
    """Nested values read with types from the same variants."""
    return inferred.typed(
        inferred.variants(_loose_messages(spark, d)),
        "ea_pap_timers",
        {
            "product_id": ("$.Product_ID", "string"),
            "line": ("$.operator.line", "string"),
            "late": ("$.operator.late", "boolean"),
            "second_sample": ("$.samples[1]", "bigint"),
            "third_sample": ("$.samples[2]", "bigint"),
            "line_number": ("$.operator.line", "bigint"),
        },
    )


@query
def stream_file_sink(spark, d):
    """Records through the engine's file sink: stopped, gone on, and with a batch run again."""
    root = fresh_path(spark, "sink")
    made = _timer_messages(spark, d)
    out, checkpoint = f"{root}/records", f"{root}/checkpoint"
    for number in range(3):
        made.filter(F.pmod(F.length("value"), F.lit(3)) == number).write.parquet(f"{root}/in/{number}")
        inlet = spark.readStream.schema("value string").parquet(f"{root}/in/*")
        sink_records(inlet, out, checkpoint).awaitTermination()
    # the last batch was written but its end not noted, so it is run again
    delete_folder(spark, f"{checkpoint}/commits/2")
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in/*")
    sink_records(inlet, out, checkpoint).awaitTermination()
    rows = landed(spark, out, "ea_pap_timers")
    return rows.select("product_id", "user_name", F.col("ul_idle_time").cast("bigint"))


def _held_back(spark, d) -> tuple[DataFrame, Column]:
    """Inspections from the events, and which of them come only after all others."""
    rows = view(spark, d, "kpi_points").select(
        "machine_id",
        "pcb_side",
        F.col("max_inspection_end_time").alias("inspection_end"),
        F.when(F.col("result") < 0.02, "GOOD").when(F.col("result") < 0.06, "PASS").otherwise("FAIL").alias("pcb_result"),
        F.col("generated_key").cast("bigint").alias("n"),
    )
    held = (F.col("n") % 50 == 0) & (F.col("inspection_end") < F.lit(EVENT_CUTS[1]).cast("timestamp"))
    return rows, held


def _interval_stream(spark, d):
    """Folder, queries and checkpoint of interval yields over three spans of events and late ones."""
    root = fresh_path(spark, "intervals")
    rows, held = _held_back(spark, d)
    kept = rows.drop("n")
    parts = [rows.filter(~held & span).drop("n") for span in _spans("inspection_end", EVENT_CUTS)]
    parts.append(rows.filter(held).drop("n"))
    queries = []
    for number, part in enumerate(parts):
        part.write.parquet(f"{root}/in/{number}")
        inlet = spark.readStream.schema(kept.schema).parquet(f"{root}/in/*")
        counted = progress.counted(inlet.filter(F.col("pcb_result").isin(*kpi.COUNTED)))
        run = kpi_stream.interval_yield_stream(counted, f"{root}/out", f"{root}/checkpoint")
        run.awaitTermination()
        queries.append(run)
    return root, queries


@query
def stream_interval_yield(spark, d):
    """Yields of event-time intervals, each given out once it is past; late inspections don't count."""
    root, _ = _interval_stream(spark, d)
    out = spark.read.parquet(f"{root}/out").drop("run", "batch")
    return _round(out, "fpy_result", "ffr_result")


@query
def stream_loss(spark, d):
    """Every inspection that came in was given out, waits in state or came too late."""
    root, queries = _interval_stream(spark, d)
    given = spark.read.parquet(f"{root}/out").agg(F.sum("boards")).first()[0]
    kept = progress.waiting(spark, f"{root}/checkpoint")
    came = sum(progress.rows_in(q) for q in queries)
    late = came - given - kept
    rows = [("in", came), ("given", given), ("waiting", kept), ("late", late)]
    rows.append(("late groups seen", int(sum(progress.dropped_groups(q) for q in queries) > 0)))
    return spark.createDataFrame(rows, "kind string, row_count bigint")


@query
def stream_progress(spark, d):
    """Rows read from each of two sources of one query, from its own progress."""
    root = fresh_path(spark, "progress")
    made = _timer_messages(spark, d)
    streams = None
    even = F.length(F.get_json_object("value", "$.Product_ID")) % 2 == 0
    for name, own in (("a", even), ("b", ~even)):
        made.filter(own).write.parquet(f"{root}/{name}")
        inlet = spark.readStream.schema("value string").parquet(f"{root}/{name}")
        streams = inlet if streams is None else streams.unionByName(inlet)
    run = sink_records(streams, f"{root}/out", f"{root}/checkpoint")
    run.awaitTermination()
    rows = progress.source_rows(spark, "records", run)
    name = F.regexp_extract("source", r"/([ab])\]$", 1).alias("source")
    return rows.groupBy("query", name).agg(
        F.sum("rows_in").alias("rows_in"), F.max("end_offset").alias("end_offset")
    )


@query
def stream_union(spark, d):
    """Master data and events by one query over both inlets; both stay live."""
    root = fresh_path(spark, "union")
    derived = ("version", "wo_detail", "head_spindle", "ref_des", "Pcircuit")
    steps = (("nozzle",), ("timer", "defect"), ("slot",))
    stores = event_stream.lookup_stores(f"{root}/lookups", buckets=16)
    for number, kinds in enumerate(steps):
        for name, spec in lookups.LOOKUPS.items():
            # all of it comes first, and once more with every later batch of events
            rows = _record_messages(_lookup(spark, d, name).drop(*derived), f"c1-smt-m{ROUTES[spec.table]}")
            if number == 0 or name == "equipment":
                rows.write.parquet(f"{root}/master/{number}-{name}")
        for kind in kinds:
            rows = spread(view(spark, d, f"{kind}_events"))
            if kind == "timer":  # some come without a time
                rows = rows.withColumn("date_time", F.when(F.length("product_id") % 3 != 0, F.col("date_time")))
            _record_messages(rows, F.col("xml_tag_name")).write.parquet(f"{root}/events/{number}-{kind}")
        master, live = (
            spark.readStream.schema("value string").parquet(f"{root}/{inlet}/*") for inlet in ("master", "events")
        )
        event_stream.enrich_stream(
            records.json_records(master.unionByName(live)),
            f"{root}/out",
            f"{root}/checkpoint",
            stores,
            cost=lambda s: tables.material_cost(view(s, d, "material_cost_raw")),
            as_of=DAY,
            topic="wide",
        ).awaitTermination()
    messages = spark.read.schema("value string").parquet(f"{root}/out/topics")
    return records.typed_json(messages, _WIDE_SCHEMA)


@query
def stream_cost_refresh(spark, d):
    """The cost table doubles after the second batch; a refresh every second batch sees it in the third.

    The lookups are chosen and written once, and every batch reads the same rows.
    """
    root = fresh_path(spark, "cost")
    now = {name: materialize(df, name) for name, df in _lookups(spark, d, "equipment", "comptype", "wodetail").items()}
    prices = tables.material_cost(view(spark, d, "material_cost_raw"))
    cost = event_stream.Refreshed(lambda s: s.read.schema(prices.schema).parquet(f"{root}/cost"), batches=2)

    def each(batch: DataFrame, batch_id: int) -> None:
        made = enrich.slot(batch, now["equipment"], now["comptype"], now["wodetail"], cost(batch.sparkSession))
        append_parquet(made.withColumn("n", F.lit(int(batch_id))), f"{root}/out", batch_id)

    prices.write.parquet(f"{root}/cost")
    rows, done = view(spark, d, "slot_events"), []

    def run(streams):
        if len(done) == 2:
            prices.withColumn("unit_cost", F.col("unit_cost") * 2).write.mode("overwrite").parquet(f"{root}/cost")
        done.append(True)
        return start(streams["slots"], each, f"{root}/checkpoint")

    _arrivals(spark, root, {"slots": (rows, "date_time")}, ORDER_CUTS, run)
    out = spark.read.parquet(f"{root}/out").drop("run", "batch")
    return out.select("n", "product_id", "component_name", "plant", "machine_name", "slot", F.round("unit_cost", 4).alias("unit_cost"))


@query
def timers_salted(spark, d):
    """Timer events, those of hot machines spread over salts."""
    rows = view(spark, d, "timer_events")
    now = _lookups(spark, d, "equipment", "wodetail")
    hot = skew.salting(rows, "user_name", share=0.01)
    return enrich.timers(rows, now["equipment"], now["wodetail"], salting=hot)


@query
def row_count_footers(spark, d):
    """Rows of all tables, from the footers of their files."""
    names = {name: tables.footer_table(spark, f"{str(d).rstrip('/')}/{name}.parquet") for name in _COUNTED}
    return report.row_counts(names)


@query
def record_ids(spark, d):
    """Ids of parsed records, computed and as their JSON carries them; the same when read again."""
    good = envelope.records(_spi_records(spark, d))
    carried = F.get_json_object(envelope.record_json(with_uuid=True), "$.uuid")
    return good.select(
        "xml_tag_name",
        F.get("field_values", F.lit(0)).alias("generated_key"),
        F.get("field_values", F.lit(1)).alias("second_value"),
        envelope.record_id().alias("record_id"),
        carried.alias("carried_id"),
    )


@query
def slot_enriched_xref(spark, d):
    """Slot events whose tag names the plant of their machine."""
    now = _lookups(spark, d, "equipment", "comptype", "wodetail")
    cost = tables.material_cost(view(spark, d, "material_cost_raw"))
    rows = view(spark, d, "slot_events")
    return enrich.slot(
        rows, now["equipment"], now["comptype"], now["wodetail"], cost, tables.xref(view(spark, d, "xref_raw"))
    )


@query
def stream_rate_limit(spark, d):
    """Files of a stream taken two at a time: rows of each batch."""
    root = fresh_path(spark, "rate")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("value"), F.col("c_custkey").alias("n"))
    for number in range(5):
        rows.filter(F.col("n") % 5 == number).select("value").coalesce(1).write.text(f"{root}/in/{number}")
    stream = records.file_values(spark, f"{root}/in/*", max_files=2, whole=False)

    def each(batch: DataFrame, batch_id: int) -> None:
        append_parquet(batch.withColumn("n", F.lit(int(batch_id))), f"{root}/out", batch_id)

    start(stream, each, f"{root}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("n").agg(F.count("*").alias("row_count"), F.min("value").alias("first_name"))


@query
def payload_equal_rows(spark, d):
    """Rows that are all alike, as request bodies: none lost, no bucket with much more than its share."""
    rows = table(spark, d, "lineitem").select(F.lit("same").alias("a"), F.lit(1).alias("b"))
    bodies = payloads.text_payloads(rows, 10, F.to_json(F.struct("a", "b")), "equal", buckets=16)
    sizes = bodies.groupBy("bucket").agg(F.sum("row_count").alias("rows"), F.max("row_count").alias("most"))
    return sizes.agg(
        F.sum("rows").alias("row_count"),
        F.count("*").alias("buckets"),
        (F.max("rows") < 2 * F.sum("rows") / 16).alias("even"),
        (F.max("most") <= 10).alias("bounded"),
    )


@query
def payload_nozzle_rows(spark, d):
    """The enriched nozzle events as their request bodies carry them, row by row."""
    rows = nozzle_v1(spark, d)
    fields = ", ".join(f"{name}: {kind}" for name, kind in rows.dtypes)
    bodies = payloads.text_payloads(rows, 1000, F.to_json(F.struct(*rows.columns)))
    each = F.explode(F.from_json("payload", f"array<struct<{fields}>>"))
    return bodies.select(each.alias("r")).select(*[F.col(f"r.{name}").alias(name) for name in rows.columns])


@query
def stream_sink_quarantine(spark, d):
    """What the file sink's one table holds beyond the landed rows: unrouted records and lost values."""
    root = fresh_path(spark, "sink")
    _timer_messages(spark, d).write.parquet(f"{root}/in")
    inlet = spark.readStream.schema("value string").parquet(f"{root}/in")
    sink_records(inlet, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    lost = lost_records(sunk(spark, f"{root}/out"), ["ea_pap_timers"])
    fields = F.from_json("raw", "Product_ID string, User_Name string, ulIdleTime string")
    return lost.select("reason", F.array_join("bad_columns", ",").alias("bad_columns"), fields.alias("f")).select(
        "reason",
        "bad_columns",
        F.col("f.Product_ID").alias("product_id"),
        F.col("f.User_Name").alias("user_name"),
        F.col("f.ulIdleTime").alias("idle_text"),
    )
