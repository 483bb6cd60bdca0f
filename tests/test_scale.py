"""Work is spread over tasks, a batch is parsed once, and no task holds the rows of a hot key."""

from pyspark.sql import functions as F

from linepulse.functions import text
from linepulse.operators import landing, routing
from linepulse.plans import catalog, continuous
from linepulse.session import fresh_path, shared_dir, spread
from linepulse.sinks import files
from linepulse.streaming import ingest, runner
from linepulse.streaming import kpi as kpi_stream
from linepulse.sources import envelope, inferred, records

TIMERS, NOZZLE = "c1-smt-x-timers", "c1-smt-x-nozzle"


def _messages(spark, n, tag=TIMERS):
    body = F.concat(F.lit(f'{{"xml_tag_name":"{tag}","Product_ID":"'), F.col("id").cast("string"), F.lit('","ulIdleTime":"n/a"}'))
    return spark.range(n).coalesce(1).select(body.alias("value"))


def _leaves(spark, name):
    at = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(at) if s.getPath().getName().startswith(f"{name}-")]


def test_spread_bounds_the_rows_of_a_task(spark, rows):
    df = spark.range(1000).coalesce(1)
    made = spread(df, 100)
    sizes = made.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 5 and max(r[1] for r in sizes) <= 200
    assert rows(made) == rows(df)
    assert spread(df.limit(0)).count() == 0


def test_messages_of_one_file_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    lines = spark.range(2000).coalesce(1).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 9).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(5.0).alias("l_quantity"),
        F.lit("1997-01-01").cast("timestamp").alias("l_shipdate"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(catalog, "spread", lambda df, each=100: spread(df, 100))
    made = catalog._timer_messages(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() > 10 and made.count() == 2000


def test_products_read_only_their_record_type(spark, rows):
    two = _messages(spark, 5).unionByName(_messages(spark, 7, NOZZLE)).unionByName(_messages(spark, 3, "other"))
    parsed = routing.classify(records.json_records(two))
    want = rows(parsed.select("xml_tag_name", "field_names", "field_values", "raw", "record_type"))
    with ingest.by_type(parsed) as kept:
        assert kept.columns == parsed.columns
        assert rows(kept.select("xml_tag_name", "field_names", "field_values", "raw", "record_type")) == want
        own = kept.filter(F.col("record_type") == "ea_pap_timers")
        assert all("record_type=ea_pap_timers" in f for f in own.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
        assert "PartitionFilters: [isnotnull(record_type" in own._jdf.queryExecution().toString()
        assert kept.filter(F.col("record_type").isNull()).count() == 3
        assert _leaves(spark, "batch")
    assert not _leaves(spark, "batch")


def test_an_empty_batch_has_no_types(spark):
    parsed = routing.classify(records.json_records(_messages(spark, 4).limit(0)))
    with ingest.by_type(parsed) as kept:
        assert kept.count() == 0 and ingest.present_tables(kept, {"ea_pap_timers": "-timers"}) == []


def test_a_query_keeps_its_settings_and_the_session_its_own(spark):
    root, seen = fresh_path(spark, "kept"), {}
    _messages(spark, 4).write.parquet(f"{root}/in")
    before = {k: spark.conf.get(k, None) for k in runner.QUERY_SETTINGS}

    def each(batch, batch_id):
        seen.update({k: batch.sparkSession.conf.get(k) for k in runner.QUERY_SETTINGS})

    stream = spark.readStream.schema("value string").parquet(f"{root}/in")
    runner.start(stream, each, f"{root}/checkpoint").awaitTermination()
    assert seen == runner.QUERY_SETTINGS
    assert {k: spark.conf.get(k, None) for k in runner.QUERY_SETTINGS} == before


def test_tags_are_counted_before_they_meet_their_plants(spark, tmp_path, rows):
    lines = spark.range(0, 1000).select(
        F.lit(0).cast("bigint").alias("l_partkey"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber")
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    made = catalog.location_plant(spark, str(tmp_path))
    assert rows(made) == [("sng", "5170", 1000)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join") :]
    assert "Aggregate [" in below, plan


def test_keys_of_plain_names_need_no_pattern(spark):
    marks = "".join(map(chr, range(1, 128))).replace("\u0001", "")
    names = ["Head #", "ul_idle__time", "", "İ_Größe 2", "K-x", "na\u0000me", marks]
    pattern = F.transform("n", lambda n: F.lower(F.regexp_replace(n, "[^A-Za-z0-9]", "")))
    df = spark.createDataFrame([(names,), (names[:3],), (None,), ([],)], "n array<string>")
    got = df.select(text.keys_of(F.col("n")).alias("k"), pattern.alias("p")).collect()
    assert [r.k for r in got] == [got[0].p, got[1].p, None, [""]]
    plan = df.select(text.keys_of(F.col("n")))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" in plan


def test_lost_values_are_looked_for_once(spark, rows):
    parsed = routing.classify(records.json_records(_messages(spark, 5).unionByName(_messages(spark, 7, NOZZLE))))
    lost = landing.misfit_rows(parsed, "ea_pap_timers")
    assert rows(lost, F.array_join("bad_columns", ",")) == [("ul_idle_time",)] * 5
    assert lost.columns == [*parsed.columns, "bad_columns"]
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN ul_setup_time END") == 1, plan


def test_no_generated_method_is_too_long_to_be_compiled():
    assert int(runner.QUERY_SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000  # HotSpot's limit


def test_lookups_of_a_stream_are_chosen_once(spark, tmp_path, monkeypatch, rows):
    at = F.element_at(F.array(*map(F.lit, ("1996-01-01", "1998-01-01", "1999-06-01"))), F.col("l_linenumber"))
    spark.range(1, 4).select(
        F.lit(7).cast("bigint").alias("l_orderkey"), F.lit(4).cast("bigint").alias("l_partkey"), F.lit(2).cast("bigint").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"), F.lit(5.0).alias("l_quantity"),
    ).select("*", at.cast("timestamp").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name, row in (
        ("supplier", "SELECT 2L AS s_suppkey, 'Supplier#000000002' AS s_name, 3 AS s_nationkey"),
        ("nation", "SELECT 3 AS n_nationkey, 'NATION_4' AS n_name"),
        ("part", "SELECT 4L AS p_partkey, 10.0D AS p_retailprice"),
    ):
        spark.sql(row).write.parquet(f"{tmp_path}/{name}.parquet")
    plans, slot = [], continuous.enrich.slot

    def seen(batch, *lookups):
        plans.append([df._jdf.queryExecution().optimizedPlan().toString() for df in lookups[:3]])
        return slot(batch, *lookups)

    monkeypatch.setattr(continuous.enrich, "slot", seen)
    made = continuous.stream_cost_refresh(spark, str(tmp_path))
    assert rows(made, "n", "unit_cost") == [(0, 10.0), (1, 10.0), (2, 20.0)]
    assert len(plans) == 3 and all("Window" not in plan for batch in plans for plan in batch)



def test_bodies_of_one_service_are_read_by_many_tasks(spark, tmp_path, monkeypatch, rows):
    made = spark.createDataFrame(
        [("a", 2, '[{"table_name":"x"},{"table_name":"y"}]'), ("a", 100, '[{"table_name":"z"}]'), ("b", 101, '[{"picks":1.5}]')],
        "service string, row_count bigint, payload string",
    )
    made.write.parquet(f"{tmp_path}/payloads")
    monkeypatch.setattr(catalog, "_wide_stream", lambda spark, d: str(tmp_path))
    got = catalog.stream_payloads(spark, "")
    assert rows(got, "service", "bounded", "table_name", "picks") == [
        ("a", True, "x", None), ("a", True, "y", None), ("a", True, "z", None), ("b", False, None, 1.5),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert "Window" not in plan


def test_archived_messages_are_packed(spark, tmp_path, rows):
    messages = spark.range(2000).coalesce(1).select(F.concat(F.lit("same text " * 20), F.col("id").cast("string")).alias("value"))
    files.archive(messages, str(tmp_path), "line_0")
    kept = spark.read.text(f"{tmp_path}/line_0")
    assert rows(kept) == rows(messages)
    size = sum(p.stat().st_size for p in (tmp_path / "line_0").glob("part-*"))
    assert size < 2000 * 200 / 5
    assert runner.QUERY_SETTINGS["spark.sql.parquet.compression.codec"] == "zstd"


def test_equal_lists_of_a_batch_are_kept_as_texts(spark, rows):
    line = "<LiveTextData><TagName>c1-smt-x-units</TagName><TagValue fieldnames=\"{}\" fieldtypes=\"{}\" separator=\",\">{}</TagValue></LiveTextData>"
    body = line.format("SERIAL_NO,,Panel No,", "String,Int,", "a,1, b")
    messages = spark.createDataFrame([(f"<ArrayOfLiveTextData>{body}{body}</ArrayOfLiveTextData>",), ("<bad",)], "value string")
    parsed = routing.classify(envelope.parse(messages, "t", "b", F.lit("2024-01-01").cast("timestamp")))
    want = rows(parsed)
    with ingest.by_type(parsed, ingest.XML_LISTS) as kept:
        assert kept.columns == parsed.columns and rows(kept) == want
        at = _leaves(spark, "batch")[0]
        kinds = dict(spark.read.parquet(f"{shared_dir(spark)}/{at}").dtypes)
        assert {kinds[c] for c in ingest.XML_LISTS} == {"string"} and kinds["field_values"] == "array<string>"
    json = routing.classify(records.json_records(_messages(spark, 3)))
    with ingest.by_type(json, ingest.KEYS) as kept:
        assert rows(kept, "field_keys", "field_names") == rows(json, "field_keys", "field_names")


def test_records_of_texts_are_written_as_a_whole(spark):
    schema = ", ".join(f"{c} string" for c in envelope.RECORD_LINEAGE)
    cases = [
        (["A", "b c"], ["String", "string"], ["x\"y", " "]),
        (["A", "B"], ["String", "Int"], ["x", "5"]),
        (["A", "A"], ["String", "String"], ["x", "y"]),
        (["A", "B"], ["String", "String"], ["x"]),
        (["A", "B"], ["String"], ["x", "y"]),
        (["A"], ["Int"], ["no"]),
        ([""], ["other"], ["\u00e9\n"]),
    ]
    df = spark.createDataFrame(
        [(*["t"] * 7, None, *case) for case in cases],
        f"{schema}, field_names array<string>, field_types array<string>, field_values array<string>",
    )
    about = ",".join(f'"{c}":' + ("null" if c == envelope.RECORD_LINEAGE[-1] else '"t"') for c in envelope.RECORD_LINEAGE)
    own = ['"A":"x\\"y","b c":" "', '"A":"x","B":5', '"A":"x","A":"y"', '"A":"x","B":""', '"A":"x","B":""', '"A":""', '"":"\u00e9\\n"']
    assert [r[0] for r in df.select(envelope.record_json()).collect()] == [f"{{{o},{about}}}" for o in own]


def test_records_of_texts_need_no_look_at_each_value(spark, rows):
    line = '<ArrayOfLiveTextData><LiveTextData><TagName>t</TagName><TagValue fieldnames="A,B" fieldtypes="{}" separator=",">{}</TagValue></LiveTextData></ArrayOfLiveTextData>'
    cases = [("String,string", "a,b"), ("String,string", "a"), ("String", "a,b"), ("Int,String", "a,b"), ("String,String", " a ,\tb "), ("String,String", " ,")]
    df = spark.createDataFrame([(i, line.format(*c)) for i, c in enumerate(cases)], "n int, value string")
    got = [rows(envelope.parse(df.filter(F.col("n") == i), "t", "b"), "bad_fields", "field_values") for i in range(len(cases))]
    assert [g[0] for g in got] == [
        ([], ["a", "b"]), (["B"], ["a"]), (["B"], ["a", "b"]), (["A"], ["a", "b"]), ([], ["a", "b"]), ([], [" ", ""]),
    ]


def test_lost_values_are_found_by_compiled_code(spark):
    parsed = routing.classify(records.json_records(_messages(spark, 5)))
    plan = landing.misfit_rows(parsed, "ea_pap_timers")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan.split("Filter")[1] and plan.count("Generate explode") == 1, plan


def test_messages_of_one_topic_are_written_where_they_lie(spark, tmp_path, rows):
    made = spark.range(0, 40, 1, 4).select(F.col("id").cast("string").alias("value"))
    files.append_topic(made, f"{tmp_path}/topics", "wide", runner.BatchId(0, "r"))
    kept = spark.read.parquet(f"{tmp_path}/topics")
    assert rows(kept, "value", "topic", "run", "batch") == [(v, "wide", "r", 0) for (v,) in rows(made)]
    assert len(list((tmp_path / "topics/run=r/batch=0/topic=wide").glob("part-*"))) == 4
    files.append_topic(made.limit(1), f"{tmp_path}/topics", "wide", runner.BatchId(0, "r"))
    assert spark.read.parquet(f"{tmp_path}/topics").count() == 1


def test_variants_are_parsed_once_and_after_they_are_dealt(spark, rows):
    messages = spread(_messages(spark, 5).unionByName(_messages(spark, 2, "other")), 2)
    got = inferred.typed(inferred.variants(messages), "ea_pap_timers", {"id": ("$.Product_ID", "bigint")})
    assert rows(got) == [(n,) for n in range(5)]
    for made in (got, inferred.fields(inferred.variants(messages))):
        plan = made._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parsejson(") + plan.count("parse_json(") == 1, plan
        assert "$.xml_tag_name" in plan and plan.count("$.xml_tag_name") == 1
        assert max(plan.find("parsejson("), plan.find("parse_json(")) < plan.index("repartition ")
    broken = spark.createDataFrame([("{",), (None,), ("[1]",)], "value string")
    assert rows(inferred.variants(broken), "record_type", F.col("record").isNull(), "raw") == [
        (None, False, "[1]"), (None, True, "{"), (None, True, None),
    ]


def test_a_join_of_streams_runs_no_batch_without_rows(spark, tmp_path, rows):
    schema = "generated_key string, machine_id string, pcb_side string, pcb_name string, pcb_result string, inspection_end timestamp"
    pads = "generated_key string, volume double, measured_at timestamp"
    for number, day in enumerate(("2024-01-01", "2024-03-01")):
        at = F.lit(f"{day} 10:00:00").cast("timestamp")
        made = spark.range(3).select(F.concat(F.lit(f"{number}-"), F.col("id").cast("string")).alias("generated_key"), at.alias("at"))
        made.select("generated_key", F.lit("M").alias("machine_id"), F.lit("Top").alias("pcb_side"), F.lit("n").alias("pcb_name"),
                    F.lit("GOOD").alias("pcb_result"), F.col("at").alias("inspection_end")).write.parquet(f"{tmp_path}/heads/{number}")
        made.select("generated_key", F.lit(2.0).alias("volume"), F.col("at").alias("measured_at")).write.parquet(f"{tmp_path}/pads/{number}")
        run = kpi_stream.board_volume_stream(
            spark.readStream.schema(schema).parquet(f"{tmp_path}/heads/*"), spark.readStream.schema(pads).parquet(f"{tmp_path}/pads/*"),
            f"{tmp_path}/boards", f"{tmp_path}/checkpoint",
        )
        run.awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/boards")
    assert rows(kept, "generated_key", "volume_sum", "volume_count") == [(f"{n}-{i}", 2.0, 1) for n in range(2) for i in range(3)]
    assert len(list(tmp_path.glob("boards/run=*/batch=*"))) == 2
    assert runner.QUERY_SETTINGS["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] == "false"


def test_slot_events_are_not_sent_to_meet_their_machines(spark, tmp_path, rows):
    at = F.lit("1996-01-01").cast("timestamp").alias("l_shipdate")
    spark.range(1, 4).select(
        F.lit(7).cast("bigint").alias("l_orderkey"), F.lit(4).cast("bigint").alias("l_partkey"), F.lit(2).cast("bigint").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"), F.lit(5.0).alias("l_quantity"), at,
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name, row in (
        ("supplier", "SELECT 2L AS s_suppkey, 'Supplier#000000002' AS s_name, 3 AS s_nationkey"),
        ("nation", "SELECT 3 AS n_nationkey, 'NATION_4' AS n_name"),
        ("part", "SELECT 4L AS p_partkey, 10.0D AS p_retailprice"),
    ):
        spark.sql(row).write.parquet(f"{tmp_path}/{name}.parquet")
    made = catalog.slot_enriched(spark, str(tmp_path))
    assert rows(made, "slot_number", "optel_schedule_wo", "unit_cost") == [(n, "7", 10.0) for n in (1, 2, 3)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_name" not in plan, plan
    sent = [e.split("Project [")[1].split("]")[0] for e in plan.split("Exchange hashpartitioning(component_name")[1:]]
    assert sent and all("split_plant_id" not in columns for columns in sent), plan
