"""Plant relations derived from the given tables.

Each view is one SELECT that Spark and the checking database both understand, so the
queries and their checks start from the same rows. Braces name the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linepulse.registry import ROUTES

_VERSION = "concat('line_', CAST(CAST(l_shipdate AS DATE) AS STRING))"
_ORDER_PLANT = "concat('NATION_', CAST(l_orderkey % 25 AS STRING))"
_MACHINE = "concat('M', CAST(l_suppkey AS STRING))"
_HEAD = "concat('H', CAST(l_suppkey % 4 AS STRING))"
_LOCATION = "concat('0,', CAST(l_linenumber AS STRING), ',', CAST(l_suppkey % 10 AS STRING))"
_PRODUCT = "concat(CAST(l_orderkey AS STRING), '.x')"
_USER = "concat('Supplier#', lpad(CAST(l_suppkey AS STRING), 9, '0'))"
_LINES = "{lineitem} l JOIN {supplier} s ON l_suppkey = s_suppkey JOIN {nation} n ON s_nationkey = n_nationkey"


def _tag(kind: str) -> str:
    return f"concat('c1-smt-loc', CAST(l_suppkey % 25 AS STRING), '-{kind}')"


def _tag_case() -> str:
    tags = [f"c1-smt-sng{r if r.startswith('-') else '-' + r}" for r in ROUTES.values()]
    tags += ["c1-smt-sng-unknown", "c1-smt-meq-other"]
    arms = " ".join(f"WHEN {i} THEN '{tag}'" for i, tag in enumerate(tags))
    return f"CASE l_partkey % {len(tags)} {arms} END"


VIEWS = {
    "header": """
        SELECT CAST(o_orderkey AS STRING) AS generated_key,
               concat('M', CAST(o_custkey % 17 AS STRING)) AS machine_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Top' ELSE 'Bottom' END AS pcb_side,
               o_orderpriority AS pcb_name,
               CASE o_orderstatus WHEN 'F' THEN 'GOOD' WHEN 'O' THEN 'PASS'
                                  WHEN 'P' THEN 'FAIL' END AS pcb_result,
               CAST(o_orderdate AS TIMESTAMP) AS inspection_end
        FROM {orders}""",
    "detail": """
        SELECT CAST(l_orderkey AS STRING) AS generated_key, l_quantity AS volume
        FROM {lineitem}""",
    "equipment_raw": f"""
        SELECT {_MACHINE} AS machine_name, s_name AS equipment_make,
               concat('MODEL', CAST(l_linenumber AS STRING)) AS equipment_model,
               concat('TYPE', CAST(l_partkey % 5 AS STRING)) AS equipment_type,
               {_HEAD} AS head_1, concat('H', CAST(l_suppkey % 3 AS STRING)) AS head_2,
               n_name AS plant, {_VERSION} AS hdfs_file_name
        FROM {_LINES}""",
    "info_raw": f"""
        SELECT CAST(l_partkey % 12 AS INT) AS crc_id,
               concat('TOOL', CAST(l_partkey % 12 AS STRING), '-', CAST(l_linenumber AS STRING)) AS name,
               concat('tool ', CAST(l_linenumber AS STRING)) AS description,
               n_name AS plant_code, {_MACHINE} AS machine, {_VERSION} AS hdfs_file_name
        FROM {_LINES}""",
    "wodetail_raw": f"""
        SELECT CAST(l_orderkey AS STRING) AS optel_schedule_wo,
               concat('S', CAST(l_orderkey AS STRING)) AS sap_wo,
               CASE WHEN l_orderkey % 2 = 0 THEN 'Top' ELSE 'Bottom' END AS side,
               concat('A', CAST(l_partkey % 100 AS STRING)) AS assembly,
               {_ORDER_PLANT} AS plant, l_quantity AS setup, {_VERSION} AS hdfs_file_name
        FROM {{lineitem}}""",
    "progorderlist_raw": f"""
        SELECT {_MACHINE} AS machine, {_ORDER_PLANT} AS plant,
               CAST(l_orderkey AS STRING) AS work_order,
               concat('12-', CASE WHEN l_partkey % 2 = 0 THEN 'R' ELSE 'Q' END,
                      CAST(l_partkey % 50 AS STRING)) AS ref_id,
               CAST(l_linenumber % 4 AS BIGINT) AS silkscreen, '12' AS circuit,
               concat('H', CAST(l_linenumber AS STRING)) AS head,
               CAST(l_suppkey % 8 AS STRING) AS spindle, {_VERSION} AS hdfs_file_name
        FROM {{lineitem}}""",
    "comptype_raw": f"""
        SELECT n_name AS plant, {_MACHINE} AS machine, CAST(l_partkey AS STRING) AS part_number,
               {_HEAD} AS head_type, CAST(l_partkey % 50 AS DOUBLE) AS pins,
               concat('N', CAST(l_linenumber AS STRING)) AS nozzle1,
               concat('PK', CAST(l_linenumber % 3 AS STRING)) AS package,
               {_VERSION} AS hdfs_file_name
        FROM {_LINES}""",
    "material_cost_raw": """
        SELECT CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey AS STRING), 18, '0')
                    ELSE concat('X', CAST(p_partkey AS STRING)) END AS material,
               concat('NATION_', CAST(p_partkey % 25 AS STRING)) AS plant,
               p_retailprice AS unit_cost
        FROM {part}""",
    "xref_raw": """
        SELECT concat('LOC', CAST(n_nationkey AS STRING)) AS location, n_name AS plant
        FROM {nation}""",
    "nozzle_events": f"""
        SELECT {_tag('nozzle')} AS xml_tag_name, {_PRODUCT} AS product_id,
               CAST(l_shipdate AS TIMESTAMP) AS date_time, {_USER} AS user_name,
               {_LOCATION} AS location, CAST(l_partkey % 14 AS INT) AS tooltype,
               CAST(l_quantity AS INT) AS ul_picks,
               CAST(l_quantity AS INT) - l_linenumber AS ul_placements,
               l_linenumber AS ul_comp_missing, CAST(l_partkey % 3 AS INT) AS ul_possible_missing,
               CAST(l_suppkey % 6 AS INT) AS ul_rejects
        FROM {{lineitem}}""",
    "timer_events": f"""
        SELECT {_tag('timers')} AS xml_tag_name, {_PRODUCT} AS product_id,
               CAST(l_shipdate AS TIMESTAMP) AS date_time, {_USER} AS user_name,
               CAST(l_quantity AS INT) AS ul_production_time, l_linenumber AS ul_setup_time,
               CAST(l_partkey % 100 AS INT) AS ul_idle_time,
               CAST(l_partkey % 7 AS INT) AS ul_diagnostic_time,
               CAST(l_suppkey % 9 AS INT) AS ul_waiting_for_operator,
               CAST(l_partkey % 11 AS INT) AS ul_waiting_for_interrupt_recovery,
               CAST(l_partkey % 13 AS INT) AS ul_waiting_for_board_in_workarea
        FROM {{lineitem}}""",
    "defect_events": f"""
        SELECT {_tag('defects')} AS xml_tag_name, {_ORDER_PLANT} AS placing_plant_code,
               CASE l_linenumber % 3
                    WHEN 0 THEN concat('P_TOP_M', CAST(l_suppkey AS STRING))
                    WHEN 1 THEN concat('P_BOT_M', CAST(l_suppkey AS STRING))
                    ELSE concat('M', CAST(l_suppkey AS STRING)) END AS placing_wc_code,
               concat('S', CAST(l_orderkey AS STRING)) AS order_no,
               CAST(l_linenumber % 4 AS INT) AS fault_board_no,
               concat('R', CAST(l_partkey % 50 AS STRING)) AS ref_designator,
               CAST(l_partkey AS STRING) AS cmpnt_part_no,
               CAST(l_shipdate AS TIMESTAMP) AS defect_date,
               concat('D', CAST(l_partkey % 20 AS STRING)) AS defect_code,
               l_returnflag AS fail_type,
               concat('SN', CAST(l_partkey AS STRING)) AS assem_serial_no,
               l_quantity AS defect_count
        FROM {{lineitem}}""",
    "slot_events": f"""
        SELECT {_tag('slot')} AS xml_tag_name, {_PRODUCT} AS product_id,
               CAST(l_shipdate AS TIMESTAMP) AS date_time, {_USER} AS user_name,
               CASE WHEN l_linenumber = 7 THEN 'X' ELSE CAST(l_partkey AS STRING) END AS component_name,
               l_linenumber AS slot_number, {_LOCATION} AS location,
               CAST(l_partkey % 3 AS INT) AS ul_possible_missing,
               CAST(l_quantity AS INT) AS ul_slot_picks,
               CAST(l_quantity AS INT) - l_linenumber AS ul_slot_placements,
               CAST(l_suppkey % 6 AS INT) AS ul_slot_vision_failures
        FROM {{lineitem}}""",
    "tagged": f"""
        SELECT {_tag_case()} AS xml_tag_name, l_orderkey, l_linenumber,
               CASE l_linenumber WHEN 3 THEN 'note-info' WHEN 5 THEN 'my-slot' ELSE 'plain' END AS note
        FROM {{lineitem}}""",
    "kpi_points": """
        SELECT event_type AS machine_id, CASE WHEN user_id % 2 = 0 THEN 'Top' ELSE 'Bottom' END AS pcb_side,
               value / 1000 AS result, CAST(ts AS TIMESTAMP) AS max_inspection_end_time,
               lpad(CAST(event_id AS STRING), 12, '0') AS generated_key
        FROM {events}""",
    "kpi_store": """
        SELECT lpad(CAST(event_id AS STRING), 12, '0') AS generated_key,
               CAST(event_id % 7 AS BIGINT) AS interval_id, 'B' AS pcb_name, value / 1000 AS result,
               CAST(ts AS TIMESTAMP) AS min_inspection_end_time,
               CAST(ts AS TIMESTAMP) AS max_inspection_end_time,
               CAST(ts AS TIMESTAMP) AS bicoe_load_dttm, event_type AS machine_id,
               CASE WHEN user_id % 2 = 0 THEN 'Top' ELSE 'Bottom' END AS pcb_side
        FROM {events}""",
    "kpi_records": """
        SELECT CASE event_id % 3 WHEN 0 THEN 'fpy' WHEN 1 THEN 'ffr' ELSE 'volume' END AS kpi,
               event_type AS machine_id, CASE WHEN user_id % 2 = 0 THEN 'Top' ELSE 'Bottom' END AS pcb_side,
               value / 1000 AS result, CAST(ts AS TIMESTAMP) AS max_inspection_end_time,
               lpad(CAST(event_id AS STRING), 12, '0') AS generated_key
        FROM {events}""",
    "words": """
        SELECT CASE l_linenumber WHEN 1 THEN 'Int' WHEN 2 THEN 'int64' WHEN 3 THEN 'Decimal'
                    WHEN 4 THEN 'Boolean' WHEN 5 THEN 'INT' WHEN 6 THEN 'Float' ELSE 'double' END AS word,
               CASE l_partkey % 5 WHEN 0 THEN CAST(l_partkey AS STRING) WHEN 1 THEN 'bad'
                    WHEN 2 THEN CAST(l_quantity AS STRING)
                    WHEN 3 THEN 'True' ELSE '12x' END AS txt
        FROM {lineitem}""",
}

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in BASE if "{" + t + "}" in text}
    return spark.sql(text, **used)


def with_views(query: str, *names: str) -> str:
    """`query` with the views it names defined in front of it."""
    same = {t: t for t in BASE}
    parts = [f"{name} AS ({VIEWS[name].format(**same)})" for name in names]
    return f"WITH {', '.join(parts)} {query}"
