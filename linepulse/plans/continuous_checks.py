"""SQL checks of the queries in ``continuous``."""

from __future__ import annotations

from linepulse.plans.catalog import EVENT_CUTS
from linepulse.plans.checks import (
    _CH,
    _LANDED_TIMERS,
    _P1,
    _P2,
    _EQUIP,
    _SLOT,
    _STREAM_WIDE,
    _WC_MACHINE,
    _WC_SIDE,
    _XREF,
    _WIDE_VIEWS,
    CHECKS,
    _check,
    _enriched,
)

_UNIT = "kpi, machine_id, pcb_side"
_check(
    "xmr_sliding",
    f"""
    , panes AS (SELECT DISTINCT {_UNIT}, time_bucket(INTERVAL 15 MINUTE, max_inspection_end_time)
                                         + INTERVAL 15 MINUTE AS window_end FROM kpi_records),
    inside AS (
        SELECT p.*, r.result,
               abs(r.result - lag(r.result) OVER (
                   PARTITION BY p.kpi, p.machine_id, p.pcb_side, p.window_end
                   ORDER BY r.max_inspection_end_time, r.generated_key)) AS step
        FROM panes p JOIN kpi_records r
          ON p.kpi = r.kpi AND p.machine_id = r.machine_id AND p.pcb_side = r.pcb_side
         AND r.max_inspection_end_time >= window_end - INTERVAL 24 HOUR AND r.max_inspection_end_time < window_end)
    SELECT {_UNIT}, window_end, points, round(mean + 1e-9, 6) AS mean,
           CASE WHEN points > 1 THEN round(least(100.0::DOUBLE, (mean + 2.66 * mr) * 100) + 1e-9, 6) END AS ucl,
           CASE WHEN points > 1 THEN round(greatest(0.0::DOUBLE, (mean - 2.66 * mr) * 100) + 1e-9, 6) END AS lcl
    FROM (SELECT {_UNIT}, window_end, count(*) AS points, avg(result) AS mean, avg(step) AS mr
          FROM inside GROUP BY ALL)""",
    "kpi_records",
)
_LATEST = CHECKS["latest_version"]
CHECKS["stream_latest_buckets"] = f"""
    SELECT *, 'all' AS reader FROM ({_LATEST})
    UNION ALL SELECT *, 'last batch' FROM ({_LATEST})
    WHERE (user_id, event_type) IN (SELECT (user_id, event_type) FROM events WHERE ts >= TIMESTAMP '{EVENT_CUTS[1]}')"""
CHECKS["volume_bucketed"] = CHECKS["volume_by_machine"]

_check(
    "sql_functions",
    f"""
    SELECT 'location' AS part, {_CH} AS a, concat({_P1}, '-', {_P2}) AS b, concat(user_name, ' - ', {_CH}) AS c,
           CAST(CAST({_P1} AS INT) + 1 AS STRING) AS d,
           concat(CAST(tooltype AS STRING), '.', CAST(CAST({_P2} AS INT) + 1 AS STRING)) AS e,
           split_part(xml_tag_name, '-', 3) AS f, split_part(product_id, '.', 1) AS g, count(*) AS row_count
    FROM nozzle_events GROUP BY ALL
    UNION ALL
    SELECT 'centre', {_WC_SIDE}, {_WC_MACHINE},
           concat('u?Location=', placing_plant_code, '&SN=', assem_serial_no), NULL, NULL, NULL, NULL, count(*)
    FROM defect_events GROUP BY ALL
    UNION ALL
    SELECT 'reference', substr(ref_id, 1, length(circuit) + 1), substr(ref_id, length(circuit) + 2),
           concat(head, '-', spindle), ltrim(work_order, '0'), NULL, NULL, NULL, count(*)
    FROM progorderlist_raw GROUP BY ALL
    UNION ALL
    SELECT 'words', word, CAST(ok AS VARCHAR), CAST(CAST(sum(TRY_CAST(txt AS DOUBLE)) AS DECIMAL(18, 2)) AS VARCHAR),
           NULL, NULL, NULL, NULL, count(*)
    FROM (SELECT *, CASE WHEN word IN ('Int', 'int64') THEN regexp_full_match(txt, '[0-9]+')
                         WHEN word IN ('Decimal', 'Float', 'double') THEN TRY_CAST(txt AS DOUBLE) IS NOT NULL
                         WHEN word = 'Boolean' THEN lower(txt) IN ('true', 'false') ELSE true END AS ok
          FROM words) GROUP BY word, ok
    UNION ALL
    SELECT 'times', CAST(epoch_ms(time_bucket(INTERVAL 15 MINUTE, inspection_end)) AS VARCHAR),
           CAST(epoch_ms(date_trunc('hour', inspection_end)) AS VARCHAR),
           CAST(inspection_end > TIMESTAMP '1997-12-02 00:00:00' AS VARCHAR), NULL, NULL, NULL, NULL, count(*)
    FROM header GROUP BY ALL
    UNION ALL
    SELECT 'orders', concat('r?wo=', sap_wo, '&Location=NATION_3&Section='), side, assembly, hdfs_file_name,
           NULL, NULL, NULL, 1
    FROM (SELECT *, row_number() OVER (PARTITION BY optel_schedule_wo
                                       ORDER BY hdfs_file_name DESC, sap_wo DESC, side DESC, assembly DESC) AS n
          FROM wodetail_raw WHERE plant = 'NATION_3') WHERE n = 1""",
    "nozzle_events",
    "defect_events",
    "progorderlist_raw",
    "words",
    "header",
    "wodetail_raw",
)


def _fields(table: str, source: str, fields: str) -> str:
    return f"""
    SELECT '{table}' AS record_type, field, kind, n AS row_count, nested, known
    FROM (VALUES {fields}) f(field, kind, nested, known), (SELECT count(*) AS n FROM {source})"""


_check(
    "json_inferred",
    " UNION ALL ".join(
        (
            _fields(
                "ea_pap_timers",
                "timer_events",
                """('xml_tag_name', 'STRING', false, true), ('Product_ID', 'STRING', false, true),
                   ('ulIdleTime', 'BIGINT', false, true), ('samples', 'ARRAY<BIGINT>', true, false),
                   ('operator', 'OBJECT<late: BOOLEAN, line: STRING>', true, false)""",
            ),
            _fields(
                "ea_pap_slot",
                "slot_events",
                """('xml_tag_name', 'STRING', false, true), ('Component_Name', 'STRING', false, true),
                   ('SlotNumber', 'BIGINT', false, true)""",
            ),
            _fields(
                "ea_pap_slot",
                "(SELECT * FROM slot_events WHERE slot_number = 7)",
                "('angle', 'DECIMAL(2,1)', false, false)",
            ),
            _fields(
                "ea_pap_nozzle",
                "nozzle_events",
                "('xml_tag_name', 'STRING', false, true), ('ulPicks', 'VARIANT', false, true)",
            ),
        )
    ),
    "timer_events",
    "slot_events",
    "nozzle_events",
)
_check(
    "json_typed_paths",
    """
    SELECT product_id, user_name AS line, ul_idle_time > 50 AS late, CAST(ul_idle_time + 1 AS BIGINT) AS second_sample,
           CAST(NULL AS BIGINT) AS third_sample, CAST(NULL AS BIGINT) AS line_number
    FROM timer_events""",
    "timer_events",
)
_check("stream_file_sink", _LANDED_TIMERS, "timer_events")

_ROWS = f"""
    SELECT machine_id, pcb_side, max_inspection_end_time AS t, result,
           time_bucket(INTERVAL 15 MINUTE, max_inspection_end_time) AS w,
           CAST(generated_key AS BIGINT) % 50 = 0 AND max_inspection_end_time < TIMESTAMP '{EVENT_CUTS[1]}' AS held
    FROM kpi_points"""
_PAST = f"""
    w + INTERVAL 15 MINUTE <= (SELECT max(t) - INTERVAL 30 MINUTE FROM ({_ROWS}) WHERE NOT held)"""
_check(
    "stream_interval_yield",
    f"""
    SELECT machine_id, pcb_side, CAST(epoch_ms(w) AS BIGINT) AS interval_id, count(*) AS boards,
           round(avg(CASE WHEN result < 0.06 THEN 1.0::DOUBLE ELSE 0 END), 6) AS fpy_result,
           round(avg(CASE WHEN result >= 0.02 AND result < 0.06 THEN 1.0::DOUBLE ELSE 0 END), 6) AS ffr_result
    FROM ({_ROWS}) WHERE NOT held AND {_PAST} GROUP BY machine_id, pcb_side, w""",
    "kpi_points",
)
_check(
    "stream_loss",
    f"""
    SELECT 'in' AS kind, count(*) AS row_count FROM ({_ROWS})
    UNION ALL SELECT 'given', count(*) FROM ({_ROWS}) WHERE NOT held AND {_PAST}
    UNION ALL SELECT 'waiting', count(*) FROM ({_ROWS}) WHERE NOT held AND NOT ({_PAST})
    UNION ALL SELECT 'late', count(*) FROM ({_ROWS}) WHERE held
    UNION ALL SELECT 'late groups seen', CAST(count(*) > 0 AS BIGINT) FROM ({_ROWS}) WHERE held""",
    "kpi_points",
)
_check(
    "stream_progress",
    """
    SELECT 'records' AS query, CASE WHEN length(product_id) % 2 = 0 THEN 'a' ELSE 'b' END AS source,
           count(*) AS rows_in, '{"logOffset": 0}' AS end_offset
    FROM timer_events GROUP BY ALL""",
    "timer_events",
)
_enriched("stream_union", _STREAM_WIDE, *_WIDE_VIEWS)
_DOUBLED = _SLOT.replace(
    "coalesce(e.unit_cost, 0.20::DOUBLE)",
    "coalesce(e.unit_cost * CASE WHEN a.date_time >= TIMESTAMP '1999-01-01' THEN 2 ELSE 1 END, 0.20::DOUBLE)",
)
_enriched(
    "stream_cost_refresh",
    f"""
    SELECT CASE WHEN date_time < TIMESTAMP '1997-01-01' THEN 0
                WHEN date_time < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END AS n,
           product_id, component_name, plant, machine_name, slot, round(unit_cost, 4) AS unit_cost
    FROM ({_DOUBLED})""",
    "slot_events",
    "material_cost_raw",
)
CHECKS["timers_salted"] = CHECKS["timers_enriched"]
CHECKS["row_count_footers"] = CHECKS["row_count_report"]


def _ids(tag: str, tag_id: str, stamp: str, second: str, raw: str) -> str:
    return f"""
    SELECT 'c1-smt-sng-spiTest-{tag}' AS xml_tag_name, CAST(o_orderkey AS VARCHAR) AS generated_key,
           {second} AS second_value,
           sha256(concat_ws(chr(1), concat('f', o_custkey, '.txt'), 'c1-smt-sng-spiTest-{tag}', {tag_id}, '{stamp}', {raw}))
             AS record_id
    FROM orders"""


_IDS = " UNION ALL ".join(
    (
        _ids(
            "header", "CAST(o_custkey AS VARCHAR)", "t1", "'M1'",
            "concat(o_orderkey, ',M1, ', o_orderpriority, ' ,', strftime(o_orderdate, '%m/%d/%Y %H:%M:%S'))",
        ),
        _ids("detail", "'2'", "t2", "'1'", "concat(o_orderkey, '|1|', CAST(o_totalprice AS DECIMAL(12, 2)), '|R1')"),
        _ids("detail", "'2'", "t2", "'2'", "concat(o_orderkey, '|2|', o_custkey, '|R2|long')"),
    )
)
CHECKS["record_ids"] = f"SELECT *, record_id AS carried_id FROM ({_IDS})"
_enriched("slot_enriched_xref", _SLOT.replace(_EQUIP, _XREF), "slot_events", "material_cost_raw", "xref_raw")
CHECKS["stream_rate_limit"] = """
    SELECT CAST((c_custkey % 5) // 2 AS INT) AS n, count(*) AS row_count, min(c_name) AS first_name
    FROM customer GROUP BY ALL"""
CHECKS["payload_equal_rows"] = """
    SELECT count(*) AS row_count, 16 AS buckets, true AS even, true AS bounded FROM lineitem"""
CHECKS["payload_nozzle_rows"] = CHECKS["nozzle_v1"]
CHECKS["stream_sink_quarantine"] = CHECKS["stream_quarantine"]
