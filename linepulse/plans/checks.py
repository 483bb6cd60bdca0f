"""The same queries in SQL, to check the results against another engine."""

from __future__ import annotations

from linepulse.plans.views import with_views
from linepulse.registry import ROUTES, TABLES
from linepulse.sinks.payloads import SERVICES

CHECKS: dict[str, str] = {}

REPORT = "https://reports.example/wo"
UNIT = "https://reports.example/unit"
SIDE = "concat(machine_id, '-', pcb_side)"
QUARTER = "CAST(epoch_ms(time_bucket(INTERVAL 15 MINUTE, {0})) AS BIGINT)"


def _check(name: str, sql: str, *views: str) -> None:
    CHECKS[name] = with_views(sql, *views) if views else sql


# --- indicators ---------------------------------------------------------------------

_BOARDS = f"""
    SELECT generated_key, machine_id, pcb_name, pcb_side, {SIDE} AS "machineId_side",
           min(inspection_end) AS min_inspection_end_time,
           max(inspection_end) AS max_inspection_end_time
    FROM header GROUP BY generated_key, machine_id, pcb_name, pcb_side"""


def _ratio(kpi: str, good: str) -> str:
    return f"""
    SELECT b.*, {QUARTER.format('max_inspection_end_time')} AS interval_id,
           round(coalesce(r.ratio, 0), 6) AS {kpi}_result
    FROM ({_BOARDS}) b LEFT JOIN (
        SELECT machine_id, pcb_side,
               count(*) FILTER (WHERE pcb_result IN ({good})) * 1.0::DOUBLE / count(*) AS ratio
        FROM header WHERE pcb_result IN ('GOOD', 'PASS', 'FAIL') GROUP BY machine_id, pcb_side
    ) r ON b.machine_id = r.machine_id AND b.pcb_side = r.pcb_side"""


_check("fpy_by_machine", _ratio("fpy", "'GOOD', 'PASS'"), "header")
_check("ffr_by_machine", _ratio("ffr", "'PASS'"), "header")
_check(
    "yields_one_pass",
    """
    SELECT machine_id, pcb_side,
           round(avg(CASE WHEN pcb_result IN ('GOOD', 'PASS') THEN 1.0::DOUBLE ELSE 0 END), 6) AS fpy_result,
           round(avg(CASE WHEN pcb_result = 'PASS' THEN 1.0::DOUBLE ELSE 0 END), 6) AS ffr_result
    FROM header WHERE pcb_result IN ('GOOD', 'PASS', 'FAIL') GROUP BY ALL""",
    "header",
)

_OLD_INTERVAL = """
    CAST(floor(epoch({0}) - extract(minute FROM {0}) * 60
         + 60 * CASE WHEN extract(minute FROM {0}) BETWEEN 16 AND 30 THEN 15
                     WHEN extract(minute FROM {0}) BETWEEN 31 AND 45 THEN 30 ELSE 45 END) AS BIGINT) * 1000"""

_check(
    "fpy_compat_fanout",
    f"""
    SELECT b.*, {_OLD_INTERVAL.format('max_inspection_end_time')} AS interval_id,
           round(coalesce(r.ratio, 0), 6) AS fpy_result
    FROM ({_BOARDS}) b LEFT JOIN (
        SELECT a.machine_id, g.n * 1.0::DOUBLE / a.n AS ratio
        FROM (SELECT machine_id, pcb_side, count(*) AS n FROM header
              WHERE pcb_result IN ('GOOD', 'PASS', 'FAIL') GROUP BY ALL) a
        JOIN (SELECT machine_id, pcb_side, count(*) AS n FROM header
              WHERE pcb_result IN ('GOOD', 'PASS') GROUP BY ALL) g
          ON a.machine_id IS NOT DISTINCT FROM g.machine_id
    ) r ON b.machine_id = r.machine_id""",
    "header",
)
_check(
    "volume_by_machine",
    f"""
    , j AS (SELECT h.*, volume FROM detail d JOIN header h USING (generated_key))
    SELECT u.machine_id, u.pcb_side, k.generated_key, k.pcb_name,
           round(coalesce(volume_result, 0), 6) AS volume_result,
           min_inspection_end_time, max_inspection_end_time,
           {QUARTER.format('max_inspection_end_time')} AS interval_id,
           concat(u.machine_id, '-', u.pcb_side) AS "machineId_side"
    FROM (SELECT machine_id, pcb_side, avg(volume) AS volume_result,
                 min(inspection_end) AS min_inspection_end_time,
                 max(inspection_end) AS max_inspection_end_time
          FROM j GROUP BY machine_id, pcb_side) u
    JOIN (SELECT DISTINCT machine_id, pcb_side, generated_key, pcb_name FROM j) k
      USING (machine_id, pcb_side)""",
    "header",
    "detail",
)
_check(
    "interval_yield",
    f"""
    SELECT machine_id, pcb_side, {QUARTER.format('max_inspection_end_time')} AS interval_id,
           count(*) AS boards,
           round(avg(CASE WHEN result < 0.06 THEN 1.0::DOUBLE ELSE 0 END), 6) AS fpy_result,
           round(avg(CASE WHEN result >= 0.02 AND result < 0.06 THEN 1.0::DOUBLE ELSE 0 END), 6) AS ffr_result
    FROM kpi_points GROUP BY ALL""",
    "kpi_points",
)
_check(
    "interval_15min",
    f"""
    SELECT {QUARTER.format('max_inspection_end_time')} AS interval_id, count(*) AS points,
           round(max(result), 6) AS top
    FROM kpi_points GROUP BY ALL""",
    "kpi_points",
)
_check(
    "interval_compat",
    f"""
    SELECT generated_key,
           {_OLD_INTERVAL.format("date_trunc('second', max_inspection_end_time)")} AS interval_id
    FROM kpi_points""",
    "kpi_points",
)
_check(
    "distinct_machines",
    f'SELECT DISTINCT machine_id, pcb_side, {SIDE} AS "machineId_side" FROM header',
    "header",
)
_check(
    "kpi_routing",
    f"""
    SELECT kpi, machine_id, pcb_side, count(*) AS row_count, round(max(result), 6) AS result
    FROM (SELECT 'fpy' AS kpi, machine_id, pcb_side, fpy_result AS result
          FROM ({_ratio('fpy', "'GOOD', 'PASS'")})
          UNION ALL
          SELECT 'ffr', machine_id, pcb_side, ffr_result FROM ({_ratio('ffr', "'PASS'")}))
    GROUP BY ALL""",
    "header",
)

# --- control limits -------------------------------------------------------------------


def _xmr(source: str, group: str, order: str) -> str:
    return f"""
    SELECT {group},
           CASE WHEN n > 1 THEN least(100.0::DOUBLE, (mean + 2.66 * mr) * 100) END AS ucl,
           CASE WHEN n > 1 THEN greatest(0.0::DOUBLE, (mean - 2.66 * mr) * 100) END AS lcl, mean
    FROM (SELECT {group}, count(*) AS n, avg(result) AS mean, avg(step) AS mr
          FROM (SELECT {group}, result,
                       abs(result - lag(result) OVER (PARTITION BY {group} ORDER BY {order})) AS step
                FROM {source}) GROUP BY {group})"""


_check(
    "xmr_limits",
    f"""
    SELECT machine_id, pcb_side, round(ucl, 6) AS ucl, round(lcl, 6) AS lcl, round(mean, 6) AS mean
    FROM ({_xmr('kpi_points', 'machine_id, pcb_side', 'max_inspection_end_time, generated_key')})""",
    "kpi_points",
)
CHECKS["xmr_by_user"] = f"""
    WITH points AS (SELECT user_id, event_type, ts, event_id, value / 1000 AS result FROM events)
    SELECT user_id, event_type, round(ucl, 6) AS ucl, round(lcl, 6) AS lcl, round(mean, 6) AS mean
    FROM ({_xmr('points', 'user_id, event_type', 'ts, event_id')})"""

_RECENT = "date_trunc('second', bicoe_load_dttm) > TIMESTAMP '2024-01-29 00:00:00'"
_STORES = {"fpy": "machine_id <> 'error'", "ffr": "machine_id <> 'view'", "volume": "1 = 1"}
_ORDER = "max_inspection_end_time, generated_key"


def _limits(distinct: bool, join: str) -> str:
    parts = []
    for kpi, keep in _STORES.items():
        points = f"SELECT * FROM kpi_store WHERE {keep} AND {_RECENT}"
        if distinct:
            points = f"""
            SELECT machine_id, pcb_side, interval_id, result,
                   max(max_inspection_end_time) AS max_inspection_end_time,
                   min(generated_key) AS generated_key
            FROM ({points}) GROUP BY machine_id, pcb_side, interval_id, result"""
        parts.append(f"{kpi} AS ({_xmr(f'({points})', 'machine_id, pcb_side', _ORDER)})")
    columns = ", ".join(
        f"round({kpi}.{c}, 6) AS {kpi}_{c}" for kpi in _STORES for c in ("ucl", "lcl", "mean")
    )
    if join == "inner":
        source = f"""(SELECT machine_id, pcb_side FROM fpy JOIN ffr USING (machine_id, pcb_side)
                      JOIN volume USING (machine_id, pcb_side)) k"""
    else:
        source = """(SELECT machine_id, pcb_side FROM fpy UNION SELECT machine_id, pcb_side FROM ffr
                     UNION SELECT machine_id, pcb_side FROM volume) k"""
    return f"""
    , {', '.join(parts)},
    k AS (SELECT * FROM {source}),
    m AS (SELECT DISTINCT machine_id, pcb_side, {SIDE} AS "machineId_side" FROM kpi_store)
    SELECT m.*, {columns}, TIMESTAMP '2024-01-30 00:00:00' AS kpi_limit_calculation_time
    FROM m LEFT JOIN k USING (machine_id, pcb_side)
    LEFT JOIN fpy ON fpy.machine_id = k.machine_id AND fpy.pcb_side = k.pcb_side
    LEFT JOIN ffr ON ffr.machine_id = k.machine_id AND ffr.pcb_side = k.pcb_side
    LEFT JOIN volume ON volume.machine_id = k.machine_id AND volume.pcb_side = k.pcb_side"""


_check("kpi_limits_all", _limits(True, "full"), "kpi_store")
_check("kpi_limits_compat", _limits(False, "inner"), "kpi_store")
_check(
    "kpi_listagg",
    """
    , p AS (SELECT machine_id, pcb_side, round(result, 5) AS result,
                   row_number() OVER (PARTITION BY machine_id, pcb_side
                                      ORDER BY max_inspection_end_time, generated_key) AS point_no
            FROM kpi_points)
    SELECT machine_id, pcb_side, CAST((point_no - 1) // 200 AS BIGINT) AS list_no, count(*) AS points,
           string_agg(CASE WHEN result > 0 AND result < 0.001
                           THEN concat(CAST(round(result * 100000) AS INT) // CASE WHEN result < 0.0001 THEN 1 ELSE 10 END,
                                       CASE WHEN result < 0.0001 THEN '.0' ELSE
                                            concat('.', CAST(round(result * 100000) AS INT) % 10) END,
                                       CASE WHEN result < 0.0001 THEN 'E-5' ELSE 'E-4' END)
                           ELSE CAST(result AS STRING) END, ',' ORDER BY point_no) AS datapoints,
           round(avg(result), 6) AS mean
    FROM p GROUP BY ALL""",
    "kpi_points",
)
_check(
    "last_24h",
    f"""
    SELECT machine_id, pcb_side, count(*) AS points, round(avg(result), 6) AS mean
    FROM kpi_store WHERE {_RECENT} GROUP BY ALL""",
    "kpi_store",
)

# --- scalar expressions ---------------------------------------------------------------

_SECOND = "SELECT event_id, date_trunc('second', ts) AS parsed FROM events"
CHECKS["ts_parse_12h"] = _SECOND
CHECKS["ts_parse_24h"] = _SECOND
CHECKS["ts_parse_iso"] = (
    "SELECT event_id, date_trunc('second', ts) AS parsed, date_trunc('second', ts) AS from_epoch "
    "FROM events"
)
_check(
    "ref_split",
    """
    SELECT substr(ref_id, 1, length(circuit) + 1) AS panel_circuit,
           substr(ref_id, length(circuit) + 2) AS ref_des, count(*) AS row_count
    FROM progorderlist_raw GROUP BY ALL""",
    "progorderlist_raw",
)
_check(
    "url_concat",
    f"""
    SELECT DISTINCT optel_schedule_wo,
           concat('{REPORT}?wo=', sap_wo, '&Location=', plant, '&Section=') AS wo_detail,
           concat(plant, '-', side) AS plant_side
    FROM wodetail_raw""",
    "wodetail_raw",
)
_P1 = "split_part(location, ',', 2)"
_P2 = "split_part(location, ',', 3)"
_CH = f"concat(CAST(CAST({_P1} AS INT) + 1 AS STRING), '-', CAST(CAST({_P2} AS INT) + 1 AS STRING))"
_check(
    "location_decode",
    f"""
    SELECT {_CH} AS ch_hole, concat({_P1}, '-', {_P2}) AS ch_hole_plain,
           concat(user_name, ' - ', {_CH}) AS mach_ch_hole,
           CAST(CAST({_P1} AS INT) + 1 AS STRING) AS track,
           concat(CAST(tooltype AS STRING), '.', CAST(CAST({_P2} AS INT) + 1 AS STRING)) AS slot,
           split_part(xml_tag_name, '-', 3) AS tag_location, count(*) AS row_count
    FROM nozzle_events GROUP BY ALL""",
    "nozzle_events",
)
_WC_SIDE = """CASE WHEN placing_wc_code LIKE '%\\_TOP\\_%' ESCAPE '\\' THEN 'Top'
                   WHEN placing_wc_code LIKE '%\\_BOT\\_%' ESCAPE '\\' THEN 'Bottom' ELSE '' END"""
_WC_MACHINE = "split_part(placing_wc_code, '_', -1)"
_check(
    "workcentre_decode",
    f"""
    SELECT {_WC_SIDE} AS side, {_WC_MACHINE} AS machine, count(*) AS row_count
    FROM defect_events GROUP BY ALL""",
    "defect_events",
)
_check(
    "typed_convert",
    """
    , c AS (
        SELECT word, TRY_CAST(txt AS DOUBLE) AS number,
               CASE WHEN word IN ('Int', 'int64') THEN regexp_full_match(txt, '[0-9]+')
                    WHEN word IN ('Decimal', 'Float', 'double') THEN TRY_CAST(txt AS DOUBLE) IS NOT NULL
                    WHEN word = 'Boolean' THEN lower(txt) IN ('true', 'false') ELSE true END AS ok
        FROM words)
    SELECT word, ok, count(*) AS row_count, count(number) AS numbers, round(sum(number), 2) AS total,
           count(*) FILTER (WHERE NOT ok) AS empty
    FROM c GROUP BY word, ok""",
    "words",
)
_COST = "SELECT regexp_replace(material, '^0+', '') AS material, plant, unit_cost FROM material_cost_raw"
_check("material_cost", _COST, "material_cost_raw")
_check(
    "location_plant",
    """
    , xref(location, plant) AS (VALUES ('twb', '1020'), ('meq', '1020'), ('sng', '5170'), ('mmc', '1150'))
    SELECT location, plant, count(*) AS row_count
    FROM tagged JOIN xref ON split_part(xml_tag_name, '-', 3) = location GROUP BY ALL""",
    "tagged",
)

# --- master data ----------------------------------------------------------------------


def _one(source: str, keys: str, others: str, way: str = "DESC") -> str:
    order = ", ".join(f"{c.strip()} {way}" for c in f"version, {others}".split(",") if c.strip())
    return f"""SELECT * EXCLUDE (row_num) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS row_num FROM {source})
        WHERE row_num = 1"""


_EVENTS = "(SELECT user_id, event_type, ts AS version, event_id, value FROM events)"
CHECKS["latest_version"] = _one(_EVENTS, "user_id, event_type", "event_id, value")
CHECKS["first_version"] = _one(_EVENTS, "user_id, event_type", "event_id, value", "ASC")

_WO_URL = f"concat('{REPORT}?wo=', sap_wo, '&Location=', plant, '&Section=') AS wo_detail"
_VERSIONS = {
    "equipment": """SELECT machine_name, equipment_make, equipment_model, equipment_type, head_1,
        head_2, plant, hdfs_file_name AS version FROM equipment_raw""",
    "info": """SELECT crc_id, name, description, plant_code, machine, hdfs_file_name AS version
        FROM info_raw""",
    "wodetail": f"""SELECT optel_schedule_wo, sap_wo, side, assembly, plant, setup, {_WO_URL},
        hdfs_file_name AS version FROM wodetail_raw""",
    "progorderlist": """SELECT machine, plant, work_order, ref_id, silkscreen, circuit, head, spindle,
        concat(head, '-', spindle) AS head_spindle, substr(ref_id, length(circuit) + 2) AS ref_des,
        substr(ref_id, 1, length(circuit) + 1) AS "Pcircuit", hdfs_file_name AS version
        FROM progorderlist_raw""",
    "comptype": """SELECT plant, machine, part_number, head_type, pins, nozzle1, package,
        hdfs_file_name AS version FROM comptype_raw""",
}
_KEYS = {
    "equipment": ("machine_name, plant", "equipment_make, equipment_model, equipment_type, head_1, head_2"),
    "info": ("plant_code, machine, crc_id", "description, name"),
    "wodetail": ("plant, optel_schedule_wo", "assembly, sap_wo, setup, side, wo_detail"),
    "progorderlist": (
        "machine, plant, work_order, ref_des, silkscreen",
        '"Pcircuit", circuit, head, head_spindle, ref_id, spindle',
    ),
    "comptype": ("plant, machine, part_number, head_type", "nozzle1, package, pins"),
}


def _current(name: str, way: str = "DESC") -> str:
    return _one(f"({_VERSIONS[name]})", *_KEYS[name], way)


for _name in _VERSIONS:
    _check(f"lookup_{_name}", _current(_name), f"{_name}_raw")
_check("lookup_wodetail_first", _current("wodetail", "ASC"), "wodetail_raw")
_check("lookup_merge", _current("wodetail"), "wodetail_raw")
_check("lookup_merge_first", _current("comptype", "ASC"), "comptype_raw")
_check(
    "version_counts",
    f"SELECT version, count(*) AS row_count FROM ({_current('equipment')}) GROUP BY version",
    "equipment_raw",
)

# --- enrichment -----------------------------------------------------------------------


def _enriched(name: str, sql: str, *views: str) -> None:
    made = [v for v in _VERSIONS if f"{v}_now" in sql]
    current = "".join(f", {v}_now AS ({_current(v)})" for v in made)
    _check(name, current + sql, *views, *(f"{v}_raw" for v in made))


_WO = "d.optel_schedule_wo, d.sap_wo, d.side, d.assembly, d.wo_detail"
_WO_JOIN = "JOIN wodetail_now d ON split_part(a.product_id, '.', 1) = d.optel_schedule_wo"
_EQUIP = "JOIN equipment_now b ON a.user_name = b.equipment_make"
_XREF = """JOIN xref_raw k ON split_part(a.xml_tag_name, '-', 3) = lower(k.location)
           JOIN equipment_now b ON a.user_name = b.equipment_make AND k.plant = b.plant"""


def _nozzle(machines: str) -> str:
    return f"""
    SELECT a.xml_tag_name, a.product_id, a.date_time, a.user_name, a.location, a.tooltype, a.ul_picks,
           a.ul_placements, a.ul_comp_missing, a.ul_possible_missing, a.ul_rejects,
           split_part(a.product_id, '.', 1) AS split_plant_id, b.machine_name, b.plant,
           c.name AS tooltypenozzle, {_WO}, {_CH.replace('location', 'a.location')} AS nozzle_ch_hole,
           concat(b.machine_name, ' - ', {_CH.replace('location', 'a.location')}) AS nozzle_mach_ch_hole
    FROM nozzle_events a {machines}
    JOIN info_now c ON a.tooltype = c.crc_id AND c.machine = b.machine_name AND c.plant_code = b.plant
    {_WO_JOIN}"""


def _timers(machines: str) -> str:
    return f"""
    SELECT a.xml_tag_name, a.product_id, a.date_time, a.user_name, a.ul_production_time, a.ul_setup_time,
           a.ul_idle_time, a.ul_diagnostic_time, a.ul_waiting_for_operator,
           a.ul_waiting_for_interrupt_recovery, a.ul_waiting_for_board_in_workarea,
           split_part(a.product_id, '.', 1) AS split_plant_id, b.machine_name, b.plant, d.setup, {_WO}
    FROM timer_events a {machines} {_WO_JOIN}"""


_DEFECTS = f"""
    SELECT a.placing_plant_code, a.machine_name, a.order_no, a.side, a.fault_board_no, a.ref_designator,
           b.optel_schedule_wo, a.cmpnt_part_no, a.defect_date, a.defect_code, a.fail_type,
           a.assem_serial_no, a.defect_count, b.wo_detail, c.ref_id, c.head_spindle, c.head, c.spindle,
           concat('{UNIT}?Location=', a.placing_plant_code, '&SN=', a.assem_serial_no) AS sn_detail
    FROM (SELECT *, {_WC_SIDE} AS side, {_WC_MACHINE} AS machine_name FROM defect_events) a
    LEFT JOIN wodetail_now b
      ON a.placing_plant_code = b.plant AND a.order_no = b.sap_wo AND a.side = b.side
    LEFT JOIN progorderlist_now c
      ON a.placing_plant_code = c.plant AND a.machine_name = c.machine
     AND b.optel_schedule_wo = c.work_order AND a.fault_board_no = c.silkscreen
     AND a.ref_designator = c.ref_des"""
_SLOT = f"""
    SELECT b.plant, b.machine_name, d.sap_wo, d.side, a.component_name, d.optel_schedule_wo, d.assembly,
           d.wo_detail, a.product_id, a.date_time, c.pins, c.nozzle1, c.package, a.slot_number,
           CAST(CAST({_P1.replace('location', 'a.location')} AS INT) + 1 AS STRING) AS track,
           a.ul_possible_missing, a.ul_slot_picks, a.ul_slot_placements, a.ul_slot_vision_failures,
           coalesce(e.unit_cost, 0.20::DOUBLE) AS unit_cost,
           concat(CAST(a.slot_number AS STRING), '.',
                  CAST(CAST({_P2.replace('location', 'a.location')} AS INT) + 1 AS STRING)) AS slot
    FROM slot_events a {_EQUIP}
    JOIN comptype_now c ON b.machine_name = c.machine AND b.plant = c.plant
                       AND b.head_1 = c.head_type AND a.component_name = c.part_number
    {_WO_JOIN}
    LEFT JOIN ({_COST}) e ON b.plant = e.plant AND a.component_name = e.material"""

_enriched("nozzle_enriched", _nozzle(_EQUIP), "nozzle_events")
_enriched("nozzle_enriched_xref", _nozzle(_XREF), "nozzle_events", "xref_raw")
_enriched("timers_enriched", _timers(_EQUIP), "timer_events")
_enriched("timers_enriched_xref", _timers(_XREF), "timer_events", "xref_raw")
_enriched("defects_enriched", _DEFECTS, "defect_events")
_enriched("slot_enriched", _SLOT, "slot_events", "material_cost_raw")

_V1 = f"""
    SELECT concat({_P1}, '-', {_P2}) AS ch_hole, a.date_time,
           CASE WHEN b.machine_name IS NOT NULL
                THEN concat(b.machine_name, '-', {_P1}, '-', {_P2}) END AS mach_ch_hole,
           b.machine_name, CAST(a.ul_comp_missing AS DOUBLE) AS ulcompmissing,
           CAST(a.ul_picks AS DOUBLE) AS ulpicks, CAST(a.ul_placements AS DOUBLE) AS ulplacements,
           CAST(a.ul_possible_missing AS DOUBLE) AS ulpossiblemissing,
           CAST(a.ul_rejects AS DOUBLE) AS ulrejects
    FROM nozzle_events a
    LEFT JOIN (SELECT * FROM equipment_now WHERE head_1 IN ('H0', 'H2')) b
      ON a.user_name = b.equipment_make"""
_enriched("nozzle_v1", _V1, "nozzle_events")
_enriched(
    "comma_join",
    """
    SELECT b.machine_name, a.date_time, a.location, a.ul_comp_missing, a.ul_picks, a.ul_placements,
           a.ul_possible_missing, a.ul_rejects
    FROM equipment_now b, nozzle_events a WHERE b.equipment_make = a.user_name""",
    "nozzle_events",
)
_check(
    "limited_newest",
    """
    SELECT date_time, product_id, user_name, ul_idle_time FROM timer_events
    ORDER BY date_time DESC, product_id, user_name, ul_idle_time LIMIT 100""",
    "timer_events",
)

_WIDE_PARTS = f"""
    SELECT 'nozzle' AS table_name, machine_name, product_id, optel_schedule_wo, date_time, plant, sap_wo,
           side, assembly, wo_detail, nozzle_ch_hole, nozzle_mach_ch_hole, tooltypenozzle,
           ul_picks AS picks, ul_placements AS placements, ul_possible_missing AS possible_missing,
           ul_rejects AS rejects, ul_comp_missing AS comp_missing
    FROM ({_nozzle(_EQUIP)})
    UNION ALL BY NAME
    SELECT 'timers' AS table_name, machine_name, product_id, optel_schedule_wo, date_time, plant, sap_wo,
           side, assembly, wo_detail, setup, ul_diagnostic_time AS timer_diagnostic_time,
           ul_setup_time AS timer_setup_time, ul_waiting_for_operator AS timer_waiting_for_operator,
           ul_waiting_for_board_in_workarea AS timer_waiting_for_board_workarea,
           ul_waiting_for_interrupt_recovery AS timer_waiting_for_interrupt_recovery,
           ul_idle_time AS timer_idle_time, ul_production_time AS timer_production_time
    FROM ({_timers(_EQUIP)})
    UNION ALL BY NAME
    SELECT 'defects' AS table_name, machine_name, optel_schedule_wo, defect_date AS date_time,
           placing_plant_code AS plant, order_no AS sap_wo, side, assem_serial_no AS assembly, wo_detail,
           sn_detail, ref_id AS defect_refid, head_spindle AS defect_head_spindle, head AS defect_head,
           spindle AS defect_spindle, cmpnt_part_no AS component_name, defect_code,
           fail_type AS defect_fail_type, defect_count
    FROM ({_DEFECTS})
    UNION ALL BY NAME
    SELECT 'slot' AS table_name, machine_name, product_id, optel_schedule_wo, date_time, plant, sap_wo,
           side, assembly, wo_detail, component_name, slot, nozzle1 AS slot_nozzle1,
           package AS slot_package, slot_number, track AS slot_track,
           ul_slot_vision_failures AS slot_vision_failures, ul_slot_picks AS picks,
           ul_slot_placements AS placements, ul_possible_missing AS possible_missing,
           pins AS slot_pins, unit_cost
    FROM ({_SLOT})"""
_NUMBERS = """defect_count setup timer_diagnostic_time timer_setup_time timer_waiting_for_operator
    timer_waiting_for_board_workarea timer_waiting_for_interrupt_recovery timer_idle_time
    timer_production_time slot_vision_failures picks placements possible_missing rejects comp_missing
    slot_pins unit_cost""".split()
_WIDE_VIEWS = ("nozzle_events", "timer_events", "defect_events", "slot_events", "material_cost_raw")
_CASTS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS)
_WIDE = f"""
    SELECT * REPLACE (strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time,
                      CAST(slot_number AS STRING) AS slot_number, {_CASTS})
    FROM ({_WIDE_PARTS})"""
_enriched("wide_events", _WIDE, *_WIDE_VIEWS)
_enriched(
    "wide_event_json",
    f"""
    SELECT table_name, 43 AS full_keys,
           CASE table_name WHEN 'nozzle' THEN 18 WHEN 'timers' THEN 18 WHEN 'slot' THEN 22
                ELSE 12 + (CASE WHEN optel_schedule_wo IS NULL THEN 0 ELSE 2 END)
                        + (CASE WHEN defect_refid IS NULL THEN 0 ELSE 4 END) END AS sparse_keys,
           count(*) AS row_count
    FROM ({_WIDE}) GROUP BY ALL""",
    *_WIDE_VIEWS,
)

# --- messages, routes, landing ----------------------------------------------------------

CHECKS["xml_roundtrip"] = """
    WITH o AS (SELECT *, CAST(o_orderkey AS STRING) AS k, CAST(o_custkey AS STRING) AS c FROM orders)
    SELECT 'c1-smt-sng-spiTest-header' AS xml_tag_name, concat('f', c, '.txt') AS file_name,
           c AS xml_tag_id, 't1' AS file_timestamp, '2024-01-01T00:00:00.000Z' AS bicoe_load_dttm,
           k AS first_value, o_orderpriority AS third_value, 4 AS value_count, 0 AS bad_count FROM o
    UNION ALL
    SELECT 'c1-smt-sng-spiTest-detail', concat('f', c, '.txt'), '2', 't2', '2024-01-01T00:00:00.000Z',
           k, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING), 4, 0 FROM o
    UNION ALL
    SELECT 'c1-smt-sng-spiTest-detail', concat('f', c, '.txt'), '2', 't2', '2024-01-01T00:00:00.000Z',
           k, c, 4, 0 FROM o"""
_LINES = """
    SELECT CAST(o_orderkey AS STRING) AS generated_key, 1 AS module_nbr, 'R1' AS ref_designator,
           CASE WHEN o_totalprice < 100000 THEN CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) END
             AS solder_paste_volume FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS STRING), 2, 'R2', CASE WHEN o_custkey < 100000 THEN CAST(o_custkey AS DOUBLE) END
    FROM orders"""
CHECKS["xml_landed_detail"] = f"""
    SELECT *, CAST(NULL AS STRING) AS pad_result, TIMESTAMP '2024-01-01 00:00:00' AS bicoe_load_dttm
    FROM ({_LINES})"""
CHECKS["xml_landed_header"] = """
    SELECT CAST(o_orderkey AS STRING) AS generated_key, 'M1' AS machine_id, o_orderpriority AS pcb_result,
           o_orderdate AS inspection_end_dttm, CAST(NULL AS STRING) AS barcode
    FROM orders"""
CHECKS["record_json"] = f"SELECT *, '2' AS xml_tag_id FROM ({_LINES})"
CHECKS["xml_bad_rows"] = """
    SELECT reason, sum(n)::BIGINT AS row_count, sum(bad)::BIGINT AS bad_fields, sum(t)::BIGINT AS texts
    FROM (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'malformed_xml' WHEN 1 THEN 'bad_separator'
                      WHEN 2 THEN 'bad_fields' WHEN 3 THEN 'bad_fields' ELSE 'good' END AS reason,
                 CASE o_orderkey % 6 WHEN 4 THEN 2 ELSE 1 END AS n,
                 CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 0 END AS bad,
                 CASE o_orderkey % 6 WHEN 4 THEN 2 ELSE 1 END AS t FROM orders)
    GROUP BY reason"""
_check(
    "json_landed_timers",
    """
    SELECT xml_tag_name, product_id, date_time, user_name, ul_production_time, ul_idle_time,
           ul_waiting_for_board_in_workarea, CAST(NULL AS INT) AS ul_setup_time
    FROM timer_events""",
    "timer_events",
)


def _first_route(column: str, tables=tuple(ROUTES)) -> str:
    arms = " ".join(f"WHEN contains({column}, '{ROUTES[t]}') THEN '{t}'" for t in tables)
    return f"CASE {arms} END"


_check(
    "routed_counts",
    f"SELECT {_first_route('xml_tag_name')} AS record_type, count(*) AS row_count FROM tagged GROUP BY ALL",
    "tagged",
)
_check(
    "routed_by_topic",
    f"""
    SELECT {_first_route('xml_tag_name', ('ea_pap_timers', 'ea_pap_slot', 'ea_pap_nozzle', 'ea_pap_gen', 'ea_pap_info'))}
             AS record_type, count(*) AS row_count
    FROM tagged GROUP BY ALL""",
    "tagged",
)
_MATCHES = " UNION ALL ".join(
    f"SELECT '{t}' AS record_type FROM w WHERE contains(whole, '{r}')" for t, r in ROUTES.items()
)
_NONE = " AND ".join(f"NOT contains(whole, '{r}')" for r in ROUTES.values())
_check(
    "routed_compat",
    f"""
    , w AS (SELECT concat(xml_tag_name, ' ', note) AS whole FROM tagged)
    SELECT record_type, count(*) AS row_count
    FROM ({_MATCHES} UNION ALL SELECT NULL FROM w WHERE {_NONE}) GROUP BY ALL""",
    "tagged",
)
_check(
    "tag_filter",
    """
    SELECT xml_tag_name, l_orderkey, l_linenumber, note FROM tagged
    WHERE contains(xml_tag_name, '-nozzle')""",
    "tagged",
)
_check(
    "unrouted",
    f"""
    SELECT xml_tag_name, count(*) AS row_count FROM tagged
    WHERE {_first_route('xml_tag_name')} IS NULL GROUP BY ALL""",
    "tagged",
)
_MASTER = ", ".join(f"'{s.name}'" for s in TABLES if s.master)
_check(
    "topic_routing",
    f"""
    , r AS (SELECT {_first_route('xml_tag_name')} AS record_type FROM tagged)
    SELECT layout, topic, count(*) AS row_count FROM (
        SELECT 'shared' AS layout,
               CASE WHEN record_type IN ({_MASTER}) THEN 'master' ELSE 'records' END AS topic
        FROM r WHERE record_type IS NOT NULL AND record_type <> 'ea_workorder'
        UNION ALL
        SELECT 'per_type', CASE WHEN record_type IN ({_MASTER}) THEN 'master' ELSE record_type END
        FROM r WHERE record_type IN ({_MASTER}, 'ea_pap_timers', 'ea_pap_slot', 'ea_pap_nozzle', 'ea_ftdefects'))
    GROUP BY ALL""",
    "tagged",
)
CHECKS["topic_fanout"] = """
    SELECT topic, concat('{"l_orderkey":', l_orderkey, ',"l_linenumber":', l_linenumber, '}') AS value,
           count(*) AS row_count
    FROM (SELECT 'alpha' AS topic, * FROM lineitem UNION ALL SELECT 'beta', * FROM lineitem)
    GROUP BY ALL"""

# --- sinks ------------------------------------------------------------------------------

CHECKS["payload_chunks"] = """
    WITH r AS (
        SELECT o_orderkey // 1250 AS bucket, o_orderkey,
               concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey, ',"o_orderpriority":"',
                      o_orderpriority, '"}') AS body,
               (row_number() OVER (PARTITION BY o_orderkey // 1250 ORDER BY o_orderkey) - 1) // 100 AS chunk
        FROM orders)
    SELECT 'orders' AS service, bucket, CAST(chunk AS BIGINT) AS chunk, count(*) AS row_count,
           concat('{"inputJson":[', string_agg(body, ',' ORDER BY o_orderkey), ']}') AS payload
    FROM r GROUP BY ALL"""
CHECKS["payload_sizes"] = """
    SELECT 'orders' AS service, count(*) AS row_count, false AS too_large, count(*) AS json_rows
    FROM orders"""
_check(
    "payload_tables",
    f"""
    SELECT 'ea_pap_timers_service' AS service, count(*) AS row_count FROM timer_events
    UNION ALL SELECT 'ea_wodetail_service', count(*) FROM ({_current('wodetail')})
    UNION ALL SELECT 'materialcost_service', count(*) FROM material_cost_raw""",
    "timer_events",
    "wodetail_raw",
    "material_cost_raw",
)
_enriched(
    "payload_nozzle_v1",
    f"""SELECT ch_hole, count(*) AS row_count, max(date_time) AS last_time
        FROM ({_V1}) GROUP BY ch_hole""",
    "nozzle_events",
)
_check(
    "partitioned_append",
    f"""
    SELECT machine_id, pcb_side, count(*) AS row_count, round(max(fpy_result), 6) AS result,
           min("machineId_side") AS machineid_side
    FROM ({_ratio('fpy', "'GOOD', 'PASS'")}) GROUP BY machine_id, pcb_side""",
    "header",
)
CHECKS["table_append"] = """
    SELECT n AS module_nbr, concat('R', n) AS ref_designator, count(*) * 2 AS row_count
    FROM (SELECT 1 AS n FROM orders UNION ALL SELECT 2 FROM orders) GROUP BY ALL"""
CHECKS["archive_roundtrip"] = "SELECT c_name FROM customer"

# --- reports ----------------------------------------------------------------------------

CHECKS["row_count_report"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
)
CHECKS["freshness_report"] = """
    SELECT 'orders' AS table_name, max(o_orderdate) AS last_updated FROM orders
    UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    UNION ALL SELECT 'events', max(ts) FROM events"""
CHECKS["file_freshness_report"] = """
    SELECT 'orders' AS table_name, count(*) > 0 AS known FROM orders
    UNION ALL SELECT 'lineitem', count(*) > 0 FROM lineitem"""
CHECKS["newest_event"] = "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 10"
CHECKS["offset_progress"] = """
    SELECT topic, sum(o)::BIGINT AS messages
    FROM (SELECT event_type AS topic, user_id % 4 AS p, max(event_id) AS o FROM events GROUP BY ALL)
    GROUP BY topic"""

# --- streams ----------------------------------------------------------------------------

CHECKS["stream_latest"] = CHECKS["latest_version"]
_check(
    "stream_kpi",
    """
    SELECT machine_id, pcb_side, round(avg(volume), 6) AS volume_result,
           min(inspection_end) AS min_inspection_end_time, max(inspection_end) AS max_inspection_end_time
    FROM detail JOIN header USING (generated_key) GROUP BY machine_id, pcb_side""",
    "header",
    "detail",
)
_SPAN = "(CASE WHEN {0} < TIMESTAMP '1997-01-01' THEN 0 WHEN {0} < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END)"


def _stream_limits() -> str:
    """Ratios of the boards of a batch; means of the pads joined in one, with their unit's last time."""
    parts = {
        kpi: f"""
        SELECT machine_id, pcb_side, generated_key, inspection_end,
               coalesce(count(*) FILTER (WHERE pcb_result IN ({good})) OVER w * 1.0::DOUBLE
                        / nullif(count(*) FILTER (WHERE pcb_result IN ('GOOD', 'PASS', 'FAIL')) OVER w, 0),
                        0) AS result
        FROM header WINDOW w AS (PARTITION BY machine_id, pcb_side, {_SPAN.format('inspection_end')})"""
        for kpi, good in (("fpy", "'GOOD', 'PASS'"), ("ffr", "'PASS'"))
    }
    parts["volume"] = f"""
        SELECT machine_id, pcb_side, generated_key, max(inspection_end) OVER w AS inspection_end,
               sum(l_quantity) OVER w / count(l_quantity) OVER w AS result
        FROM header JOIN lineitem ON generated_key = CAST(l_orderkey AS STRING)
        WINDOW w AS (PARTITION BY machine_id, pcb_side,
                     greatest({_SPAN.format('inspection_end')}, {_SPAN.format('l_shipdate')}))"""
    made = []
    for kpi, rows in parts.items():
        points = f"""
            (SELECT machine_id, pcb_side, {QUARTER.format('inspection_end')} AS interval_id, result,
                    max(inspection_end) AS last_at, min(generated_key) AS generated_key
             FROM ({rows}) GROUP BY ALL)"""
        made.append(f"{kpi} AS ({_xmr(points, 'machine_id, pcb_side', 'last_at, generated_key, result')})")
    columns = ", ".join(
        f"round({kpi}.{c}, 6) AS {kpi}_{c}" for kpi in parts for c in ("ucl", "lcl", "mean")
    )
    return f"""
    , {', '.join(made)},
    m AS (SELECT DISTINCT machine_id, pcb_side, {SIDE} AS "machineId_side" FROM header)
    SELECT m.*, {columns}, TIMESTAMP '2024-01-30 00:00:00' AS kpi_limit_calculation_time
    FROM m LEFT JOIN fpy USING (machine_id, pcb_side) LEFT JOIN ffr USING (machine_id, pcb_side)
    LEFT JOIN volume USING (machine_id, pcb_side)"""


def _full_rows(name: str, spec, texts: dict[str, str]) -> str:
    """One landed row of a table for each order, as text."""
    values = [
        "CAST(o_orderkey AS VARCHAR)" if spec.kind(c) == "string" else f"'{texts[spec.kind(c)]}'"
        for c in spec.columns
    ]
    return f"SELECT '{name}' AS name, concat_ws('|', {', '.join(values)}) AS row_text FROM orders"


_TEXTS = {
    "int": "17",
    "bigint": "5000000000",
    "boolean": "true",
    "decimal(5,2)": "12.50",
    "decimal(10,5)": "7.25000",
    "timestamp": "2024-01-05 06:07:08",
}
CHECKS["xml_landed_all"] = f"""
    SELECT name AS table_name, row_text
    FROM ({' UNION ALL '.join(_full_rows(t.name, t, _TEXTS) for t in TABLES)})"""
_JSON_TEXTS = _TEXTS | {  # as read back, numbers are without trailing zeros
    "decimal(5,2)": "12.5",
    "decimal(10,5)": "7.25",
    "timestamp": "2024-01-05T06:07:08.000Z",
}
_PUSHED = " UNION ALL ".join(
    _full_rows(f"{t.name}_service", t, _JSON_TEXTS) for t in TABLES if t.name in SERVICES
)
CHECKS["stream_push"] = f"SELECT name AS service, true AS bounded, row_text FROM ({_PUSHED})"
_check(
    "payload_cost",
    f"""SELECT 'materialcost_service' AS service, material, plant,
               CAST(unit_cost AS DOUBLE) AS unit_cost FROM ({_COST})""",
    "material_cost_raw",
)
CHECKS["catalog_append"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS generated_key, 'M1' AS machine_id,
           o_orderpriority AS pcb_result, CAST(o_orderdate AS TIMESTAMP) AS inspection_end_dttm
    FROM orders"""
_check("stream_kpi_limits", _stream_limits(), "header")
_STREAM_WIDE = f"""
    SELECT * REPLACE (CASE WHEN table_name = 'timers' AND length(product_id) % 3 = 0
                           THEN '2024-01-30 00:00:00' ELSE date_time END AS date_time)
    FROM ({_WIDE})"""
_enriched("stream_wide", _STREAM_WIDE, *_WIDE_VIEWS)
_enriched(
    "stream_payloads",
    f"SELECT 'wide_service' AS service, true AS bounded, * FROM ({_STREAM_WIDE})",
    *_WIDE_VIEWS,
)
CHECKS["stream_ingest"] = """
    WITH m AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey % 6 ELSE -1 END AS c,
                      CAST(o_totalprice AS DECIMAL(12, 2)) >= 100000 AS big FROM orders)
    SELECT 'ea_spi_header' AS table_name, count(*) FILTER (WHERE c = -1) AS row_count FROM m
    UNION ALL SELECT 'ea_spi_detail', 2 * count(*) FILTER (WHERE c = -1) FROM m
    UNION ALL SELECT 'ea_units', count(*) FILTER (WHERE c = 2) + 2 * count(*) FILTER (WHERE c = 4) FROM m
    UNION ALL SELECT 'quarantine', count(*) FILTER (WHERE c IN (0, 2)) + count(*) FILTER (WHERE c = -1 AND big)
              FROM m
    UNION ALL SELECT 'records', 3 * count(*) FILTER (WHERE c = -1) + count(*) FILTER (WHERE c = 2)
                                + 2 * count(*) FILTER (WHERE c = 4) FROM m"""
_enriched(
    "stream_enriched",
    f"""
    SELECT 'timers' AS table_name, machine_name, product_id, plant, sap_wo, side, assembly, setup,
           CAST(ul_idle_time AS DOUBLE) AS timer_idle_time,
           CAST(ul_production_time AS DOUBLE) AS timer_production_time
    FROM ({_timers(_EQUIP)})""",
    "timer_events",
)

_TIMER_MESSAGES = """
    SELECT product_id, user_name, CAST(ul_idle_time AS BIGINT) AS idle,
           (length(product_id) + CAST(ul_idle_time AS BIGINT)) % 7 = 0 AS bad,
           (length(product_id) + CAST(ul_idle_time AS BIGINT)) % 9 = 0 AS other
    FROM timer_events"""
_LANDED_TIMERS = f"""
    SELECT product_id, user_name, CASE WHEN NOT bad THEN idle END AS ul_idle_time
    FROM ({_TIMER_MESSAGES}) WHERE NOT other"""
_check("stream_two_inlets", _LANDED_TIMERS, "timer_events")
_check("stream_reset", f"{_LANDED_TIMERS} UNION ALL {_LANDED_TIMERS}", "timer_events")
_check(
    "stream_quarantine",
    f"""
    SELECT CASE WHEN other THEN 'unrouted' ELSE 'bad_column' END AS reason,
           CASE WHEN other THEN '' ELSE 'ul_idle_time' END AS bad_columns,
           product_id, user_name, CASE WHEN bad THEN 'n/a' ELSE CAST(idle AS VARCHAR) END AS idle_text
    FROM ({_TIMER_MESSAGES}) WHERE other OR bad""",
    "timer_events",
)
CHECKS["stream_latest_after_reset"] = CHECKS["latest_version"]
