"""The raw tables: routes, columns, types, business keys.

A table lists its payload columns. Types follow a rule (counters named ``ul_*`` are INT,
columns named like a time are TIMESTAMP, the rest is STRING) unless the table names
another type. The message field of a column is the field whose name is equal to the
column's when case, blanks and punctuation are left out; other fields are named in
``source``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from linepulse.functions.times import ISO, SPI_24H

# Lineage columns stored with every row, and the one that is not stored.
LINEAGE = (
    "xml_tag_name",
    "xml_status",
    "bicoe_load_dttm",
    "xml_tag_id",
    "file_name",
    "hdfs_file_name",
    "kafka_topic",
)
FILE_TIME = "file_timestamp"

AMOUNT = "decimal(10,5)"
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    AMOUNT: T.DecimalType(10, 5),
}
_TIME_NAME = re.compile(r"(_dttm|_date|date_time|time_?stamp)$")


@dataclass(frozen=True)
class TableSpec:
    name: str
    route: str
    columns: tuple[str, ...]
    kinds: dict[str, str] = field(default_factory=dict)
    source: dict[str, str] = field(default_factory=dict)
    time_format: str = ISO
    master: bool = False
    forwarded: bool = True

    def kind(self, column: str) -> str:
        if column in self.kinds:
            return self.kinds[column]
        if _TIME_NAME.search(column):
            return "timestamp"
        return "int" if column.startswith("ul_") else "string"

    def field_key(self, column: str) -> str:
        """Key of the message field (see ``text.keys_of``) that fills `column`."""
        return re.sub("[^A-Za-z0-9]", "", self.source.get(column, column)).lower()

    @property
    def schema(self) -> T.StructType:
        kinds = {c: "timestamp" if c == "bicoe_load_dttm" else "string" for c in LINEAGE}
        kinds.update({c: self.kind(c) for c in self.columns})
        return T.StructType([T.StructField(c, _TYPES[k]) for c, k in kinds.items()])


def _table(name: str, route: str, columns: str, **options) -> TableSpec:
    return TableSpec(name, route, tuple(columns.split()), **options)


def _each(kind: str, columns: str) -> dict[str, str]:
    return dict.fromkeys(columns.split(), kind)


# Route substrings, columns and types of the raw tables, in routing order.
TABLES = (
    _table(
        "ea_spi_header",
        "spiTest-header",
        "barcode side pcb_id inspection_start_dttm inspection_end_dttm "
        "inspection_test_duration_sec pcb_name pcb_result print_stroke machine_id generated_key",
        kinds={"inspection_test_duration_sec": "decimal(5,2)"},
        source={
            "inspection_start_dttm": "InspectionStartTime",
            "inspection_end_dttm": "InspectionEndTime",
            "inspection_test_duration_sec": "InspectionTestTime",
        },
        time_format=SPI_24H,
    ),
    _table(
        "ea_spi_detail",
        "spiTest-detail",
        "generated_key module_nbr ref_designator pin_nbr size_x size_y pad_stencil_height "
        "pad_result pad_defect_type solder_paste_volume solder_paste_height solder_paste_area "
        "offset_X offset_Y",
        kinds={
            **_each("int", "module_nbr size_x size_y"),
            "pad_stencil_height": "decimal(5,2)",
            **_each(
                AMOUNT,
                "solder_paste_volume solder_paste_height solder_paste_area offset_X offset_Y",
            ),
        },
        source={
            "module_nbr": "ModuleNo",
            "pin_nbr": "PinNumber",
            "solder_paste_volume": "Volume",
            "solder_paste_height": "Height",
            "solder_paste_area": "Area",
        },
    ),
    _table(
        "ea_pap_timers",
        "-timers",
        "product_id date_time user_name ul_production_time ul_setup_time ul_idle_time "
        "ul_diagnostic_time ul_waiting_for_operator ul_waiting_for_board_input "
        "ul_waiting_for_board_output ul_waiting_for_interrupt_recovery "
        "ul_waiting_for_board_in_workarea ul_waiting_for_brd_from_upline "
        "ul_waiting_for_downline_available",
    ),
    _table(
        "ea_pap_slot",
        "-slot",
        "product_id date_time user_name component_name feeder_name feeder_type slot_number "
        "location ul_comp_missing ul_comp_upside_down ul_lead_location_failure "
        "ul_lead_spacing_failure ul_lead_deviation_failure ul_leadspan_failure "
        "ul_comp_location_failure ul_comp_size_failure ul_feature_location_failure "
        "ul_feature_spacing_failure ul_pitch_failure ul_orientation_check_failure "
        "ul_lead_count_failure ul_ball_count_failure ul_feature_count_failure "
        "ul_corner_tolerance_failure ul_vps_height_failure ul_slot_picks ul_slot_placements "
        "ul_slot_vision_failures ul_possible_missing ul_purged ul_vps_part_presence_failure "
        "ul_smart_feeder_picked ul_slot_rejects",
        kinds=_each("int", "feeder_type slot_number"),
    ),
    _table(
        "ea_pap_info",
        "-info",
        "name is_keyed crc_id description shape notes plant_code machine",
        kinds={"is_keyed": "boolean", "crc_id": "int", "shape": "int"},
        master=True,
    ),
    _table(
        "ea_pap_gen",
        "-gen",
        "product_id date_time user_name ul_fid_find_attempts ul_fid_find_failures "
        "ul_boards_entering ul_boards_exiting ul_tot_bad_board_sense_accepted "
        "ul_tot_bad_board_sense_rejected ul_tot_bad_circuit_sense_accepted "
        "ul_tot_bad_circuit_sense_rejected ul_tot_board_cycle_time ul_best_board_cycle_time "
        "ul_board_cycle_count ul_possible_missing",
    ),
    _table(
        "ea_pap_nozzle",
        "-nozzle",
        "product_id date_time user_name location tooltype ul_picks ul_placements "
        "ul_comp_missing ul_comp_up_side_down ul_lead_location_failure ul_lead_spacing_failure "
        "ul_lead_deviation_failure ul_lead_span_failure ul_comp_location_failure "
        "ul_compsize_failure ul_feature_location_failure ul_feature_spacing_failure "
        "ul_pitch_failure ul_orientation_check_failure ul_lead_count_failure "
        "ul_ball_count_failure ul_feature_count_failure ul_possible_missing ul_rejects "
        "ul_purged ul_corner_tolerance_failure ul_vps_height_failure "
        "ul_vps_part_presence_failure",
        kinds={"tooltype": "int"},
    ),
    _table(
        "ea_progorderlist",
        "-proglist",
        "plant machine work_order assembly revision side part_number slot head spindle ref_id "
        "time_stamp circuit silkscreen",
        kinds={"silkscreen": "bigint"},
        master=True,
    ),
    _table(
        "ea_ftdefects",
        "-defects",
        "defect_date placing_plant_code placing_area_code placing_process_code "
        "placing_wc_code finding_plant_code finding_area_code finding_process_code "
        "finding_wc_code build_part_no build_part_desc build_serial_no assem_part_no "
        "assem_part_desc assem_serial_no order_no defect_code failed_test_code fail_type "
        "fault_board_no cmpnt_part_no cmpnt_part_desc ref_designator defect_count repair_date",
        kinds={"fault_board_no": "int", "defect_count": AMOUNT},
    ),
    _table(
        "ea_assydetail",
        "-assy",
        "plant assembly rev side pcb family family_description side_glue circuits_quantity "
        "pcb_length pcb_width placement_panel flat_program stencil_name thickness",
        kinds=_each(
            AMOUNT, "family circuits_quantity pcb_length pcb_width placement_panel thickness"
        ),
    ),
    _table("ea_units", "-units", "serial_no panel_no module_no order_no"),
    _table(
        "ea_wodetail",
        "-wodetail",
        "plant optel_schedule_wo sap_wo assembly assembly_rev build build_rev order_qty "
        "panel_qty side setup golden pipplc_panel pippad_panel smtplc_panel smtpad_panel line",
        kinds={
            "order_qty": "int",
            **_each(
                AMOUNT, "panel_qty setup pipplc_panel pippad_panel smtplc_panel smtpad_panel"
            ),
        },
        master=True,
    ),
    _table(
        "ea_assycircuitsilk",
        "-circuit",
        "plant assembly revision side circuit silkscreen",
        kinds=_each("int", "circuit silkscreen"),
    ),
    _table(
        "ea_workorder",
        "-orders",
        "order_number part_number part_revision description plant_code order_type "
        "prod_scheduler release_date bom_date planned_route",
        forwarded=False,
    ),
    _table(
        "ea_parentchild",
        "-parentchild",
        "parent_serial_no child_serial_number child_finish_date consumption_date",
    ),
    _table(
        "ea_comptype",
        "-comptype",
        "plant machine part_number package feedertype head_type nozzle1 nozzle2 pressure "
        "accuracy preorient apu pick motion center place lpid pins max_of_inv comp_height "
        "comp_length comp_width body_length body_width type",
        kinds=_each(
            AMOUNT,
            "pressure lpid pins max_of_inv comp_height comp_length comp_width body_length "
            "body_width",
        ),
        master=True,
    ),
    _table(
        "ea_equipmentoutline",
        "-machine",
        "plant equipment_make machine_name line head_1 head_2 timestamp equipment_model "
        "equipment_type position",
        kinds={"position": AMOUNT},
        master=True,
    ),
)

SPECS = {spec.name: spec for spec in TABLES}
ROUTES = {spec.name: spec.route for spec in TABLES}

# Where each plant location belongs.
LOCATION_PLANT = (("twb", "1020"), ("meq", "1020"), ("sng", "5170"), ("mmc", "1150"))
XREF_SCHEMA = "location string, plant string"

# Columns of the KPI store, partition columns last.
KPI_COLUMNS = (
    "generated_key",
    "interval_id",
    "pcb_name",
    "result",
    "min_inspection_end_time",
    "max_inspection_end_time",
    "machineid_side",
    "bicoe_load_dttm",
    "machine_id",
    "pcb_side",
)
KPI_PARTITIONS = ("machine_id", "pcb_side")
KPI_TABLES = {"fpy": "ea_spi_fpy", "ffr": "ea_spi_ffr", "volume": "ea_spi_volume"}
KPI_SCHEMA = (
    "generated_key string, interval_id bigint, pcb_name string, result double, "
    "min_inspection_end_time timestamp, max_inspection_end_time timestamp, "
    "machineid_side string, bicoe_load_dttm timestamp, machine_id string, pcb_side string"
)

# Environment prefixes of the databases.
ENVIRONMENTS = ("d_", "q_", "p_")
DATABASE = "elec_assy"


def full_name(env: str, table: str, database: str = DATABASE) -> str:
    """Table name in the database of an environment."""
    if env not in ENVIRONMENTS and env != "":
        raise ValueError(f"unknown environment prefix {env!r}")
    return f"{env}{database}.{table}"


def table_ddl(spec: TableSpec, env: str = "", location: str | None = None) -> str:
    """CREATE TABLE statement of a raw table, stored as parquet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    where = f" LOCATION '{location}/{spec.name}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {full_name(env, spec.name)} ({columns}) USING parquet{where}"
