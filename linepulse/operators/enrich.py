"""Machine events joined with master data.

No side is broadcast by hint: Spark broadcasts a lookup whose size it knows to be below
its limit and otherwise joins by shuffle, where adaptive execution splits the partitions
of hot machines and work orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.functions import text, times
from linepulse.operators.lookups import VERSION
from linepulse.operators.skew import SALT, Salting

DEFAULT_COST = 0.20
UNIT_BASE = "https://reports.example/unit"


def _events(df: DataFrame, time: str, as_of) -> DataFrame:
    """Events with a default for a missing time."""
    if as_of is None:
        return df
    return df.withColumn(time, times.or_default(F.col(time), as_of))


def _with_order(df: DataFrame) -> DataFrame:
    return df.withColumn("split_plant_id", text.product_prefix(F.col("product_id")))


def _bare(lookup: DataFrame) -> DataFrame:
    return lookup.drop(VERSION)


def _equipment(
    events: DataFrame,
    equipment: DataFrame,
    xref: DataFrame | None,
    salting: Salting | None = None,
    tools: DataFrame | None = None,
) -> DataFrame:
    """Events with machine and plant; with a cross-reference the plant has to fit too.

    `salting` spreads the events of hot machines and repeats those machines. `tools` are those of the
    machines, which meet their machines first, so that the events, which are many more, are dealt once.
    """
    machines = _bare(equipment).select(
        "equipment_make", "machine_name", F.col("plant").alias("machine_plant"), "head_1"
    )
    match = F.col("user_name") == F.col("equipment_make")
    if tools is not None:
        here = (F.col("tool_machine") == F.col("machine_name")) & (F.col("tool_plant") == F.col("machine_plant"))
        machines = machines.join(tools, here)
        match = match & (F.col("tooltype") == F.col("crc_id"))
    if xref is not None:
        places = xref.select("location", "plant").select(
            F.col("location").alias("tag_location"), F.col("plant").alias("tag_plant")
        )
        here = text.tag_location(F.col("xml_tag_name"))
        events = events.join(places, here == F.col("tag_location"))
        match = match & (F.col("tag_plant") == F.col("machine_plant"))
    if salting is not None:
        events = salting.spread(events, "user_name")
        machines = salting.repeat(machines, "equipment_make").withColumnRenamed(SALT, "machine_salt")
        match = match & (F.col(SALT) == F.col("machine_salt"))
        return events.join(machines, match).drop(SALT, "machine_salt")
    return events.join(machines, match)


def _work_order(df: DataFrame, wodetail: DataFrame) -> DataFrame:
    orders = _bare(wodetail).drop("plant").withColumnRenamed("setup", "order_setup")
    return df.join(orders, F.col("split_plant_id") == F.col("optel_schedule_wo"))


def limited(df: DataFrame, limit: int | None, order: list[str] | None = None) -> DataFrame:
    """At most `limit` rows, the first ones in `order` (all columns when not given)."""
    if limit is None:
        return df
    return df.orderBy(*(order or df.columns)).limit(limit)


def nozzle(
    events: DataFrame,
    equipment: DataFrame,
    info: DataFrame,
    wodetail: DataFrame,
    xref: DataFrame | None = None,
    as_of=None,
    limit: int | None = None,
) -> DataFrame:
    tools = _bare(info).select(
        "crc_id",
        F.col("name").alias("tooltypenozzle"),
        F.col("machine").alias("tool_machine"),
        F.col("plant_code").alias("tool_plant"),
    )
    base = _with_order(_events(events, "date_time", as_of)).select(
        "xml_tag_name",
        "product_id",
        "date_time",
        "user_name",
        "location",
        "tooltype",
        "ul_picks",
        "ul_placements",
        "ul_comp_missing",
        "ul_possible_missing",
        "ul_rejects",
        "split_plant_id",
    )
    joined = _equipment(base, equipment, xref, tools=tools)
    place, machine = F.col("location"), F.col("machine_name")
    result = _work_order(joined, wodetail).select(
        *base.columns,
        "machine_name",
        F.col("machine_plant").alias("plant"),
        "tooltypenozzle",
        "optel_schedule_wo",
        "sap_wo",
        "side",
        "assembly",
        "wo_detail",
        text.changer_hole(place).alias("nozzle_ch_hole"),
        text.machine_changer_hole(machine, place).alias("nozzle_mach_ch_hole"),
    )
    return limited(result, limit)


def timers(
    events: DataFrame,
    equipment: DataFrame,
    wodetail: DataFrame,
    xref: DataFrame | None = None,
    as_of=None,
    limit: int | None = None,
    salting: Salting | None = None,
) -> DataFrame:
    base = _with_order(_events(events, "date_time", as_of)).select(
        "xml_tag_name",
        "product_id",
        "date_time",
        "user_name",
        "ul_production_time",
        "ul_setup_time",
        "ul_idle_time",
        "ul_diagnostic_time",
        "ul_waiting_for_operator",
        "ul_waiting_for_interrupt_recovery",
        "ul_waiting_for_board_in_workarea",
        "split_plant_id",
    )
    result = _work_order(_equipment(base, equipment, xref, salting), wodetail).select(
        *base.columns,
        "machine_name",
        F.col("machine_plant").alias("plant"),
        "optel_schedule_wo",
        F.col("order_setup").alias("setup"),
        "sap_wo",
        "side",
        "assembly",
        "wo_detail",
    )
    return limited(result, limit)


def defects(
    events: DataFrame,
    wodetail: DataFrame,
    progorderlist: DataFrame,
    unit_base: str = UNIT_BASE,
    as_of=None,
    limit: int | None = None,
) -> DataFrame:
    code = F.col("placing_wc_code")
    found = _events(events, "defect_date", as_of).withColumns(
        {"side": text.workcentre_side(code), "machine_name": text.workcentre_machine(code)}
    )
    orders = _bare(wodetail).select(
        F.col("plant").alias("order_plant"),
        F.col("sap_wo").alias("order_sap"),
        F.col("side").alias("order_side"),
        "optel_schedule_wo",
        "wo_detail",
    )
    placements = _bare(progorderlist).select(
        F.col("plant").alias("list_plant"),
        F.col("machine").alias("list_machine"),
        F.col("work_order").alias("list_order"),
        F.col("silkscreen").alias("list_silkscreen"),
        F.col("ref_des").alias("list_ref"),
        "ref_id",
        "head_spindle",
        "head",
        "spindle",
    )
    joined = found.join(
        orders,
        (F.col("order_no") == F.col("order_sap"))
        & (F.col("placing_plant_code") == F.col("order_plant"))
        & (F.col("side") == F.col("order_side")),
        "left",
    ).join(
        placements,
        (F.col("placing_plant_code") == F.col("list_plant"))
        & (F.col("machine_name") == F.col("list_machine"))
        & (F.col("optel_schedule_wo") == F.col("list_order"))
        & (F.col("fault_board_no") == F.col("list_silkscreen"))
        & (F.col("ref_designator") == F.col("list_ref")),
        "left",
    )
    unit = text.unit_url(unit_base, F.col("placing_plant_code"), F.col("assem_serial_no"))
    result = joined.select(
        "placing_plant_code",
        "machine_name",
        "order_no",
        "side",
        "fault_board_no",
        "ref_designator",
        "optel_schedule_wo",
        "cmpnt_part_no",
        "defect_date",
        "defect_code",
        "fail_type",
        "assem_serial_no",
        "defect_count",
        "wo_detail",
        "ref_id",
        "head_spindle",
        "head",
        "spindle",
        unit.alias("sn_detail"),
    )
    return limited(result, limit)


def slot(
    events: DataFrame,
    equipment: DataFrame,
    comptype: DataFrame,
    wodetail: DataFrame,
    cost: DataFrame | None = None,
    xref: DataFrame | None = None,
    as_of=None,
    limit: int | None = None,
) -> DataFrame:
    """Slot events; without a cost table every part has the default cost."""
    parts = _bare(comptype).select(
        F.col("machine").alias("part_machine"),
        F.col("plant").alias("part_plant"),
        F.col("head_type").alias("part_head"),
        "part_number",
        "pins",
        "nozzle1",
        "package",
    )
    joined = _equipment(_events(events, "date_time", as_of), equipment, xref).join(
        parts,
        (F.col("component_name") == F.col("part_number"))  # first, as it tells most rows apart in a sort
        & (F.col("machine_name") == F.col("part_machine"))
        & (F.col("machine_plant") == F.col("part_plant"))
        & (F.col("head_1") == F.col("part_head")),
    )
    unit_cost = F.lit(DEFAULT_COST)
    if cost is not None:
        prices = cost.select(
            F.col("plant").alias("cost_plant"), F.col("material").alias("cost_material"), "unit_cost"
        )
        joined = joined.join(
            prices,
            (F.col("component_name") == F.col("cost_material"))
            & (F.col("machine_plant") == F.col("cost_plant")),
            "left",
        )
        unit_cost = F.coalesce(F.col("unit_cost"), unit_cost)
    place = F.col("location")
    # last, as it makes the rows much wider; what it is joined on is not sent before
    result = _work_order(_with_order(joined), wodetail).select(
        F.col("machine_plant").alias("plant"),
        "machine_name",
        "sap_wo",
        "side",
        "component_name",
        "optel_schedule_wo",
        "assembly",
        "wo_detail",
        "product_id",
        "date_time",
        "pins",
        "nozzle1",
        "package",
        "slot_number",
        text.slot_track(place).alias("track"),
        "ul_possible_missing",
        "ul_slot_picks",
        "ul_slot_placements",
        "ul_slot_vision_failures",
        unit_cost.alias("unit_cost"),
        text.slot_label(F.col("slot_number"), place).alias("slot"),
    )
    return limited(result, limit)


def nozzle_by_equipment(events: DataFrame, equipment: DataFrame) -> DataFrame:
    """Nozzle events with their machine where there is one, locations as sent."""
    machines = _bare(equipment).select("machine_name", "equipment_make")
    place = F.col("location")
    return events.join(
        machines, F.col("user_name").eqNullSafe(F.col("equipment_make")), "left"
    ).select(
        text.changer_hole(place, shift=0).alias("ch_hole"),
        "date_time",
        text.machine_changer_hole(F.col("machine_name"), place, shift=0, sep="-").alias(
            "mach_ch_hole"
        ),
        "machine_name",
        *(
            F.col(c).cast("double").alias(c.replace("_", ""))
            for c in (
                "ul_comp_missing",
                "ul_picks",
                "ul_placements",
                "ul_possible_missing",
                "ul_rejects",
            )
        ),
    )


def machine_nozzles(events: DataFrame, equipment: DataFrame) -> DataFrame:
    """Nozzle counters of known machines."""
    machines = _bare(equipment).select("machine_name", "equipment_make")
    return events.join(machines, F.col("equipment_make") == F.col("user_name")).select(
        "machine_name",
        "date_time",
        "location",
        "ul_comp_missing",
        "ul_picks",
        "ul_placements",
        "ul_possible_missing",
        "ul_rejects",
    )
