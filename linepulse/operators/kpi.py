"""Yield and paste-volume indicators per machine and board side.

Inputs are inspections (``generated_key, machine_id, pcb_side, pcb_name, pcb_result,
inspection_end``) and pads (``generated_key, volume``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import text, times
from linepulse.registry import KPI_COLUMNS

# Results that count, and those that count as good for each ratio.
COUNTED = ("GOOD", "PASS", "FAIL")
GOOD = {"fpy": ("GOOD", "PASS"), "ffr": ("PASS",)}

_UNIT = ["machine_id", "pcb_side"]
_BOARD = ["machine_id", "pcb_name", "pcb_side", "generated_key"]
_RATIO_COLUMNS = (
    "generated_key",
    "min_inspection_end_time",
    "max_inspection_end_time",
    "machine_id",
    "pcb_name",
    "pcb_side",
)


def header_records(df: DataFrame) -> DataFrame:
    """Inspections from raw header records."""
    return df.select(
        F.col("GeneratedKey").alias("generated_key"),
        F.col("MachineID").alias("machine_id"),
        F.col("Side").alias("pcb_side"),
        F.col("PCBName").alias("pcb_name"),
        F.col("PCBResult").alias("pcb_result"),
        times.inspection_time(F.col("InspectionEndTime")).alias("inspection_end"),
    )


def detail_records(df: DataFrame) -> DataFrame:
    """Pads from raw detail records."""
    return df.select(
        F.col("GeneratedKey").alias("generated_key"), F.col("Volume").try_cast("double").alias("volume")
    )


def landed_header(df: DataFrame) -> DataFrame:
    """Inspections from the landed header table."""
    return df.select(
        "generated_key",
        "machine_id",
        F.col("side").alias("pcb_side"),
        "pcb_name",
        "pcb_result",
        F.col("inspection_end_dttm").alias("inspection_end"),
    )


def landed_detail(df: DataFrame) -> DataFrame:
    """Pads from the landed detail table."""
    return df.select("generated_key", F.col("solder_paste_volume").cast("double").alias("volume"))


def _share(good: Sequence[str]) -> Column:
    result = F.col("pcb_result")
    return F.try_divide(F.count_if(result.isin(*good)), F.count("*"))


def unit_ratios(inspections: DataFrame) -> DataFrame:
    """Both ratios of every machine and side, in one pass.

    ``fpy`` is the share of GOOD and PASS, ``ffr`` the share of PASS, which is what the
    plant calls its first-fail rate.
    """
    return (
        inspections.filter(F.col("pcb_result").isin(*COUNTED))
        .groupBy(*_UNIT)
        .agg(*(_share(good).alias(f"{kpi}_result") for kpi, good in GOOD.items()))
    )


def _boards(inspections: DataFrame) -> DataFrame:
    return inspections.groupBy(*_BOARD).agg(
        F.min("inspection_end").alias("min_inspection_end_time"),
        F.max("inspection_end").alias("max_inspection_end_time"),
    )


def _ratios_across_sides(inspections: DataFrame, kpi: str) -> DataFrame:
    """Historic ratios: counts per machine and side, paired by machine alone."""
    counted = inspections.filter(F.col("pcb_result").isin(*COUNTED)).groupBy(*_UNIT)
    per_side = counted.agg(
        F.count("*").alias("n"), F.count_if(F.col("pcb_result").isin(*GOOD[kpi])).alias("good")
    )
    total = per_side.select("machine_id", "n")
    good = per_side.filter("good > 0").select(F.col("machine_id").alias("other"), "good")
    return total.join(good, F.col("machine_id").eqNullSafe(F.col("other"))).select(
        "machine_id", (F.col("good") / F.col("n")).alias(f"{kpi}_result")
    )


def _onto_boards(ratios: DataFrame, boards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Boards with the ratios of their unit; a board whose unit has none stays."""
    right = boards.select(*(F.col(c).alias(f"board_{c}") if c in keys else F.col(c) for c in boards.columns))
    match = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"board_{key}"))
        match = same if match is None else match & same
    joined = ratios.join(right, match, "right").drop(*keys)
    return joined.withColumnsRenamed({f"board_{key}": key for key in keys})


def yields(
    inspections: DataFrame, kpis: Sequence[str] = ("fpy", "ffr"), as_of=None, compat: bool = False
) -> DataFrame:
    """One row per machine, side, board name and board key with the ratios of its unit.

    A unit without a counted board has ratio 0. `compat` pairs the two counts by machine
    only, so every board of a two-sided machine comes once per pair of sides.
    """
    boards = _boards(inspections)
    if compat:
        (kpi,) = kpis
        joined = _onto_boards(_ratios_across_sides(inspections, kpi), boards, ["machine_id"])
    else:
        joined = _onto_boards(unit_ratios(inspections), boards, _UNIT)
    results = [f"{kpi}_result" for kpi in kpis]
    filled = joined.withColumn(
        "interval_id", times.interval_id(F.col("max_inspection_end_time"), compat=compat)
    ).fillna(0, [*results, "interval_id"])
    out = filled.select(
        *_RATIO_COLUMNS,
        *results,
        text.machine_side(F.col("machine_id"), F.col("pcb_side")).alias("machineId_side"),
        "interval_id",
    )
    return out if as_of is None else out.withColumn("bicoe_load_dttm", F.lit(as_of).cast("timestamp"))


def fpy(inspections: DataFrame, as_of=None, compat: bool = False) -> DataFrame:
    return yields(inspections, ("fpy",), as_of, compat)


def ffr(inspections: DataFrame, as_of=None, compat: bool = False) -> DataFrame:
    return yields(inspections, ("ffr",), as_of, compat)


def board_volumes(pads: DataFrame, inspections: DataFrame) -> DataFrame:
    """Volume sums of every inspected board that has pads.

    Pads are added up per board key before they meet the inspections, so the join moves
    one row per board and task, also when one key has most of the pads.
    """
    sums = pads.groupBy("generated_key").agg(
        F.sum("volume").alias("volume_sum"), F.count("volume").alias("volume_count")
    )
    return inspections.select(*_BOARD, "inspection_end").join(sums, "generated_key")


def volume(pads: DataFrame, inspections: DataFrame, as_of=None, compat: bool = False) -> DataFrame:
    """Mean paste volume of every machine and side, on each of its boards."""
    return board_records(board_volumes(pads, inspections), as_of, compat)


def board_records(measured: DataFrame, as_of=None, compat: bool = False) -> DataFrame:
    """Mean paste volume of every machine and side, on each board, from volume sums of boards."""
    units = unit_means(measured)
    boards = measured.select(*_BOARD).distinct()
    joined = units.join(boards, _UNIT).withColumn(
        "interval_id", times.interval_id(F.col("max_inspection_end_time"), compat=compat)
    )
    out = joined.fillna(0, ["volume_result", "interval_id"]).select(
        *_UNIT,
        "generated_key",
        "pcb_name",
        "volume_result",
        "min_inspection_end_time",
        "max_inspection_end_time",
        "interval_id",
        text.machine_side(F.col("machine_id"), F.col("pcb_side")).alias("machineId_side"),
    )
    return out if as_of is None else out.withColumn("bicoe_load_dttm", F.lit(as_of).cast("timestamp"))


def stored(kpi_rows: DataFrame, kpi: str) -> DataFrame:
    """Rows of one indicator in the shape of the KPI store."""
    return kpi_rows.withColumnRenamed(f"{kpi}_result", "result").select(*KPI_COLUMNS)


def kpi_of(value: Column) -> Column:
    """Which indicator a JSON KPI record holds."""
    chain = F.when(F.contains(value, F.lit("ffr_result")), "ffr")
    for kpi in ("fpy", "volume"):
        chain = chain.when(F.contains(value, F.lit(f"{kpi}_result")), kpi)
    return chain


def from_json(messages: DataFrame, kpi: str, value: str = "value") -> DataFrame:
    """Stored rows of one indicator from a topic that carries all of them."""
    schema = (
        "generated_key string, interval_id bigint, pcb_name string, "
        f"{kpi}_result double, min_inspection_end_time timestamp, "
        "max_inspection_end_time timestamp, machineId_side string, "
        "bicoe_load_dttm timestamp, machine_id string, pcb_side string"
    )
    rows = messages.filter(kpi_of(F.col(value)) == kpi).select(F.from_json(value, schema).alias("r"))
    return stored(rows.select("r.*").withColumnRenamed("machineId_side", "machineid_side"), kpi)


def messages(kpi_rows: DataFrame, kpis: Sequence[str] = ("fpy", "ffr")) -> DataFrame:
    """JSON records of several indicators that were computed in one pass: one for each row and indicator."""
    shared = [c for c in kpi_rows.columns if c not in {f"{k}_result" for k in kpis}]
    records = [F.to_json(F.struct(*shared, f"{k}_result")) for k in kpis]
    return kpi_rows.select(F.explode(F.array(*records)).alias("value"))


def from_json_all(messages: DataFrame, value: str = "value") -> DataFrame:
    """Stored rows of all indicators from one topic, with ``kpi``; each record is parsed once.

    Records of no known indicator are left out.
    """
    names = ("fpy", "ffr", "volume")
    schema = (
        "generated_key string, interval_id bigint, pcb_name string, "
        + "".join(f"{k}_result double, " for k in names)
        + "min_inspection_end_time timestamp, max_inspection_end_time timestamp, machineId_side string, "
        "bicoe_load_dttm timestamp, machine_id string, pcb_side string"
    )
    kind = kpi_of(F.col(value))
    both = F.struct(kind.alias("kpi"), F.from_json(value, schema).alias("r"))
    # an exploded array of one: what reads the fields stays above the parser
    parsed = messages.filter(kind.isNotNull()).select(F.explode(F.array(both)).alias("p")).select("p.kpi", "p.r.*")
    result = None
    for k in names:
        own = F.when(F.col("kpi") == k, F.col(f"{k}_result"))
        result = own if result is None else F.coalesce(result, own)
    rows = parsed.withColumn("result", result).withColumnRenamed("machineId_side", "machineid_side")
    return rows.select("kpi", *KPI_COLUMNS)


def interval_yields(inspections: DataFrame, minutes: int = 15) -> DataFrame:
    """Ratios per machine, side and interval of event time; works on streams and tables.

    On a stream the input needs a watermark on ``inspection_end``.
    """
    span = F.window("inspection_end", f"{minutes} minutes")
    return (
        inspections.filter(F.col("pcb_result").isin(*COUNTED))
        .groupBy(*_UNIT, span)
        .agg(
            F.count("*").alias("boards"),
            *(_share(good).alias(f"{kpi}_result") for kpi, good in GOOD.items()),
        )
        .select(
            *_UNIT,
            F.unix_millis(F.col("window.start").cast("timestamp")).alias("interval_id"),
            "boards",
            *(f"{kpi}_result" for kpi in GOOD),
        )
    )


def unit_means(boards: DataFrame) -> DataFrame:
    """Mean volume and time span of every machine and side, from volume sums of boards."""
    return boards.groupBy(*_UNIT).agg(
        F.try_divide(F.sum("volume_sum"), F.sum("volume_count")).alias("volume_result"),
        F.min("inspection_end").alias("min_inspection_end_time"),
        F.max("inspection_end").alias("max_inspection_end_time"),
    )


def machines(kpi_rows: DataFrame) -> DataFrame:
    """Every machine and side there is."""
    return (
        kpi_rows.select("machine_id", "pcb_side")
        .distinct()
        .withColumn("machineId_side", text.machine_side(F.col("machine_id"), F.col("pcb_side")))
    )
