"""Master data: the current row of every business key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linepulse.functions import text

VERSION = "version"
REPORT_BASE = "https://reports.example/wo"


@dataclass(frozen=True)
class LookupSpec:
    name: str
    table: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    compat_load: str = "latest"
    compat_merge: str = "latest"
    apart: str | None = None

    @property
    def sorted_by(self) -> tuple[str, ...]:
        """The keys, the one that tells most rows apart first: sorts mostly compare the start of the first one."""
        return tuple(sorted(self.keys, key=lambda k: k != self.apart))


# Business keys and columns of the master tables, and the historic choice
# of the row that is kept on the first load and on a merge.
LOOKUPS = {
    spec.name: spec
    for spec in (
        LookupSpec(
            "equipment",
            "ea_equipmentoutline",
            ("machine_name", "plant"),
            (
                "machine_name",
                "equipment_make",
                "equipment_model",
                "equipment_type",
                "head_1",
                "head_2",
                "plant",
            ),
        ),
        LookupSpec(
            "info",
            "ea_pap_info",
            ("plant_code", "machine", "crc_id"),
            ("crc_id", "name", "description", "plant_code", "machine"),
        ),
        LookupSpec(
            "wodetail",
            "ea_wodetail",
            ("plant", "optel_schedule_wo"),
            ("optel_schedule_wo", "sap_wo", "side", "assembly", "plant", "setup", "wo_detail"),
            compat_load="first",
            apart="optel_schedule_wo",
        ),
        LookupSpec(
            "progorderlist",
            "ea_progorderlist",
            ("machine", "plant", "work_order", "ref_des", "silkscreen"),
            (
                "machine",
                "plant",
                "work_order",
                "ref_id",
                "silkscreen",
                "circuit",
                "head",
                "spindle",
                "head_spindle",
                "ref_des",
                "Pcircuit",
            ),
        ),
        LookupSpec(
            "comptype",
            "ea_comptype",
            ("plant", "machine", "part_number", "head_type"),
            ("plant", "machine", "part_number", "head_type", "pins", "nozzle1", "package"),
            compat_load="first",
            compat_merge="first",
            apart="part_number",
        ),
    )
}


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "latest"
) -> DataFrame:
    """The latest (or first) row of every key; ties go to the other columns in order.

    The filter on the row number lets Spark drop the other rows of a key before the
    shuffle, so a key with many versions sends one row per task.
    """
    others = [c for c in sorted(df.columns) if c not in keys and c not in order]
    columns = [F.col(f"`{c}`") for c in (*order, *others)]
    by = [c.desc() if keep == "latest" else c.asc() for c in columns]
    w = W.partitionBy(*keys).orderBy(*by)
    return df.withColumn("row_num", F.row_number().over(w)).filter("row_num = 1").drop("row_num")


def derived(raw: DataFrame, name: str, report_base: str = REPORT_BASE) -> DataFrame:
    """Raw master rows with the computed columns of their lookup."""
    if name == "wodetail":
        url = text.work_order_url(report_base, F.col("sap_wo"), F.col("plant"))
        return raw.withColumn("wo_detail", url)
    if name == "progorderlist":
        circuit, ref = F.col("circuit"), F.col("ref_id")
        return raw.withColumns(
            {
                "head_spindle": text.machine_side(F.col("head"), F.col("spindle")),
                "ref_des": text.ref_designator(circuit, ref),
                "Pcircuit": text.panel_circuit(circuit, ref),
            }
        )
    return raw


def versions(
    raw: DataFrame,
    name: str,
    version: Column | str = "hdfs_file_name",
    report_base: str = REPORT_BASE,
) -> DataFrame:
    """All versions of a lookup's rows, with the column that orders them."""
    spec = LOOKUPS[name]
    mark = F.col(version) if isinstance(version, str) else version
    return derived(raw, name, report_base).select(*spec.columns, mark.alias(VERSION))


def load(
    raw: DataFrame,
    name: str,
    version: Column | str = "hdfs_file_name",
    compat: bool = False,
    report_base: str = REPORT_BASE,
) -> DataFrame:
    """The lookup as it stands in a raw table.

    The link of a work order follows from its key and number and decides no tie, so only chosen rows get it.
    """
    spec = LOOKUPS[name]
    keep = spec.compat_load if compat else "latest"
    if name != "wodetail":
        return one_per_key(versions(raw, name, version, report_base), spec.sorted_by, [VERSION], keep)
    mark = F.col(version) if isinstance(version, str) else version
    sent = raw.select(*(c for c in spec.columns if c != "wo_detail"), mark.alias(VERSION))
    chosen = derived(one_per_key(sent, spec.sorted_by, [VERSION], keep), name, report_base)
    return chosen.select(*spec.columns, VERSION)


def merge(snapshot: DataFrame, delta: DataFrame, name: str, compat: bool = False) -> DataFrame:
    """A snapshot with newer rows merged in; both carry the version column."""
    spec = LOOKUPS[name]
    keep = spec.compat_merge if compat else "latest"
    return one_per_key(snapshot.unionByName(delta), spec.sorted_by, [VERSION], keep)


def version_counts(lookup: DataFrame) -> DataFrame:
    """How many rows of a lookup came with each version."""
    return lookup.groupBy(VERSION).agg(F.count("*").alias("row_count"))
