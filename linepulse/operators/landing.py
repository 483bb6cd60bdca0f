"""Records to typed rows of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.functions import convert, times
from linepulse.registry import LINEAGE, SPECS, TableSpec


def _field(spec: TableSpec, column: str) -> str:
    """SQL for the message field of a column, NULL when the message has none."""
    key = spec.field_key(column)
    return f"get(field_values, size(field_keys) - array_position(field_keys, '{key}'))"


def _typed(spec: TableSpec, column: str) -> Column:
    """Text as it is; other types from the trimmed text, NULL for a blank."""
    value, kind = _field(spec, column), spec.kind(column)
    if kind == "string":
        return F.expr(value)
    known = f"nullif(trim({value}), '')"
    if kind == "timestamp":
        return times.parse_time(F.expr(known), spec.time_format)
    if kind == "boolean":
        return convert.cast_text(F.expr(known), kind)
    return F.expr(f"try_cast({known} AS {kind})")


def land(records: DataFrame, table: str) -> DataFrame:
    """Rows of one raw table: columns picked by name, cast to the fixed types.

    A value that does not fit its column becomes NULL; `misfits` tells which.
    """
    spec = SPECS[table]
    lineage = [
        times.parse_time(F.col(c)).alias(c) if c == "bicoe_load_dttm" else F.col(c)
        for c in LINEAGE
    ]
    return records.select(*lineage, *(_typed(spec, c).alias(c) for c in spec.columns))


def misfits(spec: TableSpec) -> Column:
    """Names of the columns whose message value is not blank but doesn't fit their type."""
    names = [
        F.expr(f"CASE WHEN nullif(trim({_field(spec, c)}), '') IS NOT NULL THEN '{c}' END")
        for c in spec.columns
    ]
    lost = [
        F.when(_typed(spec, c).isNull(), name)
        for c, name in zip(spec.columns, names, strict=True)
        if spec.kind(c) != "string"
    ]
    return F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")


def _any_misfit(spec: TableSpec) -> Column:
    """Whether `misfits` has any name. Without functions on arrays of results, which are not compiled."""
    lost = F.lit(False)
    for column in spec.columns:
        if spec.kind(column) != "string":
            sent = F.expr(f"trim({_field(spec, column)}) > ''")
            lost = lost | (F.coalesce(sent, F.lit(False)) & _typed(spec, column).isNull())
    return lost


def misfit_rows(classified: DataFrame, table: str) -> DataFrame:
    """Records of a table that lose a value when they are landed, with ``bad_columns``.

    Only records that lose one, mostly few, are asked for the names of their columns.
    """
    rows = classified.filter(F.col("record_type") == table)
    lost = rows.filter(_any_misfit(SPECS[table]))
    return lost.withColumn("bad_columns", misfits(SPECS[table]))


def land_table(classified: DataFrame, table: str) -> DataFrame:
    """The rows of one table among records of several types."""
    return land(classified.filter(F.col("record_type") == table), table)
