"""The scalar functions by name, for plain SQL.

Each is a temporary SQL function, which Spark inlines into the plan of its caller, so filters, pruning
and code generation see through it and no Python runs. They compute what the column functions of
the same name do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from linepulse.functions.convert import NUMERIC, words_for
from linepulse.functions.times import ISO, SPI_12H, SPI_24H


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _by_word(branch, other: str) -> str:
    arms = "".join(f" WHEN word IN ({_quoted(words_for(kind))}) THEN {branch(kind)}" for kind in NUMERIC)
    return f"CASE{arms} WHEN word IN ({_quoted(words_for('boolean'))}) THEN {branch('boolean')} ELSE {other} END"


def _typed(kind: str) -> str:
    if kind == "boolean":
        return "CASE lower(txt) WHEN 'true' THEN true WHEN 'false' THEN false END"
    return f"TRY_CAST(txt AS {kind})"


def _time(*formats: str) -> str:
    tries = ", ".join(f"try_to_timestamp(txt, '{f.replace(chr(39), chr(92) + chr(39))}')" for f in formats)
    return f"date_trunc('second', coalesce({tries}))"


#: Name, parameters, result and body of each function.
FUNCTIONS = (
    ("machine_side", "machine STRING, side STRING", "STRING", "concat(machine, '-', side)"),
    ("product_prefix", "product_id STRING", "STRING", "substring_index(product_id, '.', 1)"),
    ("panel_circuit", "circuit STRING, ref_id STRING", "STRING", "substr(ref_id, 1, length(circuit) + 1)"),
    (
        "ref_designator",
        "circuit STRING, ref_id STRING",
        "STRING",
        "substr(ref_id, length(circuit) + 2, length(ref_id))",
    ),
    (
        "location_part",
        "location STRING, place INT, shift INT DEFAULT 0",
        "STRING",
        "CASE WHEN shift = 0 THEN get(split(location, ','), place) "
        "ELSE CAST(TRY_CAST(get(split(location, ','), place) AS INT) + shift AS STRING) END",
    ),
    (
        "changer_hole",
        "location STRING, shift INT DEFAULT 1",
        "STRING",
        "concat(location_part(location, 1, shift), '-', location_part(location, 2, shift))",
    ),
    (
        "machine_changer_hole",
        "machine STRING, location STRING",
        "STRING",
        "concat(machine, ' - ', changer_hole(location))",
    ),
    ("slot_track", "location STRING", "STRING", "location_part(location, 1, 1)"),
    (
        "slot_label",
        "slot_number INT, location STRING",
        "STRING",
        "concat(CAST(slot_number AS STRING), '.', location_part(location, 2, 1))",
    ),
    ("workcentre_machine", "code STRING", "STRING", "element_at(split(code, '_'), -1)"),
    (
        "workcentre_side",
        "code STRING",
        "STRING",
        "CASE try_element_at(split(code, '_'), -2) WHEN 'TOP' THEN 'Top' WHEN 'BOT' THEN 'Bottom' ELSE '' END",
    ),
    ("strip_leading_zeros", "txt STRING", "STRING", "regexp_replace(txt, '^0+', '')"),
    ("tag_location", "tag STRING", "STRING", "get(split(tag, '-'), 2)"),
    (
        "work_order_url",
        "base STRING, work_order STRING, plant STRING",
        "STRING",
        "concat(base, '?wo=', work_order, '&Location=', plant, '&Section=')",
    ),
    (
        "unit_url",
        "base STRING, plant STRING, serial STRING",
        "STRING",
        "concat(base, '?Location=', plant, '&SN=', serial)",
    ),
    ("parse_time", "txt STRING", "TIMESTAMP", _time(ISO)),
    ("inspection_time", "txt STRING", "TIMESTAMP", _time(SPI_12H, SPI_24H)),
    (
        "interval_id",
        "ts TIMESTAMP, minutes INT DEFAULT 15",
        "BIGINT",
        "unix_millis(ts) - pmod(unix_millis(ts), minutes * 60000L)",
    ),
    (
        "trailing",
        "ts TIMESTAMP, as_of TIMESTAMP, hours INT DEFAULT 24",
        "BOOLEAN",
        "unix_seconds(ts) > unix_seconds(as_of) - hours * 3600",
    ),
    (
        "converts",
        "txt STRING, word STRING",
        "BOOLEAN",
        _by_word(lambda kind: f"{_typed(kind)} IS NOT NULL", "word IS NOT NULL"),
    ),
    ("as_number", "txt STRING", "DOUBLE", "TRY_CAST(txt AS DOUBLE)"),
)
#: Functions that give tables. Braces name the relation that holds the raw rows.
TABLE_FUNCTIONS = (
    (
        "work_orders_of",
        "at STRING",
        "optel_schedule_wo STRING, sap_wo STRING, side STRING, assembly STRING, version STRING",
        "SELECT optel_schedule_wo, m.sap_wo, m.side, m.assembly, m.hdfs_file_name FROM ("
        "SELECT optel_schedule_wo, max(struct(hdfs_file_name, sap_wo, side, assembly)) AS m FROM {wodetail} "
        "WHERE plant = work_orders_of.at GROUP BY optel_schedule_wo)",
        ("wodetail",),
    ),
)


def register(spark: SparkSession) -> list[str]:
    """Makes all scalar functions known to a session by name."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in FUNCTIONS]


def register_tables(spark: SparkSession, **relations: str) -> list[str]:
    """Makes the table functions known whose relations are given, by name of a table or view."""
    made = []
    for name, parameters, result, body, needs in TABLE_FUNCTIONS:
        if all(n in relations for n in needs):
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({result}) "
                f"RETURN {body.format(**relations)}"
            )
            made.append(name)
    return made
