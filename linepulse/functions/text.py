"""Column expressions on identifiers, locations and work-centre codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BETWEEN = "\u0001"
_ASCII_MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum() and c != _BETWEEN)


def blank(c: Column) -> Column:
    return c.rlike(r"^\s*$")


def stripped(c: Column) -> Column:
    """Text without the white space around it, line ends and tabs included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def keys_of(names: Column) -> Column:
    """Header names without case and all but letters and digits, as headers vary in spelling.

    The names go through the functions as one text, which costs less than one by one. Names with no marks but
    underscores, which are most, lose these alone; only names with letters beyond ASCII need a pattern
    that replaces, which takes many times as long.
    """
    joined = F.array_join(names, _BETWEEN)
    usual = F.array_join(names, "_").rlike(r"^\w*+\z")
    plain = F.octet_length(joined) == F.length(joined)
    kept = (
        F.when(usual, F.replace(joined, F.lit("_"), F.lit("")))
        .when(plain, F.translate(joined, _ASCII_MARKS, ""))
        .otherwise(F.regexp_replace(joined, f"[^A-Za-z0-9{_BETWEEN}]", ""))
    )
    return F.split(F.lower(kept), _BETWEEN)


def machine_side(machine: Column, side: Column) -> Column:
    return F.concat(machine, F.lit("-"), side)


def product_prefix(product_id: Column) -> Column:
    """Text before the first dot."""
    return F.substring_index(product_id, ".", 1)


def panel_circuit(circuit: Column, ref_id: Column) -> Column:
    """Leading part of `ref_id`: the circuit and the separator after it."""
    return ref_id.substr(F.lit(1), F.length(circuit) + 1)


def ref_designator(circuit: Column, ref_id: Column) -> Column:
    """Part of `ref_id` after the circuit and its separator."""
    return ref_id.substr(F.length(circuit) + 2, F.length(ref_id))


def location_part(location: Column, index: int, shift: int = 0) -> Column:
    """One part of a comma-separated location; `shift` turns a 0-based number into 1-based."""
    part = F.get(F.split(location, ","), F.lit(index))
    if not shift:
        return part
    return (part.try_cast("int") + shift).cast("string")


def changer_hole(location: Column, shift: int = 1) -> Column:
    return F.concat(location_part(location, 1, shift), F.lit("-"), location_part(location, 2, shift))


def machine_changer_hole(machine: Column, location: Column, shift: int = 1, sep: str = " - ") -> Column:
    return F.concat(machine, F.lit(sep), changer_hole(location, shift))


def slot_track(location: Column) -> Column:
    return location_part(location, 1, 1)


def slot_label(slot_number: Column, location: Column) -> Column:
    return F.concat(slot_number.cast("string"), F.lit("."), location_part(location, 2, 1))


def workcentre_machine(code: Column) -> Column:
    """Last underscore token."""
    return F.element_at(F.split(code, "_"), -1)


def workcentre_side(code: Column) -> Column:
    """Last but one underscore token as a board side; empty when it names none."""
    token = F.try_element_at(F.split(code, "_"), F.lit(-2))
    return F.when(token == "TOP", "Top").when(token == "BOT", "Bottom").otherwise("")


def strip_leading_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")


def tag_location(tag: Column) -> Column:
    """Third dash token of a tag name."""
    return F.get(F.split(tag, "-"), F.lit(2))


def work_order_url(base: str, work_order: Column, plant: Column) -> Column:
    return F.concat(F.lit(f"{base}?wo="), work_order, F.lit("&Location="), plant, F.lit("&Section="))


def unit_url(base: str, plant: Column, serial: Column) -> Column:
    return F.concat(F.lit(f"{base}?Location="), plant, F.lit("&SN="), serial)
