"""Record types and the topics they go to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.registry import ROUTES, TABLES

# Logical topics; a job maps them to the names of its broker.
RECORDS = "records"
MASTER = "master"


def record_type(tag: Column, routes: Mapping[str, str] = ROUTES) -> Column:
    """The first table whose route is part of the tag name, NULL when there is none."""
    chain = None
    for table, route in routes.items():
        match = F.contains(tag, F.lit(route))
        chain = F.when(match, table) if chain is None else chain.when(match, table)
    return chain


def record_types(text: Column, routes: Mapping[str, str] = ROUTES) -> Column:
    """Every table whose route is part of `text`, as an array."""
    hits = [F.when(F.contains(text, F.lit(route)), F.lit(table)) for table, route in routes.items()]
    return F.array_compact(F.array(*hits))


def classify(
    records: DataFrame,
    routes: Mapping[str, str] = ROUTES,
    compat: bool = False,
    whole_record: Column | str = "raw",
) -> DataFrame:
    """Records with their ``record_type``.

    `compat` looks for the routes in the whole record instead of in its tag name: a value
    can then send a record to a wrong table, and one record can go to several.
    """
    if not compat:
        return records.withColumn("record_type", record_type(F.col("xml_tag_name"), routes))
    text = F.col(whole_record) if isinstance(whole_record, str) else whole_record
    return records.withColumn("record_type", F.explode_outer(record_types(text, routes)))


def with_tag(records: DataFrame, route: str) -> DataFrame:
    """Records of one route."""
    return records.filter(F.contains("xml_tag_name", F.lit(route)))


def unrouted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("record_type").isNull())


def of_topic(topic: str, kinds: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Routes of the record types one inlet topic carries; all of them if it is not listed."""
    tables = kinds.get(topic, tuple(ROUTES))
    return {table: ROUTES[table] for table in tables}


def shared_topics() -> dict[str, list[str]]:
    """Master data to the master topic, the other forwarded types to one records topic."""
    return {s.name: [MASTER if s.master else RECORDS] for s in TABLES if s.forwarded}


def per_type_topics() -> dict[str, list[str]]:
    """Machine events to a topic of their own, master data to the master topic, no others."""
    own = ("ea_pap_timers", "ea_pap_slot", "ea_pap_nozzle", "ea_ftdefects")
    topics = {name: [name] for name in own}
    topics.update({s.name: [MASTER] for s in TABLES if s.master})
    return topics


def to_topics(
    classified: DataFrame, topics: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row per record and topic; record types without a topic are not forwarded."""
    plan = shared_topics() if topics is None else topics
    chain = None
    for table, names in plan.items():
        match = F.col("record_type") == table
        value = F.array(*(F.lit(n) for n in names))
        chain = F.when(match, value) if chain is None else chain.when(match, value)
    return classified.withColumn("topic", F.explode(chain))
