"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every result is computed in full and thrown away. Each query runs $BENCH_RUNS times (2 by
default) in one session and counts with its best run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from linepulse.plans import continuous  # noqa: F401  (it registers its queries)
from linepulse.plans.catalog import QUERIES
from linepulse.session import line_session

HEADLINE = (
    "fpy_by_machine",
    "ffr_by_machine",
    "volume_by_machine",
    "interval_yield",
    "xmr_limits",
    "kpi_limits_all",
    "last_24h",
    "latest_version",
    "lookup_equipment",
    "lookup_wodetail",
    "lookup_progorderlist",
    "lookup_comptype",
    "lookup_merge",
    "nozzle_enriched",
    "nozzle_enriched_xref",
    "timers_enriched",
    "defects_enriched",
    "slot_enriched",
    "wide_events",
    "xml_roundtrip",
    "xml_landed_detail",
    "json_landed_timers",
    "routed_counts",
    "topic_routing",
    "payload_chunks",
    "payload_sizes",
    "row_count_report",
    "freshness_report",
    "stream_latest",
    "stream_two_inlets",
    "stream_reset",
    "stream_quarantine",
    "xmr_sliding",
    "volume_bucketed",
    "sql_functions",
    "json_inferred",
    "timers_salted",
    "row_count_footers",
    "kpi_routing",
    "stream_file_sink",
    "stream_latest_buckets",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = line_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name], first[name] = round(min(times), 3), round(times[0], 3)
        print(f"{name} {times}", file=sys.stderr, flush=True)
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_run": first,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
