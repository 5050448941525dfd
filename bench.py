"""Wall time of the headline queries.

Prints one JSON line. Inputs are derived from ``$BENCH_SF_DIR`` and stored before
the clock starts; each query is then run twice into a no-op sink and the faster run
counts, so that neither JVM warm-up nor result collection is measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridloom.catalogue import inputs as I  # noqa: E402
from gridloom.catalogue.queries import QUERIES  # noqa: E402
from gridloom.session import build_session  # noqa: E402

HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "pyramid", "level_totals", "compact_encode", "name_to_gid", "gid_to_name", "point_to_cell", "latlon_to_cell",
    "geouri_to_cell", "geohash", "resolve_point", "locate_points", "locate_bbox", "nearest_cell", "containment_join",
    "containment_pairs", "descendants", "rebuild_original", "rebuild_quadrant", "rebuild_vs_original", "check_names",
    "dissolve", "level_counts", "schema_check", "table_diff", "compact_store", "check_geometry", "edge_rate", "naming_violations",
    "search_original", "ring_area", "ring_centroid", "cell_polygon_latlon", "geojson_features", "geojson_read", "stream_enrich",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for decimals in (6, 12):
        I.stored_original(spark, sf_dir, decimals)
    I.stored_compact(spark, sf_dir)
    I.stored_points(spark, sf_dir)
    cells = I.stored_cells(spark, sf_dir).count()

    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, sf_dir, name) for _ in range(2)), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1], "cells": cells, "pyramid_rows_per_sec": round(cells / times["pyramid"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
