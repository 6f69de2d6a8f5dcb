"""Benchmark: one JSON line with seconds per headline query.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Every query runs once to warm up, then
three times; the median counts. The four ``overlap_*`` queries are the shapes of the published join benchmark.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import bindings
from varloom.fixtures import load
from varloom.plans.overlap import SHAPES, variant_overlap_count
from varloom.session import build_session

HEADLINE = [
    "global_variants",
    "union_distinct_variants",
    "annotate_dbsnp",
    "range_join_inner",
    "interval_allele_join",
    "clinvar_pathogenic",
    "nbs_high_risk",
    "acmg_report",
    "nbs_report",
    "compare_cohorts",
    "explode_effects",
    "allele_frequency",
    "population_frequency",
    "marker_index",
    "ld_prune",
    "thin_markers",
    "run_checks",
    "scale_features",
]


def overlap(shape: str):
    return lambda spark, sf_dir: variant_overlap_count(load(spark, sf_dir, "dbsnp"), load(spark, sf_dir, "kaviar"), shape)


def seconds(run, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {f"overlap_{s}": overlap(s) for s in SHAPES} | {n: bindings.QUERIES[n] for n in HEADLINE}
    only = sys.argv[1:]
    times: dict[str, float] = {}
    for name, run in chosen.items():
        if only and name not in only:
            continue
        seconds(run, spark, sf_dir)
        times[name] = round(statistics.median(seconds(run, spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "variant analytics, sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
