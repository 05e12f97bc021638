"""Benchmark: headline queries and the end-to-end job on the test tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Prints ONE JSON line:
{"metric": "pipeline_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced with the ``noop`` sink (full evaluation, nothing
collected); the reported time is the median of BENCH_RUNS runs, measured
after one warm-up run of the whole job. Times include building the plan
(stand-in derivation, broadcast-size probes) as well as executing it. ``pipeline_seconds`` is the end-to-end job (stand-in load →
clean → dedup → aggregate → join dimensions → Parquet + CSV preview), the
same span the published baseline times; validation is timed separately.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crosslink.plans.pipeline import run_pipeline  # noqa: E402
from crosslink.plans.queries import QUERIES  # noqa: E402
from crosslink.session import build_session, scratch_path  # noqa: E402
from crosslink.sources.standins import standin_sources  # noqa: E402

HEADLINE = (
    "game_summary",
    "enrich_reviews",
    "dedup_reviews",
    "resolve_entities",
    "dq_report",
    "top_in_country",
    "rate_by_country",
    "normalize_title",
    "parse_kb_bindings",
)


def _time(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(
        f"local[{cpus}]",
        app_name="crosslink-bench",
        shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="crosslink-bench-"))

    samples: dict[str, list[float]] = defaultdict(list)

    def pipeline(where: str = sf_dir) -> float:
        return run_pipeline(spark, standin_sources(spark, where), scratch_path(spark, "bench-out")).runtime_seconds

    def timed_pipeline() -> None:
        samples["pipeline_job"].append(pipeline())

    jobs = {
        name: lambda q=QUERIES[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save() for name in HEADLINE
    }
    jobs["pipeline_with_validation"] = timed_pipeline
    pipeline()  # warm-up (JIT, codegen caches, file listings)
    for k in range(runs):  # every second round backwards, so that no query always follows the same one
        for name in sorted(jobs, key=list(jobs).index, reverse=k % 2 == 1):
            samples[name].append(_time(jobs[name]))
    times = {name: round(statistics.median(own), 3) for name, own in samples.items()}

    # marginal rate: further reviews over further seconds between this scale and the next smaller one
    reviews, marginal = standin_sources(spark, sf_dir).recs.count(), None
    smaller = os.path.join(os.path.dirname(sf_dir), f"sf{sf / 10:g}") if sf else ""
    if os.path.isdir(smaller):
        few = standin_sources(spark, smaller).recs.count()
        pipeline(smaller)
        less = statistics.median(pipeline(smaller) for _ in range(runs))
        times["pipeline_job_smaller_sf"] = round(less, 3)
        if times["pipeline_job"] > less:
            marginal = round((reviews - few) / (times["pipeline_job"] - less))

    out = {
        "metric": "pipeline_seconds",
        "value": times["pipeline_job"],
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "reviews": reviews,
        "marginal_reviews_per_sec": marginal,
        "reviews_per_sec": round(reviews / times["pipeline_job"]) if times["pipeline_job"] else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
