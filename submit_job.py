"""Run the whole job from the command line: ``spark-submit submit_job.py --games … --out …``.

Exit code 0: done (quality warnings don't fail the job); 1: it failed; 2: a
required source is absent or empty, or an argument is wrong.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crosslink.config import Options  # noqa: E402
from crosslink.plans.pipeline import run_pipeline  # noqa: E402
from crosslink.session import build_session  # noqa: E402
from crosslink.sources.readers import SourcePaths, load_sources  # noqa: E402

log = logging.getLogger("crosslink")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("games", "metadata", "recs", "popularity", "categories", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--kb", help="knowledge base (JSON lines); without it KB columns are left out")
    p.add_argument("--categories-delimiter", default=",")
    p.add_argument("--review-order", nargs="*", default=[], metavar="COLUMN[:TYPE]", help="order of a user's reviews of one game")
    p.add_argument("--fallback", choices=("field", "entity"), default="field")
    p.add_argument("--min-records", type=int, default=Options().min_expected_records)
    p.add_argument("--max-null-rate", type=float, default=Options().max_null_rate)
    p.add_argument("--sample-rows", type=int, default=Options().sample_rows)
    p.add_argument("--ledger", action="store_true", help="write what the readers could not parse, with its file and raw text")
    p.add_argument("--master", help="Spark master, if spark-submit doesn't set one")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    order = [c.partition(":") for c in a.review_order]
    paths = SourcePaths(
        games=a.games,
        metadata=a.metadata,
        recs=a.recs,
        popularity=a.popularity,
        categories=a.categories,
        kb=a.kb,
        categories_delimiter=a.categories_delimiter.replace("\\t", "\t"),
        review_order=tuple(c for c, _, _ in order),
        review_types={c: t for c, _, t in order if t},
    )
    options = Options(fallback=a.fallback, min_expected_records=a.min_records, max_null_rate=a.max_null_rate, sample_rows=a.sample_rows)
    spark = build_session(a.master)
    try:
        sources = load_sources(spark, paths, ledger=a.ledger)
    except (FileNotFoundError, ValueError) as e:
        log.error("%s", e)
        return 2
    try:
        result = run_pipeline(spark, sources, a.out, options)
    except Exception:
        log.exception("the job failed")
        return 1
    log.info("result in %s, report in %s", result.result_path, result.markdown_path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
