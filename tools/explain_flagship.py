"""Print the final (post-AQE) physical plan of the flagship and the pipeline's facts.

Usage: python tools/explain_flagship.py [sf_dir] > plan.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crosslink.operators.aggregate import game_summary  # noqa: E402
from crosslink.session import build_session  # noqa: E402
from crosslink.sources.standins import standin_sources  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    df = game_summary(standin_sources(spark, sf_dir))
    df.collect()  # run it, so AQE's final plan (runtime decisions) is shown
    df.explain(mode="formatted")


if __name__ == "__main__":
    main()
