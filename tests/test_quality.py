"""Data-quality metrics: edge cases of the reference's definitions."""

import math

from crosslink.config import Options
from crosslink.operators.quality import match_rate, null_rates, summary_stats, threshold_violations


def test_null_rates_nan_absent_and_empty(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "d double, s string")
    got = {r.column_name: r.null_rate for r in null_rates(df, ["d", "s", "zzz"]).collect()}
    assert got["d"] == 0.5 and got["s"] == 0.25 and math.isnan(got["zzz"])
    empty = df.limit(0)
    got = {r.column_name: r.null_rate for r in null_rates(empty, ["d", "s"]).collect()}
    assert got == {"d": 0.0, "s": 0.0}


def test_summary_stats(spark):
    df = spark.createDataFrame([(1, 0.5, "x"), (3, 1.0, "y")], "n long, r double, s string")
    got = {r.column_name: (r.min, r.max, r.mean) for r in summary_stats(df, ["n", "r", "s", "zzz"]).collect()}
    assert got == {"n": (1.0, 3.0, 2.0), "r": (0.5, 1.0, 0.75)}
    assert summary_stats(df, ["s"]).count() == 0


def test_match_rate(spark):
    df = spark.createDataFrame([(1, "Q1"), (1, "Q1"), (2, None), (3, "Q3")], "app_id int, wikidata_qid string")
    r = match_rate(df).first()
    assert (r.matched, r.total) == (2, 3) and abs(r.match_rate_pct - 200 / 3) < 1e-12
    r0 = match_rate(df.limit(0)).first()
    assert (r0.matched, r0.total, r0.match_rate_pct) == (0, 0, 0.0)


def test_threshold_violations_strict(spark):
    counts = spark.createDataFrame([("a", 99, 2), ("b", 100, 2)], "source string, num_rows long, num_columns int")
    rates = spark.createDataFrame(
        [("app_id", 0.05), ("title", 0.0501), ("is_recommended", float("nan")), ("other", 0.9)],
        "column_name string, null_rate double",
    )
    got = sorted((r.check_name, r.subject) for r in threshold_violations(counts, rates, Options()).collect())
    assert got == [("max_null_rate", "title"), ("min_records", "a")]
