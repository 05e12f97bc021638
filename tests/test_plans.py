"""Plan-shape checks: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from crosslink.operators.aggregate import game_facts, game_summary
from crosslink.operators.quality import dq_report, match_rate


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_plan(small_sources):
    df = game_summary(small_sources)
    df.count()
    plan = _plan(df)
    assert "SortAggregate" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # dedup uses rank-1 limits (pruned before the shuffle as well)
    assert "WindowGroupLimit" in _optimized(df)


def test_no_join_is_hinted(small_sources):
    """Sides are broadcast only on sizes that Spark measured."""
    assert "ResolvedHint" not in game_summary(small_sources)._jdf.queryExecution().analyzed().toString()


def test_tags_never_reach_a_shuffle(spark, small_sources):
    df = game_summary(small_sources)
    below = [ln for ln in _plan(df).splitlines() if "Exchange" in ln or "Sort " in ln or "WindowGroupLimit" in ln]
    assert below and not any(re.search(r"\btags#", ln) for ln in below)


def test_report_reads_each_input_once(spark, small_sources):
    """One aggregate over the facts, one over each source: no row expansion, no second use of a metric frame."""
    facts = spark.createDataFrame([(1, 2, 1, 0.5, "t", 2, "Q", "id")], "app_id int, num_reviews long, num_positive_reviews long, steam_recommend_rate double, title string, num_flags_present long, wikidata_qid string, wd_match_stage string")
    plan = _optimized(dq_report(small_sources, facts))
    assert "Expand" not in plan
    assert plan.count("l_partkey") and len(re.findall(r"Relation \[[^]]*l_partkey[^]]*\] parquet", plan)) == 1
    assert "Expand" not in _optimized(match_rate(game_facts(small_sources)))


def test_keyless_rows_spread_over_the_join(spark):
    """Titles that normalize to nothing can match nothing and must not meet in one partition."""
    from crosslink.operators.resolve import join_kb_by_title

    kb = spark.createDataFrame([("Q1", "u", None, "a b", None, None, None, None)], "wikidata_qid string, wikidata_uri string, steam_app_id string, name string, release_date string, metacritic string, publisher string, country string")
    games = spark.range(4000).select(F.col("id").cast("int").alias("app_id"), F.when(F.col("id") % 10 == 0, F.lit("A b")).otherwise(F.lit("東方")).alias("title"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = join_kb_by_title(games, kb)
        assert out.filter("wikidata_qid_t = 'Q1'").count() == 400
        sizes = out.filter("wikidata_qid_t IS NULL").rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
        assert sum(sizes) == 3600 and max(sizes) < 0.3 * 3600
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
