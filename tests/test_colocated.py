"""Bucketed tables: same results as the plain plans, and no shuffle of what lies side by side."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from crosslink.operators import colocated
from crosslink.operators.aggregate import game_summary
from crosslink.operators.enrich import enrich_reviews
from test_skew import _skewed_sources


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small_sources):
    return colocated.store(small_sources)


def test_equal_to_the_plain_plans(spark, small_sources, stored):
    assert rows(colocated.enriched(stored)) == rows(enrich_reviews(small_sources))
    assert rows(colocated.summary(stored)) == rows(game_summary(small_sources))


@pytest.mark.parametrize("partitions", [8, 200])
def test_stored_tables_meet_without_a_shuffle(spark, stored, partitions):
    """Whatever the session's partitions are, and with no side small enough to be broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(partitions)}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = colocated.enriched(stored)
        n = df.count()
        assert n > 0 and "Exchange" not in plan(df) and "SortMergeJoin" in plan(df)
        per_slot = stored.read(stored.reviews).groupBy(*colocated.KEYS).count()
        assert per_slot.agg(F.sum("count")).first()[0] >= n and "Exchange" not in plan(per_slot)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_game_lies_in_many_buckets(spark):
    sources = _skewed_sources(spark)
    stored = colocated.store(sources, buckets=32)
    assert rows(colocated.enriched(stored)) == rows(enrich_reviews(sources))
    hot = stored.read(stored.reviews).where("app_id = 1")
    files = hot.groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(files) >= 10 and max(r["count"] for r in files) * 4 < hot.count()
    # one file a bucket
    assert stored.read(stored.reviews).select(F.input_file_name()).distinct().count() <= 32


def test_without_users_without_rows_and_with_clashing_names(spark, small_sources):
    no_user = replace(small_sources, recs=small_sources.recs.drop("user_id"))
    assert rows(colocated.enriched(colocated.store(no_user))) == rows(enrich_reviews(no_user))
    empty = replace(small_sources, recs=small_sources.recs.limit(0))
    assert colocated.enriched(colocated.store(empty)).collect() == []
    clash = replace(small_sources, recs=small_sources.recs.withColumn("title", F.lit("mine")))
    assert rows(colocated.enriched(colocated.store(clash))) == rows(enrich_reviews(clash))
    with pytest.raises(ValueError):
        colocated.store(replace(small_sources, recs=small_sources.recs.withColumn(colocated.SLOT, F.lit(1))))


def test_stored_again_under_the_same_name(spark, small_sources, tmp_path):
    name, path = "again", str(tmp_path / "t")
    colocated.store(small_sources, path=path, name=name)
    half = replace(small_sources, recs=small_sources.recs.where("app_id % 2 = 0"))
    assert rows(colocated.enriched(colocated.store(half, path=path, name=name))) == rows(enrich_reviews(half))
