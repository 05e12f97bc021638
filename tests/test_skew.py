"""A hot key (a third of all reviews, many with null user) — exact and not funneled."""

import contextlib
import io

from pyspark.sql import functions as F

from crosslink.operators.aggregate import game_summary
from crosslink.sources.readers import Sources


def _skewed_sources(spark, n=30000):
    ids = spark.range(n).select(F.col("id"))
    recs = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("string").alias("app_id"),
        # the hot game: every other of its reviews has no user
        F.when((F.col("id") % 3 == 0) & (F.col("id") % 2 == 0), F.lit(None))
        .otherwise(F.col("id") % 1000)
        .cast("string")
        .alias("user_id"),
        F.when(F.col("id") % 5 == 0, F.lit("False")).otherwise(F.lit("true")).alias("is_recommended"),
        F.col("id").alias("seq"),
    )
    games = spark.range(1, 100).select(F.col("id").cast("string").alias("app_id"), F.concat(F.lit("G"), F.col("id")).alias("title"))
    return Sources(
        games=games,
        metadata=spark.createDataFrame([], "app_id string, tags array<string>"),
        recs=recs,
        popularity=spark.createDataFrame([], "appid string, price int"),
        categories=spark.createDataFrame([], "genre string, category string"),
        review_order=("seq",),
    )


def test_hot_key_exact_against_brute_force(spark):
    src = _skewed_sources(spark)
    got = {r.app_id: (r.num_reviews, r.num_positive_reviews) for r in game_summary(src).collect()}
    pdf = src.recs.toPandas()
    pdf["app_id"] = pdf["app_id"].astype(int)
    pdf["user_key"] = pdf["user_id"].fillna("<null>")
    first = pdf.sort_values("seq").groupby(["app_id", "user_key"], as_index=False).first()
    first["pos"] = (first["is_recommended"].str.lower() == "true").astype(int)
    want = first.groupby("app_id").agg(n=("pos", "size"), p=("pos", "sum"))
    assert got == {int(a): (int(r.n), int(r.p)) for a, r in want.iterrows()}
    # the hot game's 5000 null-user reviews collapsed to one survivor
    hot = pdf[pdf["app_id"] == 1]
    assert got[1][0] == hot["user_id"].nunique() + 1


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = game_summary(_skewed_sources(spark))
    df.count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    # rank-1 limit on the map side of the dedup exchange, and again after it
    assert "row_number(), 1, Partial" in plan
    assert "row_number(), 1, Final" in plan
    partial_at = plan.index("row_number(), 1, Partial")
    exchange_at = plan.index("hashpartitioning(app_id", partial_at)
    assert exchange_at > partial_at
    assert "SortAggregate" not in plan
