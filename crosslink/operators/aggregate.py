"""Per-game summary (aggregate first, then join dimensions) and its consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.config import MEAN_DECIMALS, Options
from crosslink.operators.enrich import clean_games, clean_recs, game_dimensions, reviews_of
from crosslink.schemas import RESULT_DESCRIPTOR_COLUMNS, RESULT_KB_COLUMNS, RESULT_STEAM_COLUMNS
from crosslink.session import scratch_path
from crosslink.sources.readers import Sources

FLAGS_PRESENT = "num_flags_present"


def review_stats(reviews: DataFrame) -> DataFrame:
    """Per game: recommend rate, review count, positive count.

    Numeric-only aggregates → ``HashAggregate`` with a map-side partial
    step, so a hot game costs one partial row per map task in the shuffle.
    ``num_flags_present`` (non-null flags) feeds the data-quality report.
    """
    return reviews.groupBy("app_id").agg(
        F.avg("is_recommended_num").alias("steam_recommend_rate"),
        F.count(F.lit(1)).alias("num_reviews"),
        F.sum("is_recommended_num").alias("num_positive_reviews"),
        F.count("is_recommended").alias(FLAGS_PRESENT),
    )


def result_columns(df: DataFrame) -> list[str]:
    """Result columns in output order, each only if present."""
    wanted = RESULT_STEAM_COLUMNS + RESULT_DESCRIPTOR_COLUMNS + RESULT_KB_COLUMNS
    return [c for c in wanted if c in df.columns]


def game_facts(sources: Sources, options: Options = Options(), provenance: bool = True) -> DataFrame:
    """Game-grain table: review stats ⋈ games, then every dimension.

    The reviews are shuffled once for de-duplication and reduced to one row
    per game before any join; dimensions, unique on their key, then join at
    game grain.
    """
    return facts_of(review_stats(clean_recs(sources.recs, sources.review_order)), sources, options, provenance)


def facts_of(stats: DataFrame, sources: Sources, options: Options = Options(), provenance: bool = True) -> DataFrame:
    """Game-grain table from per-game review statistics."""
    base = stats.join(clean_games(sources.games), "app_id", "inner")
    return game_dimensions(base, sources, options, provenance=provenance)


def game_summary(sources: Sources, options: Options = Options()) -> DataFrame:
    """The result table: one row per reviewed game (flagship query)."""
    facts = game_facts(sources, options, provenance=False)
    return facts.select(*result_columns(facts))


def rate_by_country(summary: DataFrame) -> DataFrame:
    """Recommend rate by publisher country, game- and review-weighted."""
    return (
        summary.filter(F.col("wd_country").isNotNull())
        .groupBy("wd_country")
        .agg(
            F.count(F.lit(1)).alias("num_games"),
            F.sum("num_reviews").alias("num_reviews"),
            F.sum("num_positive_reviews").alias("num_positive_reviews"),
            F.round(F.avg("steam_recommend_rate"), MEAN_DECIMALS).alias("mean_game_rate"),
        )
        .withColumn(
            "review_weighted_rate", F.col("num_positive_reviews") / F.col("num_reviews")
        )
    )


def top_in_country(
    summary: DataFrame,
    country: str,
    min_reviews: int = 1000,
    k: int = 10,
) -> DataFrame:
    """Top-``k`` games of one publisher country by recommend rate.

    Filters reach the Parquet scan when ``summary`` is read back; the sort +
    limit plans as ``TakeOrderedAndProject`` (per-partition top-k, then a
    merge of k rows per partition). Ties broken by ``app_id``.
    """
    return (
        summary.filter((F.col("wd_country") == F.lit(country)) & (F.col("num_reviews") > min_reviews))
        .orderBy(F.col("steam_recommend_rate").desc(), F.col("app_id").asc())
        .limit(k)
        .select("title", "steam_recommend_rate", "num_reviews", "wd_publisher")
    )


def top_in_country_first(
    sources: Sources,
    country: str,
    min_reviews: int = 1000,
    k: int = 10,
    options: Options = Options(),
) -> DataFrame:
    """``top_in_country`` from the sources, with the country first.

    Entities are resolved at game grain and filtered by country; only the
    reviews of those games are de-duplicated and aggregated. The games of one
    country are written first, so Spark knows their size: below its broadcast
    threshold they filter the reviews in the scan, and only theirs are shuffled.
    """
    spark = sources.games.sparkSession
    games = game_dimensions(clean_games(sources.games), sources, options)
    path = scratch_path(spark, "country_games")
    games.filter(F.col("wd_country") == F.lit(country)).write.parquet(path)
    games = spark.read.parquet(path)
    stats = review_stats(clean_recs(reviews_of(sources.recs, games), sources.review_order))
    return top_in_country(stats.join(games, "app_id"), country, min_reviews, k)
