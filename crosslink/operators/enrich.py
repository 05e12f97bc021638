"""Cleaning of each source and the game-grain dimension joins.

Design: every dimension is brought to *game grain* (one row per ``app_id``)
before it meets reviews. The review fact table is aggregated first and joins
the dimensions only as one row per game (see ``aggregate.game_facts``); the
review-grain view (``enrich_reviews``) joins the finished dimension row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.config import Options
from crosslink.functions import flag_to_int, primary_tag, tag_count, to_int_key
from crosslink.operators.clean import cast_key, dedup_first, drop_incomplete, rename_key
from crosslink.operators.joins import spread_nulls
from crosslink.schemas import POPULARITY_FIELDS
from crosslink.sources.readers import Sources

_TAG_KEY = "__crosslink_tag_key"

# --------------------------------------------------------------------------- #
#  Per-source cleaning
# --------------------------------------------------------------------------- #

def clean_games(games: DataFrame) -> DataFrame:
    """INT key, drop rows without key or title, one row per game."""
    df = drop_incomplete(games.select(to_int_key("app_id").alias("app_id"), "title"), ["app_id", "title"])
    return dedup_first(df, ["app_id"], ["title"])


def clean_metadata(metadata: DataFrame) -> DataFrame:
    """INT key, drop rows without key, one row per game: ``tag_count``, ``primary_tag``.

    Both are derived in the scan, so tag lists never reach a shuffle.
    """
    tags = F.col("tags") if "tags" in metadata.columns else F.lit(None).cast("array<string>")
    df = metadata.select(to_int_key("app_id").alias("app_id"), tags.alias("tags"))
    df = df.select("app_id", tag_count("tags").alias("tag_count"), primary_tag("tags").alias("primary_tag"))
    return dedup_first(drop_incomplete(df, ["app_id"]), ["app_id"], ["primary_tag", "tag_count"])


def clean_popularity(popularity: DataFrame) -> DataFrame:
    """``appid`` → INT ``app_id`` with the feed's fields, one row per game.

    Rows whose key is null (or unparsable) are dropped here: a left join on
    ``app_id`` could never match them anyway. Columns that are no feed fields
    are left out, so they cannot clash with other sources' columns.
    """
    fields = [c for c in popularity.columns if c in ("app_id", *POPULARITY_FIELDS)]
    df = cast_key(rename_key(popularity.select(*fields))).filter(F.col("app_id").isNotNull())
    return dedup_first(df, ["app_id"], [c for c in df.columns if c != "app_id"])


def clean_categories(categories: DataFrame) -> DataFrame:
    """Lookup keyed by ``lower(genre)``; ``Action`` and ``action`` collapse."""
    df = categories.select(
        F.lower(F.col("genre")).alias("genre_key"),
        F.col("genre"),
        F.col("category").alias("genre_category"),
    )
    return dedup_first(df, ["genre_key"], ["genre", "genre_category"]).select("genre_key", "genre_category")


def clean_recs(recs: DataFrame, review_order: tuple[str, ...] = ()) -> DataFrame:
    """INT key, drop rows without key or flag, one review per (game, user).

    No ``user_id`` column → no de-duplication. Null users compare equal, so a
    game's null-user reviews collapse to one (as ``dropDuplicates`` does).
    The survivor is the first in ``review_order``, else by a hash of the row.
    """
    df = drop_incomplete(cast_key(recs), ["app_id", "is_recommended"])
    if "user_id" in df.columns:
        df = dedup_first(df, ["app_id", "user_id"], list(review_order) or None)
    return df.withColumn("is_recommended_num", flag_to_int("is_recommended"))


# --------------------------------------------------------------------------- #
#  Joins (each keeps the left side's rows; dims are unique on their key)
# --------------------------------------------------------------------------- #
#  No join carries a hint: AQE broadcasts a side once its measured size is
#  below its threshold, and splits skewed partitions otherwise.

def join_metadata(games: DataFrame, metadata: DataFrame) -> DataFrame:
    """games ⟕ metadata on ``app_id``; without metadata ``tag_count`` is 0."""
    return games.join(metadata, "app_id", "left").withColumn("tag_count", F.coalesce("tag_count", F.lit(0)))


def join_reviews(games: DataFrame, reviews: DataFrame) -> DataFrame:
    """Inner join: reviewless games and reviews of unknown games vanish.

    A review column that a game column has the name of is prefixed ``review_``.
    """
    clash = {c: f"review_{c}" for c in reviews.columns if c in games.columns and c != "app_id"}
    return games.join(reviews.withColumnsRenamed(clash), "app_id", "inner")


def reviews_of(recs: DataFrame, games: DataFrame) -> DataFrame:
    """The raw reviews of known games: a semi-join on the INT key, before any review is shuffled.

    Its right side has one row per game; where Spark knows it to be small it is
    broadcast and the filter runs in the scan of the reviews.
    """
    keyed = cast_key(recs)
    return keyed.join(games.select("app_id"), "app_id", "left_semi").select(*recs.columns)


def enrich_known_reviews(sources: Sources, options: Options = Options()) -> DataFrame:
    """``enrich_reviews`` with the reviews of unknown games left out before the de-duplication shuffles them.

    The finished game rows are written first: their size is then known, and they
    are computed once for the filter and for the join.
    """
    from crosslink.session import scratch_path

    spark = sources.games.sparkSession
    path = scratch_path(spark, "known_games")
    game_dimensions(clean_games(sources.games), sources, options).write.parquet(path)
    games = spark.read.parquet(path)
    return join_reviews(games, clean_recs(reviews_of(sources.recs, games), sources.review_order))


def join_popularity(df: DataFrame, popularity: DataFrame) -> DataFrame:
    """⟕ popularity feed on ``app_id``."""
    return df.join(popularity, "app_id", "left")


def join_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """⟕ category lookup on ``lower(primary_tag) = lower(genre)``."""
    df = df.withColumn(_TAG_KEY, spread_nulls(F.lower(df["primary_tag"]), df["app_id"]))
    return df.join(categories, df[_TAG_KEY] == categories["genre_key"], "left").drop("genre_key", _TAG_KEY)


def game_dimensions(
    base: DataFrame,
    sources: Sources,
    options: Options = Options(),
    provenance: bool = False,
) -> DataFrame:
    """Attach every dimension to a game-grain frame holding ``app_id, title``.

    metadata (→ tag_count, primary_tag) → popularity → category → KB (two
    stages), in the reference's order; all joins are left joins.
    """
    from crosslink.operators.resolve import resolve_entities

    df = join_metadata(base, clean_metadata(sources.metadata))
    df = join_popularity(df, clean_popularity(sources.popularity))
    df = join_category(df, clean_categories(sources.categories))
    if sources.kb is not None:
        df = resolve_entities(df, sources.kb, options, provenance=provenance)
    return df


def enrich_reviews(sources: Sources, options: Options = Options()) -> DataFrame:
    """The enriched review-grain table (one row per surviving review).

    Dimensions are assembled at game grain first, then joined to the reviews
    once on ``app_id``; the reviews are never joined to a dimension directly.
    A game with a third of all reviews makes a skewed partition of that join,
    which AQE splits (or avoids by broadcasting the games, if they measure
    small).
    """
    games = game_dimensions(clean_games(sources.games), sources, options)
    return join_reviews(games, clean_recs(sources.recs, sources.review_order))
