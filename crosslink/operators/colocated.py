"""Reviews and games stored side by side, so that later joins shuffle neither.

Both tables are bucketed by (app_id, slot).  A review's slot is a hash of its
user, so a game with a third of all reviews lies in ``slots`` buckets rather than
in one; a game's dimension row is stored once for each slot, which multiplies a
table of one row per game by a fixed number.  A review meets its game in its own
bucket, and every user of a game has one slot, so what is unique by (game, user)
stays so within a bucket.

The reviews are cleaned when they are stored, and only then shuffled: once to
de-duplicate them and once into their buckets.  Each later join reads the buckets
as they lie; a later aggregate by game shuffles partial sums.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslink.config import Options
from crosslink.operators import aggregate, enrich
from crosslink.session import scratch_path
from crosslink.sources.readers import Sources

SLOT = "_slot"
SLOTS = 16
KEYS = ("app_id", SLOT)


@dataclass(frozen=True)
class CoLocated:
    """Names of the two bucketed tables."""

    spark: SparkSession
    reviews: str
    games: str

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)


def slot_of(user: str, slots: int):
    """Slot of a review; reviews without a user have one too."""
    return F.pmod(F.xxhash64(user), F.lit(slots)).cast("int")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """One file a bucket: the rows are dealt by the bucket's own hash first."""
    dealt = df.repartition(buckets, *KEYS)
    dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(name)


def store(sources: Sources, options: Options = Options(), path: str | None = None, name: str | None = None, buckets: int | None = None, slots: int = SLOTS) -> CoLocated:
    """Clean the sources and store reviews and games in ``buckets`` buckets each.

    ``buckets`` is the session's number of shuffle partitions by default (about one
    for 128 MB of reviews).  Without ``path`` the tables lie in the scratch folder
    and end with the program.  A second call with the same name replaces them.
    """
    spark = sources.recs.sparkSession
    if SLOT in sources.recs.columns:
        raise ValueError(f"the reviews have a column {SLOT} of their own")
    path = path or scratch_path(spark, "colocated")
    name = name or f"colocated_{uuid.uuid4().hex[:12]}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = CoLocated(spark, f"{name}_reviews", f"{name}_games")

    reviews = enrich.clean_recs(sources.recs, sources.review_order)
    slot = slot_of("user_id", slots) if "user_id" in reviews.columns else F.pmod(F.xxhash64(*reviews.columns), F.lit(slots)).cast("int")
    write_bucketed(reviews.withColumn(SLOT, slot), out.reviews, f"{path}/reviews", buckets)

    games = enrich.game_dimensions(enrich.clean_games(sources.games), sources, options)
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias(SLOT)
    write_bucketed(games.select("*", every), out.games, f"{path}/games", buckets)
    return out


def enriched(stored: CoLocated) -> DataFrame:
    """``enrich_reviews`` from the stored tables: bucket meets bucket, nothing is shuffled."""
    reviews, games = stored.read(stored.reviews), stored.read(stored.games)
    clash = {c: f"review_{c}" for c in reviews.columns if c in games.columns and c not in KEYS}
    return games.join(reviews.withColumnsRenamed(clash), list(KEYS)).drop(SLOT)


def summary(stored: CoLocated) -> DataFrame:
    """``game_summary`` from the stored tables: a game sends one row of partial sums from each of its buckets."""
    stats = aggregate.review_stats(stored.read(stored.reviews))
    facts = stats.join(stored.read(stored.games).where(F.col(SLOT) == 0), "app_id")
    return facts.select(*aggregate.result_columns(facts))
