"""Incremental forms of the job: knowledge-base pages, reviews and per-game sums, batch by batch.

Each equals one run over all batches, whatever the split: first-wins rules have
a total order, so the survivor among survivors is the survivor among all rows.
A batch shuffles its own rows and the state's rows of the same keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from crosslink.config import Options
from crosslink.operators.aggregate import FLAGS_PRESENT, facts_of, result_columns
from crosslink.operators.clean import cast_key, dedup_first, drop_incomplete
from crosslink.functions import flag_to_int
from crosslink.segments import SegmentStore
from crosslink.session import scratch_path
from crosslink.sources.payloads import ARRIVAL_ORDER, dedup_kb_by_qid, parse_kb_bindings
from crosslink.sources.readers import Sources

REVIEW_KEYS = ("app_id", "user_id")
SIGN = "__crosslink_sign"
_USER = "__crosslink_user"
_OLD = "__crosslink_old_"
_MET = "__crosslink_met"


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: a batch is evaluated once."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------- #
#  Knowledge-base pages
# --------------------------------------------------------------------------- #

BINDINGS = StructType(
    [StructField("page_no", LongType()), StructField("pos", IntegerType()), StructField("wikidata_qid", StringType()), StructField("wikidata_uri", StringType()), StructField("steam_app_id", IntegerType())]
    + [StructField(c, StringType()) for c in ("name", "release_date", "metacritic", "publisher", "country")]
)


def kb_store(spark: SparkSession, path: str) -> SegmentStore:
    """The committed knowledge base below ``path``: frame ``bindings``; its mark is ``page,position``."""
    return SegmentStore(spark, path, bindings=BINDINGS)


def merge_kb_pages(store: SegmentStore, pages: DataFrame, batch: str) -> bool:
    """Add the bindings beyond the high-water mark to the committed snapshot, the first of each entity.

    Bindings arrive in the order (page, position); those up to the mark were
    taken before and are passed over, so pages may come again, or a page again
    with more bindings.  An entity that the snapshot has stays as it is there;
    bindings without an entity id are all kept.  False if the batch was committed
    before or brings nothing new.
    """
    spark = pages.sparkSession
    after = (-1, -1) if (mark := store.mark()) is None else tuple(map(int, mark.split(",")))
    # whole pages below the mark are not parsed
    flat = parse_kb_bindings(pages.where(F.col("page_no") >= after[0])).withColumn("page_no", F.col("page_no").cast("long"))
    flat = _written(spark, flat.where((F.col("page_no") > after[0]) | (F.col("pos") > after[1])), "kb_new")
    reached = flat.agg(F.max(F.struct("page_no", "pos")).alias("m")).first()["m"]
    if reached is None:
        return False
    new = dedup_kb_by_qid(flat, ARRIVAL_ORDER)
    keyless = F.col("wikidata_qid").isNull() | (F.col("wikidata_qid") == "")
    keyed = new.where(~keyless)
    # the batch's keys select from the snapshot, so the snapshot is never shuffled whole for a small batch
    known = store.read("bindings").select("wikidata_qid").join(keyed.select("wikidata_qid"), "wikidata_qid", "left_semi").distinct()
    fresh = keyed.join(known, "wikidata_qid", "left_anti").unionByName(new.where(keyless))
    return store.append(batch, {"bindings": fresh}, mark=f"{reached['page_no']},{reached['pos']}")


# --------------------------------------------------------------------------- #
#  Reviews
# --------------------------------------------------------------------------- #

STATS = StructType([StructField("app_id", IntegerType())] + [StructField(c, LongType()) for c in ("num_reviews", "num_positive_reviews", FLAGS_PRESENT)])


def review_store(spark: SparkSession, path: str, recs: DataFrame) -> SegmentStore:
    """The review state below ``path``, for reviews with the columns of ``recs``.

    Frame ``changes``: each batch's new survivors (sign 1) and those that they
    replace (sign -1).  Frame ``stats``: the batch's per-game sums of the signs.
    """
    clean = _clean(recs).schema
    return SegmentStore(spark, path, changes=StructType([*clean.fields, StructField(SIGN, IntegerType())]), stats=STATS)


def _clean(recs: DataFrame) -> DataFrame:
    return drop_incomplete(cast_key(recs), ["app_id", "is_recommended"])


def _survivors(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first of each (game, user) among all survivors that batches ever added."""
    return dedup_first(changes.where(F.col(SIGN) > 0).drop(SIGN), list(REVIEW_KEYS), list(order) or None)


def _with_user(df: DataFrame) -> DataFrame:
    """With the user as a key that is never null: null users compare equal, as in the full run, also in a join."""
    return df.withColumn(_USER, F.struct("user_id"))


def _places(columns: Sequence[str], order: Sequence[str], name: Callable[[str], str] = str) -> list[Column]:
    """The columns that order survivors; without ``order`` a hash of the row, then the row."""
    at = lambda c: F.col(f"`{name(c)}`")
    if order:
        return [at(c) for c in order]
    return [F.xxhash64(*[at(c) for c in sorted(columns)]), *(at(c) for c in columns if c not in REVIEW_KEYS)]


def _before(places: Sequence[Column], others: Sequence[Column]) -> Column:
    """Whether a row comes before another in the order of survivors, nulls last."""
    one = lambda cs: F.struct(*[x.alias(f"p{k}") for k, x in enumerate(y for c in cs for y in (c.isNull(), c))])
    return one(places) < one(others)


def review_changes(state: DataFrame, recs: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """What a batch changes: its reviews that become survivors (sign 1), and the survivors they replace (sign -1).

    The batch's own survivors are written, so they are found once for the choice
    of the state's rows and for the comparison. All steps are dealt by game and
    user alike, so the state's rows are shuffled once.
    """
    clean = _clean(recs)
    first = dedup_first(clean, list(REVIEW_KEYS), list(order) or None)
    first = _with_user(_written(recs.sparkSession, first, "batch"))
    keys = ["app_id", _USER]
    met = _with_user(state.where(F.col(SIGN) > 0).drop(SIGN)).join(first.select(*keys), keys, "left_semi")
    # a segment has a key once, so the rows of a key are few
    old = dedup_first(met, keys, [c.asc_nulls_last() for c in _places(clean.columns, order)])
    name = lambda c: c if c in keys else _OLD + c
    old = old.withColumnsRenamed({c: name(c) for c in clean.columns}).withColumn(_MET, F.lit(True))
    replaces = F.col(_MET).isNotNull()
    # of equal places the state's review stays
    earlier = _before(_places(clean.columns, order), _places(clean.columns, order, name))
    won = first.join(old, keys, "left").where(~replaces | earlier)
    row = lambda own, sign: F.struct(*[F.col(f"`{own(c)}`").alias(c) for c in clean.columns], F.lit(sign).alias(SIGN))
    return won.select(F.inline(F.array_compact(F.array(row(str, 1), F.when(replaces, row(name, -1))))))


def add_reviews(store: SegmentStore, recs: DataFrame, batch: str, order: Sequence[str] = ()) -> bool:
    """Apply a batch of reviews: its changes and their per-game sums, in one commit. False if it was applied before."""
    commits = store.commits()
    if any(c.batch == batch for c in commits):
        return False
    if commits:
        changes = review_changes(store.read("changes"), recs, order)
    else:  # nothing to replace
        changes = dedup_first(_clean(recs), list(REVIEW_KEYS), list(order) or None).withColumn(SIGN, F.lit(1))
    return store.append(batch, {"changes": changes, "stats": lambda written: signed_stats(written["changes"])})


def signed_stats(changes: DataFrame) -> DataFrame:
    """Per-game sums of a batch's changes: what it adds to the counts, less what it takes back."""
    sign = F.col(SIGN).cast("long")
    flag = F.when(F.col("is_recommended").isNotNull(), sign).otherwise(F.lit(0).cast("long"))
    return changes.groupBy("app_id").agg(
        F.sum(sign).alias("num_reviews"), F.sum(sign * flag_to_int("is_recommended")).alias("num_positive_reviews"), F.sum(flag).alias(FLAGS_PRESENT)
    )


def current_reviews(store: SegmentStore, order: Sequence[str] = ()) -> DataFrame:
    """The surviving reviews of all batches, as ``enrich.clean_recs`` gives them for all reviews at once."""
    return _survivors(store.read("changes"), order).withColumn("is_recommended_num", flag_to_int("is_recommended"))


def current_stats(store: SegmentStore) -> DataFrame:
    """Per-game statistics from the batches' sums; the reviews are not read."""
    sums = store.read("stats").groupBy("app_id").agg(*(F.sum(c).alias(c) for c in ("num_reviews", "num_positive_reviews", FLAGS_PRESENT)))
    rate = F.col("num_positive_reviews") / F.col("num_reviews")
    return sums.where("num_reviews > 0").select("app_id", rate.alias("steam_recommend_rate"), "num_reviews", "num_positive_reviews", FLAGS_PRESENT)


def current_summary(store: SegmentStore, sources: Sources, options: Options = Options()) -> DataFrame:
    """The result table of all batches: per-game sums, then the dimensions."""
    facts = facts_of(current_stats(store), sources, options, provenance=False)
    return facts.select(*result_columns(facts))


def compact_reviews(store: SegmentStore, order: Sequence[str] = ()) -> None:
    """One segment that stands for all so far: the survivors, and each game's sums."""
    live = _survivors(store.read("changes"), order).withColumn(SIGN, F.lit(1))
    store.compact({"changes": live, "stats": lambda written: signed_stats(written["changes"])})
