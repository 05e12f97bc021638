"""Queries over files that drift, and over state that grows batch by batch.

The stand-in files are derived from the test tables with Spark and written
first: feeds whose schema differs from day to day, a review file with cells and
rows that do not parse, JSON lines whose keys drift.  Batches are shares of the
same tables, so that each incremental query has the result of one full run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegerType, LongType, StringType, StructField, StructType

from crosslink import schemas
from crosslink.operators import aggregate, colocated, enrich, history, incremental, quality
from crosslink.session import scratch_path
from crosslink.sources import payloads, standins
from crosslink.sources.conformance import schema_conformance
from crosslink.sources.ledger import key_census, malformed_lines, rejected_cells

FEED = StructType([StructField("appid", IntegerType(), False), StructField("price", IntegerType()), StructField("ccu", LongType())])
TAG_LINES = StructType([StructField("app_id", LongType()), StructField("tags", ArrayType(StringType())), StructField("notes", StringType())])
LOOSE_REVIEWS = StructType(
    [StructField("app_id", StringType()), StructField("user_id", LongType()), StructField("l_orderkey", LongType()), StructField("l_shipdate", DateType()), StructField("is_recommended", StringType())]
)
TOP = ("NATION_15", 25, 10)


# ---- files that drift ---------------------------------------------------------

def write_feed(spark: SparkSession, sf_dir: str) -> str:
    """The popularity feed as Parquet, one folder a day; each day after the first departs from FEED in its own way."""
    part = standins.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    appid = F.coalesce(key.cast("int"), F.lit(0)).alias("appid")
    price, ccu = F.floor("p_retailprice").cast("int").alias("price"), F.col("p_size").cast("bigint").alias("ccu")
    days = [
        [appid, price, ccu],
        [appid, ccu],
        [appid, price, ccu, F.col("p_name").alias("note")],
        [appid, price.cast("smallint").alias("price"), ccu],
        [appid, price.cast("bigint").alias("price"), ccu.cast("double").alias("ccu")],
        [key.cast("int").alias("appid"), price.cast("string").alias("price"), ccu],
    ]
    path = scratch_path(spark, "feed")
    for d, columns in enumerate(days):
        part.where(key % len(days) == d).select(*columns).write.parquet(f"{path}/day={d}")
    return path


def write_games_days(spark: SparkSession, sf_dir: str) -> str:
    """The games as CSV: the first day as declared, the second without keys and with a further column."""
    games = standins.games(spark, sf_dir).withColumn("title", F.coalesce("title", F.lit("none")))
    path = scratch_path(spark, "games_days")
    games.where("app_id % 2 = 0").write.option("header", True).csv(f"{path}/day=0")
    games.where("app_id % 2 = 1").select("title", F.lit("x").alias("extra note")).write.option("header", True).csv(f"{path}/day=1")
    return path


def write_tags_days(spark: SparkSession, sf_dir: str) -> str:
    """The tags as JSON lines: the first day as declared, the second with text keys, without tags, with a further key."""
    part = standins.table(spark, sf_dir, "part")
    path = scratch_path(spark, "tags_days")
    first = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("app_id"), F.split("p_name", " ").alias("tags"), F.col("p_brand").alias("notes"))
    first.write.json(f"{path}/day=0")
    second = part.where("p_partkey % 2 = 1").select(F.col("p_partkey").cast("string").alias("app_id"), F.col("p_brand").alias("notes"), F.struct(F.col("p_size").alias("size")).alias("box"))
    second.write.json(f"{path}/day=1")
    return path


def q_schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day of three feeds (Parquet footers, CSV headers, JSON keys): what its files have otherwise than declared, and their rows."""
    found = [
        schema_conformance(spark, write_feed(spark, sf_dir), FEED, "popularity", "parquet"),
        schema_conformance(spark, write_games_days(spark, sf_dir), schemas.GAMES, "games", "csv"),
        schema_conformance(spark, write_tags_days(spark, sf_dir), TAG_LINES, "metadata", "json"),
    ]
    files = reduce(DataFrame.unionByName, found).withColumn("day", F.regexp_extract("file", r"day=(\d+)", 1).cast("int"))
    return files.groupBy("source", "day", "column", "expected", "found", "kind").agg(F.sum("num_rows").alias("num_rows"))


def write_loose_reviews(spark: SparkSession, sf_dir: str) -> str:
    """Reviews as CSV of which some keys, numbers and dates do not parse, and some rows have too many or few cells."""
    item = standins.table(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey")
    cells = F.concat_ws(
        ",",
        F.when(order % 53 == 0, F.concat(F.lit("x"), F.col("l_partkey").cast("string"))).otherwise(F.col("l_partkey").cast("string")),
        F.col("l_suppkey").cast("string"),
        F.when(order % 59 == 0, F.lit("99999999999999999999")).otherwise(order.cast("string")),
        F.when(order % 47 == 0, F.lit("soon")).otherwise(F.col("l_shipdate").cast("date").cast("string")),
        F.lit("True"),
    )
    line = F.when(order % 61 == 0, F.concat(cells, F.lit(",more"))).when(order % 67 == 0, F.concat_ws(",", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))).otherwise(cells)
    path = scratch_path(spark, "loose_reviews")
    # one column whose name is the header line; its separator occurs in no line, so nothing is quoted
    item.select(line.alias(",".join(LOOSE_REVIEWS.names))).write.option("header", True).option("sep", "\u0001").csv(path)
    return path


def q_rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell and row that the permissive reader of the reviews loses, with its raw text."""
    return rejected_cells(spark, write_loose_reviews(spark, sf_dir), LOOSE_REVIEWS, "recs").drop("file")


def write_loose_tags(spark: SparkSession, sf_dir: str) -> str:
    """Tags as JSON lines of which some are cut short, some are no objects, some blank, and some have other keys or types."""
    part = standins.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    tags = F.split("p_name", " ")
    whole = F.to_json(F.struct(key.alias("app_id"), tags.alias("tags")))
    line = (
        F.when(key % 10 == 3, F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(key % 10 == 4, F.lit("[1, 2]"))
        .when(key % 10 == 5, F.lit("  "))
        .when(key % 10 == 6, F.to_json(F.struct(key.alias("app_id"), tags.alias("tags"), F.col("p_size").alias("pages"))))
        .when(key % 10 == 7, F.to_json(F.struct(key.cast("string").alias("app_id"), tags.alias("tags"))))
        .when(key % 10 == 8, F.concat(F.lit('{"app_id":null,"tags":["'), F.col("p_brand"), F.lit('"]}')))
        .when(key % 10 == 9, F.to_json(F.struct(key.alias("app_id"))))
        .otherwise(whole)
    )
    path = scratch_path(spark, "loose_tags")
    part.select(line.alias("value")).write.text(path)
    return path


def q_json_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The census of the keys of JSON lines, and (without a key) the number of lines that hold no object."""
    path = write_loose_tags(spark, sf_dir)
    census = key_census(spark, path, TAG_LINES, "metadata")
    lost = malformed_lines(spark, path, "metadata").agg(F.count(F.lit(1)).alias("lines"))
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")
    lost = lost.select(F.lit("metadata").alias("source"), none.alias("key"), F.lit("json object").alias("expected"), none.alias("found"), "lines", zero.alias("absent"), zero.alias("nulls"), F.lit("malformed").alias("kind"))
    return census.unionByName(lost)


# ---- batches ------------------------------------------------------------------

def q_merge_kb_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The knowledge base acquired in three runs; the second brings the last page of the first again, the third an applied batch."""
    pages = payloads.kb_payload_pages(spark, sf_dir)
    path = scratch_path(spark, "kb_pages")
    pages.write.parquet(path)
    pages = spark.read.parquet(path)
    store = incremental.kb_store(spark, scratch_path(spark, "kb_state"))
    last = pages.agg(F.max("page_no")).first()[0] or 0
    for batch, (begin, end) in enumerate(((0, last // 3), (last // 3, 2 * last // 3), (2 * last // 3, last))):
        incremental.merge_kb_pages(store, pages.where(F.col("page_no").between(begin, end)), f"run-{batch}")
    incremental.merge_kb_pages(store, pages, "run-1")
    return store.read("bindings").withColumn("page_no", F.col("page_no").cast("long"))


def _review_batches(spark: SparkSession, sf_dir: str):
    """The state after three batches of reviews, of which each has reviews that replace survivors of the one before."""
    src = standins.standin_sources(spark, sf_dir)
    store = incremental.review_store(spark, scratch_path(spark, "review_state"), src.recs)
    for batch in (2, 1, 0):
        incremental.add_reviews(store, src.recs.where(F.coalesce(F.pmod("l_orderkey", F.lit(3)), F.lit(0)) == batch), f"batch-{batch}", src.review_order)
        if batch == 1:
            incremental.compact_reviews(store, src.review_order)
    return store, src


def q_dedup_reviews_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving reviews after three batches and a compaction."""
    store, src = _review_batches(spark, sf_dir)
    return incremental.current_reviews(store, src.review_order).drop("l_shipdate")


def q_game_summary_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship summary from the per-game sums of three batches."""
    store, src = _review_batches(spark, sf_dir)
    return incremental.current_summary(store, src)


def q_metric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of two runs, the first before the reviews of even orders came: what changed."""
    src = standins.standin_sources(spark, sf_dir)
    store = history.history_store(spark, scratch_path(spark, "history"))
    earlier = replace(src, recs=src.recs.where(F.coalesce(F.col("l_orderkey") % 2, F.lit(1)) == 1))
    for run, sources in (("first", earlier), ("second", src)):
        history.record_run(store, run, quality.dq_report(sources, aggregate.game_facts(sources, provenance=True)))
    return history.metric_drift(store)


# ---- plans that filter first ------------------------------------------------------

def q_top_in_country_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.top_in_country_first(standins.standin_sources(spark, sf_dir), *TOP)


def q_enrich_known_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_known_reviews(standins.standin_sources(spark, sf_dir)).drop("l_shipdate")


def q_enrich_reviews_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched reviews from tables that were stored in buckets."""
    return colocated.enriched(colocated.store(standins.standin_sources(spark, sf_dir))).drop("l_shipdate")


def q_game_summary_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return colocated.summary(colocated.store(standins.standin_sources(spark, sf_dir)))


STATE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "schema_conformance": q_schema_conformance,
    "rejected_cells": q_rejected_cells,
    "json_drift": q_json_drift,
    "merge_kb_pages": q_merge_kb_pages,
    "dedup_reviews_delta": q_dedup_reviews_delta,
    "game_summary_delta": q_game_summary_delta,
    "metric_drift": q_metric_drift,
    "top_in_country_first": q_top_in_country_first,
    "enrich_known_reviews": q_enrich_known_reviews,
    "enrich_reviews_colocated": q_enrich_reviews_colocated,
    "game_summary_colocated": q_game_summary_colocated,
}
