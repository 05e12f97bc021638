"""Query registry: one DataFrame plan per operator of the inventory.

Each query takes ``(spark, sf_dir)``, derives the stand-in sources from the
test tables with Spark and returns a lazy DataFrame (round-trip queries
write to the shared scratch folder first). Every computed column is aliased
to the name used by the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from crosslink import schemas
from crosslink.config import Options
from crosslink.functions import flag_to_int, normalize_title, primary_tag, tag_count, to_int_key
from crosslink.operators import aggregate, clean, enrich, quality, resolve
from crosslink.plans.pipeline import run_pipeline
from crosslink.plans.queries_state import STATE_QUERIES
from crosslink.session import scratch_path
from crosslink.sinks import write_csv, write_csv_preview, write_json_lines, write_parquet
from crosslink.sources import payloads, standins
from crosslink.sources.contract import require
from crosslink.sources.readers import SourcePaths, load_sources, read_csv, read_json_lines

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the consumer queries (top-k report and cap are the feature).
TOP_COUNTRY = "NATION_15"
TOP_MIN_REVIEWS = 25
TOP_K = 10
CAP_ROWS = 1000
SAMPLE_N = 5
PREVIEW_N = 100
MAX_NULL_RATE = 0.015  # of the raw columns: titles are null in 2 %, flags in 1 %
REQUIRED_TABLES = ("part", "supplier", "orders", "lineitem")
NULL_RATE_COLUMNS = (
    "app_id", "title", "is_recommended", "primary_tag", "genre_category", "price", "wd_publisher",
)


def _src(spark: SparkSession, sf_dir: str, with_kb: bool = True):
    return standins.standin_sources(spark, sf_dir, with_kb=with_kb)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.game_summary(_src(spark, sf_dir))


def _games_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return enrich.join_metadata(enrich.clean_games(s.games), enrich.clean_metadata(s.metadata))


# ---- A: sources ------------------------------------------------------------

REVIEWS_CSV = StructType(
    [
        StructField("app_id", IntegerType()),
        StructField("user_id", LongType()),
        StructField("is_recommended", StringType()),
        StructField("l_orderkey", LongType()),
        StructField("l_linenumber", IntegerType()),
    ]
)


def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as CSV (header) and read back by header name."""
    r = standins.reviews(spark, sf_dir).drop("l_shipdate")
    # Columns written in a different order than read: the reader maps by name.
    r = r.select("l_linenumber", "is_recommended", "l_orderkey", "user_id", "app_id")
    path = write_csv(r, scratch_path(spark, "reviews_csv"))
    return read_csv(spark, path, REVIEWS_CSV)


def q_scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KB rows written as JSON lines, ids bare or quoted, and read back with the explicit schema."""
    path = _write_kb_lines(spark, sf_dir)
    return read_json_lines(spark, path, schemas.KB).withColumn("steam_app_id", to_int_key("steam_app_id"))


def _write_kb_lines(spark: SparkSession, sf_dir: str) -> str:
    """The KB as JSON lines: ids of half the entities as numbers, all others as text."""
    kb = standins.knowledge_base(spark, sf_dir)
    bare = F.to_json(F.struct(*[to_int_key(c).alias(c) if c == "steam_app_id" else F.col(c) for c in kb.columns]))
    number = F.when(F.col("steam_app_id").rlike("[0-9]"), to_int_key("steam_app_id"))  # the cast is slow on other texts
    line = F.when(number.isNotNull() & (number % 2 == 0), bare).otherwise(F.to_json(F.struct(*kb.columns)))
    path = scratch_path(spark, "kb_jsonl")
    kb.select(line.alias("value")).write.text(path)
    return path


def _file_paths(spark: SparkSession, sf_dir: str) -> SourcePaths:
    """The stand-ins written as files, columns in another order and with columns of no use to the job."""
    s = _src(spark, sf_dir)
    at = lambda name: scratch_path(spark, name)
    extra = F.lit("x").alias("note")
    return SourcePaths(
        games=write_csv(s.games.select(extra, "title", "app_id"), at("games_csv")),
        metadata=write_json_lines(s.metadata.select(extra, "tags", "app_id"), at("metadata_jsonl")),
        recs=write_csv(
            s.recs.select("l_linenumber", extra, "is_recommended", "l_orderkey", "user_id", "l_shipdate", "app_id"), at("recs_csv")
        ),
        popularity=write_csv(s.popularity.select("price", extra, "appid"), at("popularity_csv")),
        categories=write_csv(s.categories.select(extra, "category", "genre"), at("categories_csv")),
        kb=_write_kb_lines(spark, sf_dir),
        review_order=standins.REVIEW_ORDER,
        review_types={"l_shipdate": "date", "l_orderkey": "bigint", "l_linenumber": "int"},
    )


def q_load_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files → ``load_sources`` → the flagship summary."""
    return aggregate.game_summary(load_sources(spark, _file_paths(spark, sf_dir)))


def q_run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files → ``load_sources`` → ``run_pipeline``; the written result, read back."""
    sources = load_sources(spark, _file_paths(spark, sf_dir))
    return run_pipeline(spark, sources, scratch_path(spark, "job")).result


def q_required_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the given tables pass the required-source contract; one absent path does not."""
    names = [*sorted(REQUIRED_TABLES), "absent"]
    found = []
    for name in names:
        try:
            require(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
            found.append(standins.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("source"), F.lit(True).alias("present"), "num_rows"))
        except FileNotFoundError:
            found.append(spark.range(1).select(F.lit(name).alias("source"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("num_rows")))
    return reduce(DataFrame.unionByName, found)


def q_optional_kb_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.game_summary(_src(spark, sf_dir, with_kb=False))


def q_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.record_counts(_src(spark, sf_dir))


def q_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_parquet(_summary(spark, sf_dir), scratch_path(spark, "result_parquet"))
    return spark.read.parquet(path)


def q_parse_kb_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.parse_kb_bindings(payloads.kb_payload_pages(spark, sf_dir)).drop("page_no", "pos")


def q_parse_popularity_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.parse_popularity_payload(payloads.popularity_payload_pages(spark, sf_dir))


def q_cap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = payloads.parse_kb_bindings(payloads.kb_payload_pages(spark, sf_dir))
    return payloads.cap_rows(flat, CAP_ROWS)


# ---- B: sinks ---------------------------------------------------------------

def q_csv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    parquet = write_parquet(_summary(spark, sf_dir), scratch_path(spark, "result_parquet"))
    csv = write_csv_preview(spark, parquet, scratch_path(spark, "preview_csv"), n=PREVIEW_N)
    return read_csv(spark, csv, schemas.RESULT)


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return quality.dq_report(s, aggregate.game_facts(s, provenance=True))


# ---- C: projections / scalars ------------------------------------------------

def q_cast_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = standins.knowledge_base(spark, sf_dir)
    return kb.select(
        "wikidata_qid",
        F.col("steam_app_id").alias("steam_app_id_raw"),
        to_int_key("steam_app_id").alias("steam_app_id"),
    )


def q_rename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.cast_key(clean.rename_key(standins.popularity(spark, sf_dir)))


def q_project_kb(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = standins.knowledge_base(spark, sf_dir)
    return resolve.project_kb(kb, "app_id", to_int_key("steam_app_id"))


def q_tag_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = standins.metadata(spark, sf_dir)
    return m.select(to_int_key("app_id").alias("app_id"), tag_count("tags").alias("tag_count"))


def q_primary_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = standins.metadata(spark, sf_dir)
    return m.select(to_int_key("app_id").alias("app_id"), primary_tag("tags").alias("primary_tag"))


def q_flag_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = standins.reviews(spark, sf_dir)
    return r.select(
        "l_orderkey", "l_linenumber", "is_recommended",
        flag_to_int("is_recommended").alias("is_recommended_num"),
    )


def q_normalize_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts through the title normalizer."""
    docs = standins.table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalize_title("text").alias("title_key"))


def q_coalesce_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field-wise vs entity-wise fallback, side by side."""
    s = _src(spark, sf_dir)
    games = enrich.clean_games(s.games)
    staged = resolve.join_kb_by_title(resolve.join_kb_by_id(games, s.kb), s.kb)
    field = resolve.coalesce_fields(staged, "field")
    entity = resolve.coalesce_fields(staged, "entity")
    cols = [r for _, r in schemas.KB_RESULT_FIELDS]
    return field.select("app_id", *cols).join(
        entity.select("app_id", *[F.col(c).alias(c + "_entity") for c in cols]), "app_id"
    )


def q_join_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return enrich.join_category(_games_meta(spark, sf_dir), enrich.clean_categories(s.categories)).select(
        "app_id", "primary_tag", "genre_category"
    )


# ---- D: filters ---------------------------------------------------------------

def q_dropna_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before / after the required-field filter, per source."""
    s = _src(spark, sf_dir)
    specs = [
        ("games", s.games, ["app_id", "title"]),
        ("metadata", s.metadata, ["app_id"]),
        ("recs", s.recs, ["app_id", "is_recommended"]),
    ]
    out = None
    for name, df, subset in specs:
        keyed = clean.cast_key(df)
        before = keyed.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("source"), F.lit("before").alias("stage"), "n"
        )
        after = clean.drop_incomplete(keyed, subset).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("source"), F.lit("after").alias("stage"), "n"
        )
        part = before.unionByName(after)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("source").agg(
        F.sum(F.when(F.col("stage") == "before", F.col("n"))).alias("rows_before"),
        F.sum(F.when(F.col("stage") == "after", F.col("n"))).alias("rows_after"),
    )


def q_filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = standins.knowledge_base(spark, sf_dir).select(
        "wikidata_qid", to_int_key("steam_app_id").alias("steam_app_id")
    )
    return clean.filter_not_null(kb, "steam_app_id")


def q_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_rates(enrich.enrich_reviews(_src(spark, sf_dir)), NULL_RATE_COLUMNS)


def q_top_in_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.top_in_country(_summary(spark, sf_dir), TOP_COUNTRY, TOP_MIN_REVIEWS, TOP_K)


# ---- E: dedup -----------------------------------------------------------------

def q_dedup_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return enrich.clean_recs(s.recs, s.review_order).drop("l_shipdate")


def q_dedup_kb_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.kb_by_id(standins.knowledge_base(spark, sf_dir))


def q_dedup_kb_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.kb_by_title(standins.knowledge_base(spark, sf_dir))


def q_dedup_kb_by_qid(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = payloads.parse_kb_bindings(payloads.kb_payload_pages(spark, sf_dir))
    return payloads.dedup_kb_by_qid(flat)


def q_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return quality.match_rate(aggregate.game_facts(s, provenance=True))


# ---- F: joins -----------------------------------------------------------------

def q_join_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games_meta(spark, sf_dir).select("app_id", "title", "tag_count")


def q_join_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    df = enrich.join_reviews(_games_meta(spark, sf_dir), enrich.clean_recs(s.recs, s.review_order))
    return df.select("app_id", "title", "tag_count", "user_id", "l_orderkey", "l_linenumber", "is_recommended_num")


def q_join_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return enrich.join_popularity(enrich.clean_games(s.games), enrich.clean_popularity(s.popularity))


def q_join_kb_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return resolve.join_kb_by_id(enrich.clean_games(s.games), s.kb).drop(resolve.ID_HIT)


def q_join_kb_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return resolve.join_kb_by_title(enrich.clean_games(s.games), s.kb).drop(resolve.TITLE_HIT)


def q_resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    return resolve.resolve_entities(enrich.clean_games(s.games), s.kb, provenance=True)


def q_enrich_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enrich.enrich_reviews(_src(spark, sf_dir))
    return df.drop("l_shipdate")


# ---- G / H / I: aggregates, top-k, quality ----------------------------------------

def q_game_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


def q_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary_stats(_summary(spark, sf_dir), Options().summary_columns)


def q_rate_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.rate_by_country(_summary(spark, sf_dir))


def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sample_rows(_summary(spark, sf_dir), SAMPLE_N)


def q_threshold_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _src(spark, sf_dir)
    rates = quality.null_rates(s.games, ("app_id", "title")).unionByName(quality.null_rates(s.recs, ("is_recommended", "user_id")))
    options = Options(max_null_rate=MAX_NULL_RATE, critical_columns=("app_id", "title", "is_recommended"))
    return quality.threshold_violations(quality.record_counts(s), rates, options)


QUERIES: dict[str, Query] = {
    "game_summary": q_game_summary,
    "scan_csv": q_scan_csv,
    "scan_json_lines": q_scan_json_lines,
    "optional_kb_absent": q_optional_kb_absent,
    "record_counts": q_record_counts,
    "parquet_round_trip": q_parquet_round_trip,
    "parse_kb_bindings": q_parse_kb_bindings,
    "parse_popularity_payload": q_parse_popularity_payload,
    "cap_rows": q_cap_rows,
    "csv_preview": q_csv_preview,
    "dq_report": q_dq_report,
    "cast_key": q_cast_key,
    "rename_key": q_rename_key,
    "project_kb": q_project_kb,
    "tag_count": q_tag_count,
    "primary_tag": q_primary_tag,
    "flag_to_int": q_flag_to_int,
    "normalize_title": q_normalize_title,
    "coalesce_fields": q_coalesce_fields,
    "join_category": q_join_category,
    "dropna_required": q_dropna_required,
    "filter_not_null": q_filter_not_null,
    "null_rates": q_null_rates,
    "top_in_country": q_top_in_country,
    "dedup_reviews": q_dedup_reviews,
    "dedup_kb_by_id": q_dedup_kb_by_id,
    "dedup_kb_by_title": q_dedup_kb_by_title,
    "dedup_kb_by_qid": q_dedup_kb_by_qid,
    "match_rate": q_match_rate,
    "join_metadata": q_join_metadata,
    "join_reviews": q_join_reviews,
    "join_popularity": q_join_popularity,
    "join_kb_by_id": q_join_kb_by_id,
    "join_kb_by_title": q_join_kb_by_title,
    "resolve_entities": q_resolve_entities,
    "enrich_reviews": q_enrich_reviews,
    "summary_stats": q_summary_stats,
    "rate_by_country": q_rate_by_country,
    "sample_rows": q_sample_rows,
    "threshold_violations": q_threshold_violations,
    "load_sources": q_load_sources,
    "run_pipeline": q_run_pipeline,
    "required_sources": q_required_sources,
} | STATE_QUERIES
