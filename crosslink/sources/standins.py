"""Stand-in sources derived, with Spark, from the test tables.

The six logical sources are built from the TPC-H-like tables so that every
query reads real tables and its work grows with them:

* reviews  (R) — every line item, joined to its order for the user id;
* games    (G) — every part; titles carry punctuation, some are null or CJK;
* metadata (M) — parts' name words as tags; some absent, null or empty;
* popularity (S) — a feed row per part; some keys are of no game, some prices missing;
* categories (C) — a tiny, mixed-case genre lookup;
* knowledge base (K) — entities matching by id, by title only, by both,
  duplicates, garbage ids and one empty-key entity.

Rules below use the key's residue only to shape the data (inject nulls,
missing rows, duplicates); no query filters the tables to make itself
cheaper. Each stand-in is one parameterized Spark SQL statement over the
table readers (parsed and analyzed once). The DuckDB oracle restates the same
rules independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crosslink.sources.readers import Sources

# Survivor order of duplicate reviews (a total order inside one
# (app_id, user_id) group of the stand-in reviews).
REVIEW_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "is_recommended")

# The genre → category lookup (mixed case on purpose).
CATEGORY_ROWS = (("RED", "Warm"), ("Hot", "Warm"), ("small", "Size"), ("Old", "Age"))

KB_URI_PREFIX = "http://www.wikidata.org/entity/"


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (the lazy reader is reused within one session)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """One parameterized Spark SQL statement (parsed and analyzed once)."""
    return spark.sql(text, **frames)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: one review per line item; user = the order's customer."""
    return _sql(
        spark,
        """
        SELECT l_partkey AS app_id,
               CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS user_id,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL
                    WHEN l_returnflag = 'R' THEN 'False'
                    WHEN l_returnflag = 'A' THEN 'true'
                    ELSE 'True' END AS is_recommended,
               l_shipdate, l_orderkey, l_linenumber
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        """,
        lineitem=table(spark, sf_dir, "lineitem"),
        orders=table(spark, sf_dir, "orders"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G: one game per part; nulls and all-CJK titles injected."""
    return _sql(
        spark,
        """
        SELECT p_partkey AS app_id,
               CASE WHEN p_partkey % 50 = 49 THEN NULL
                    WHEN p_partkey % 50 = 48 THEN '東方'
                    ELSE upper(p_name) || ': ' || p_brand || '  -- ' || CAST(p_partkey AS STRING) || '!'
               END AS title
        FROM {part}
        """,
        part=table(spark, sf_dir, "part"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: name words as tags; some keys are of no known game, some tags null or empty."""
    return _sql(
        spark,
        """
        SELECT CASE WHEN p_partkey % 10 = 9 THEN -1 - p_partkey ELSE p_partkey END AS app_id,
               CASE WHEN p_partkey % 10 = 3 THEN CAST(NULL AS ARRAY<STRING>)
                    WHEN p_partkey % 10 = 7 THEN CAST(array() AS ARRAY<STRING>)
                    ELSE split(p_name, ' ') END AS tags
        FROM {part}
        """,
        part=table(spark, sf_dir, "part"),
    )


def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: one feed row per part; one key in ten is of no known game, some prices are missing."""
    return _sql(
        spark,
        """
        SELECT CASE WHEN p_partkey % 10 = 6 THEN -1 - p_partkey ELSE p_partkey END AS appid,
               CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) END AS price
        FROM {part}
        """,
        part=table(spark, sf_dir, "part"),
    )


def categories(spark: SparkSession) -> DataFrame:
    """C: the fixed lookup (a curated file in a real deployment)."""
    rows = ", ".join(f"('{g}', '{c}')" for g, c in CATEGORY_ROWS)
    return spark.sql(f"SELECT genre, category FROM VALUES {rows} AS t(genre, category)")


def parts_with_supplier(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """All parts with their publisher: the supplier whose key is the part's key
    modulo the number of suppliers, and that supplier's nation.

    One row per supplier key (the smallest name). Every supplier takes part, so
    the join's keys grow with the table; no side is hinted.
    """
    join = "JOIN" if how == "inner" else "LEFT JOIN"
    return _sql(
        spark,
        f"""
        SELECT p.*, s.s_suppkey, s.s_name, s.n_name
        FROM (SELECT *, p_partkey % nullif((SELECT count(*) FROM {{supplier}}), 0) AS publisher_key FROM {{part}}) p
        {join} (
          SELECT s_suppkey, s_name, n_name FROM (
            SELECT s_suppkey, s_name, n_name,
                   row_number() OVER (PARTITION BY s_suppkey ORDER BY s_name NULLS LAST, n_name NULLS LAST) AS rn
            FROM {{supplier}} {join} {{nation}} ON s_nationkey = n_nationkey)
          WHERE rn = 1) s
        ON s.s_suppkey = p.publisher_key
        """,
        part=table(spark, sf_dir, "part"),
        supplier=table(spark, sf_dir, "supplier"),
        nation=table(spark, sf_dir, "nation"),
    )


def knowledge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K: flattened KB rows (the JSON-lines file of a real deployment).

    One entity per part: matching by id (key % 5 = 0), by title only (1), with a
    garbage id and no name (2) or a name of no game (3, 4); duplicates by id
    ('QD'), title-only twins ('QT') and
    one entity whose name normalizes to the empty key. One pass over the parts.
    """
    uri = KB_URI_PREFIX
    return _sql(
        spark,
        f"""
        SELECT inline(filter(array(
          CASE WHEN s_suppkey IS NOT NULL THEN named_struct(
               'wikidata_qid', 'Q' || CAST(p_partkey AS STRING),
               'wikidata_uri', '{uri}Q' || CAST(p_partkey AS STRING),
               'steam_app_id', CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS STRING)
                    WHEN p_partkey % 5 >= 2 THEN 'n/a' END,
               'name', CASE WHEN p_partkey % 5 = 2 THEN NULL
                    WHEN p_partkey % 5 > 2 THEN 'unlisted ' || CAST(p_partkey AS STRING)
                    WHEN p_partkey % 35 = 0 THEN 'renamed ' || CAST(p_partkey AS STRING)
                    ELSE p_name || ' ' || lower(p_brand) || ' ' || CAST(p_partkey AS STRING) END,
               'release_date', CASE WHEN p_partkey % 3 = 0 THEN NULL
                    ELSE CAST(p_size + 1970 AS STRING) || '-01-01T00:00:00Z' END,
               'metacritic', CASE WHEN p_partkey % 11 = 0 THEN CAST(p_size * 2 AS STRING) END,
               'publisher', CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE s_name END,
               'country', n_name) END,
          CASE WHEN p_partkey % 25 = 0 THEN named_struct(
               'wikidata_qid', 'QD' || CAST(p_partkey AS STRING),
               'wikidata_uri', '{uri}QD' || CAST(p_partkey AS STRING),
               'steam_app_id', CAST(p_partkey AS STRING), 'name', 'dup ' || CAST(p_partkey AS STRING),
               'release_date', CAST(NULL AS STRING), 'metacritic', CAST(NULL AS STRING),
               'publisher', 'Dup', 'country', 'NATION_0') END,
          CASE WHEN p_partkey % 35 = 0 THEN named_struct(
               'wikidata_qid', 'QT' || CAST(p_partkey AS STRING),
               'wikidata_uri', '{uri}QT' || CAST(p_partkey AS STRING),
               'steam_app_id', CAST(NULL AS STRING),
               'name', p_name || ' ' || lower(p_brand) || ' ' || CAST(p_partkey AS STRING),
               'release_date', CAST(NULL AS STRING), 'metacritic', CAST(NULL AS STRING),
               'publisher', 'Title only', 'country', 'NATION_1') END
          ), e -> e IS NOT NULL))
        FROM {{parts}}
        UNION ALL
        SELECT 'QEMPTY', '{uri}QEMPTY', CAST(NULL AS STRING), '!!!',
               CAST(NULL AS STRING), CAST(NULL AS STRING), 'Empty', 'NATION_2'
        FROM {{region}} WHERE r_regionkey = 0
        """,
        parts=parts_with_supplier(spark, sf_dir, how="left"),
        region=table(spark, sf_dir, "region"),
    )


def standin_sources(spark: SparkSession, sf_dir: str, with_kb: bool = True) -> Sources:
    """All six stand-ins as a ``Sources`` bundle (KB optional)."""
    return Sources(
        games=games(spark, sf_dir),
        metadata=metadata(spark, sf_dir),
        recs=reviews(spark, sf_dir),
        popularity=popularity(spark, sf_dir),
        categories=categories(spark),
        kb=knowledge_base(spark, sf_dir) if with_kb else None,
        review_order=REVIEW_ORDER,
    )
