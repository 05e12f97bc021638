"""DuckDB SQL oracles, one per registered query.

Written independently of the DataFrame code: the stand-in sources are
re-derived in SQL (same rules as ``sources.standins``), then each operator is
expressed as plain SQL over them. Tables ``region nation customer supplier
part orders lineitem …`` are views over the test Parquet files.
"""

from __future__ import annotations

from crosslink.plans import queries as Q


def norm(x: str) -> str:
    """Title normalization in DuckDB SQL."""
    return (
        f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9\\s]', '', 'g'), "
        f"'\\s+', ' ', 'g'))"
    )


def flag(x: str) -> str:
    return f"CASE WHEN lower(CAST({x} AS VARCHAR)) = 'true' THEN 1 ELSE 0 END"


URI = "http://www.wikidata.org/entity/"
KB_ORDER = "wikidata_qid NULLS LAST, release_date NULLS LAST, metacritic NULLS LAST, publisher NULLS LAST, country NULLS LAST"

# Stand-in sources (raw), then cleaned / game-grain building blocks.
BASE = f"""
r AS (
  SELECT l_partkey AS app_id,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS user_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'False'
              WHEN l_returnflag = 'A' THEN 'true' ELSE 'True' END AS is_recommended,
         l_shipdate, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (
  SELECT p_partkey AS app_id,
         CASE WHEN p_partkey % 50 = 49 THEN NULL WHEN p_partkey % 50 = 48 THEN '東方'
              ELSE upper(p_name) || ': ' || p_brand || '  -- ' || CAST(p_partkey AS VARCHAR) || '!' END AS title
  FROM part),
m AS (
  SELECT CASE WHEN p_partkey % 10 = 9 THEN -1 - p_partkey ELSE p_partkey END AS app_id,
         CASE WHEN p_partkey % 10 = 3 THEN NULL WHEN p_partkey % 10 = 7 THEN CAST([] AS VARCHAR[])
              ELSE string_split(p_name, ' ') END AS tags
  FROM part),
s AS (
  SELECT CASE WHEN p_partkey % 10 = 6 THEN -1 - p_partkey ELSE p_partkey END AS appid,
         CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INTEGER) END AS price
  FROM part),
ns AS (SELECT count(*) AS n FROM supplier),
sup AS (
  SELECT s_suppkey, s_name, n_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY s_name NULLS LAST, n_name NULLS LAST) = 1),
supl AS (
  SELECT s_suppkey, s_name, n_name
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY s_name NULLS LAST, n_name NULLS LAST) = 1),
c AS (SELECT * FROM (VALUES ('RED', 'Warm'), ('Hot', 'Warm'), ('small', 'Size'), ('Old', 'Age')) t(genre, category)),
k AS (
  SELECT 'Q' || CAST(p_partkey AS VARCHAR) AS wikidata_qid,
         '{URI}Q' || CAST(p_partkey AS VARCHAR) AS wikidata_uri,
         CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 5 >= 2 THEN 'n/a' END AS steam_app_id,
         CASE WHEN p_partkey % 5 = 2 THEN NULL WHEN p_partkey % 5 > 2 THEN 'unlisted ' || CAST(p_partkey AS VARCHAR) WHEN p_partkey % 35 = 0 THEN 'renamed ' || CAST(p_partkey AS VARCHAR)
              ELSE p_name || ' ' || lower(p_brand) || ' ' || CAST(p_partkey AS VARCHAR) END AS name,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size + 1970 AS VARCHAR) || '-01-01T00:00:00Z' END AS release_date,
         CASE WHEN p_partkey % 11 = 0 THEN CAST(p_size * 2 AS VARCHAR) END AS metacritic,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE s_name END AS publisher,
         n_name AS country
  FROM part JOIN sup ON s_suppkey = p_partkey % (SELECT n FROM ns)
  UNION ALL
  SELECT 'QD' || CAST(p_partkey AS VARCHAR), '{URI}QD' || CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR),
         'dup ' || CAST(p_partkey AS VARCHAR), NULL, NULL, 'Dup', 'NATION_0'
  FROM part WHERE p_partkey % 25 = 0
  UNION ALL
  SELECT 'QT' || CAST(p_partkey AS VARCHAR), '{URI}QT' || CAST(p_partkey AS VARCHAR), NULL,
         p_name || ' ' || lower(p_brand) || ' ' || CAST(p_partkey AS VARCHAR), NULL, NULL, 'Title only', 'NATION_1'
  FROM part WHERE p_partkey % 35 = 0
  UNION ALL
  SELECT 'QEMPTY', '{URI}QEMPTY', NULL, '!!!', NULL, NULL, 'Empty', 'NATION_2' FROM region WHERE r_regionkey = 0),
gc AS (
  SELECT TRY_CAST(app_id AS INTEGER) AS app_id, title FROM g
  WHERE TRY_CAST(app_id AS INTEGER) IS NOT NULL AND title IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(app_id AS INTEGER) ORDER BY title NULLS LAST) = 1),
mc AS (
  SELECT TRY_CAST(app_id AS INTEGER) AS app_id, tags FROM m
  WHERE TRY_CAST(app_id AS INTEGER) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(app_id AS INTEGER) ORDER BY tags[1] NULLS LAST, len(tags) NULLS LAST) = 1),
sc AS (
  SELECT TRY_CAST(appid AS INTEGER) AS app_id, price FROM s
  WHERE TRY_CAST(appid AS INTEGER) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(appid AS INTEGER) ORDER BY price NULLS LAST) = 1),
cc AS (
  SELECT lower(genre) AS genre_key, category AS genre_category FROM c
  QUALIFY row_number() OVER (PARTITION BY lower(genre) ORDER BY genre NULLS LAST, category NULLS LAST) = 1),
rc AS (
  SELECT TRY_CAST(app_id AS INTEGER) AS app_id, user_id, is_recommended, l_shipdate, l_orderkey, l_linenumber,
         {flag('is_recommended')} AS is_recommended_num
  FROM r WHERE TRY_CAST(app_id AS INTEGER) IS NOT NULL AND is_recommended IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(app_id AS INTEGER), user_id
                             ORDER BY l_shipdate NULLS LAST, l_orderkey NULLS LAST, l_linenumber NULLS LAST,
                                      is_recommended NULLS LAST) = 1),
st AS (
  SELECT app_id, avg(is_recommended_num) AS steam_recommend_rate, count(*) AS num_reviews,
         CAST(sum(is_recommended_num) AS BIGINT) AS num_positive_reviews,
         count(is_recommended) AS num_flags_present
  FROM rc GROUP BY app_id),
kid AS (
  SELECT TRY_CAST(steam_app_id AS INTEGER) AS app_id, wikidata_qid, release_date AS wd_release_date,
         metacritic AS wd_metacritic, publisher AS wd_publisher, country AS wd_country
  FROM k WHERE TRY_CAST(steam_app_id AS INTEGER) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(steam_app_id AS INTEGER) ORDER BY {KB_ORDER}) = 1),
kt AS (
  SELECT title_key, wikidata_qid AS wikidata_qid_t, release_date AS wd_release_date_t,
         metacritic AS wd_metacritic_t, publisher AS wd_publisher_t, country AS wd_country_t
  FROM (SELECT NULLIF({norm('name')}, '') AS title_key, * FROM k) x
  WHERE title_key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY title_key ORDER BY {KB_ORDER}) = 1),
gm AS (
  SELECT gc.app_id, gc.title, mc.tags, CASE WHEN mc.tags IS NULL THEN 0 ELSE len(mc.tags) END AS tag_count
  FROM gc LEFT JOIN mc ON gc.app_id = mc.app_id),
staged AS (
  SELECT gm.*, sc.price, gm.tags[1] AS primary_tag, cc.genre_category,
         kid.app_id IS NOT NULL AS id_hit, kt.title_key IS NOT NULL AS title_hit,
         kid.wikidata_qid, kid.wd_release_date, kid.wd_metacritic, kid.wd_publisher, kid.wd_country,
         kt.wikidata_qid_t, kt.wd_release_date_t, kt.wd_metacritic_t, kt.wd_publisher_t, kt.wd_country_t
  FROM gm
  LEFT JOIN sc ON sc.app_id = gm.app_id
  LEFT JOIN cc ON lower(gm.tags[1]) = cc.genre_key
  LEFT JOIN kid ON kid.app_id = gm.app_id
  LEFT JOIN kt ON kt.title_key = NULLIF({norm('gm.title')}, '')),
dims AS (
  SELECT app_id, title, tags, tag_count, price, primary_tag, genre_category,
         coalesce(wikidata_qid, wikidata_qid_t) AS wikidata_qid,
         coalesce(wd_release_date, wd_release_date_t) AS wd_release_date,
         coalesce(wd_metacritic, wd_metacritic_t) AS wd_metacritic,
         coalesce(wd_publisher, wd_publisher_t) AS wd_publisher,
         coalesce(wd_country, wd_country_t) AS wd_country,
         CASE WHEN id_hit THEN 'id' WHEN title_hit THEN 'title' END AS wd_match_stage
  FROM staged),
facts AS (
  SELECT st.*, d.title, d.primary_tag, d.genre_category, d.price, d.wikidata_qid, d.wd_release_date,
         d.wd_metacritic, d.wd_publisher, d.wd_country, d.wd_match_stage
  FROM st JOIN dims d ON st.app_id = d.app_id),
summary AS (
  SELECT app_id, steam_recommend_rate, num_reviews, num_positive_reviews, title, primary_tag, genre_category,
         price, wikidata_qid, wd_release_date, wd_metacritic, wd_publisher, wd_country
  FROM facts),
enriched AS (
  SELECT d.app_id, d.title, d.tag_count, rc.user_id, rc.is_recommended, rc.l_orderkey, rc.l_linenumber,
         rc.is_recommended_num, d.price, d.primary_tag, d.genre_category, d.wikidata_qid, d.wd_release_date,
         d.wd_metacritic, d.wd_publisher, d.wd_country
  FROM dims d JOIN rc ON rc.app_id = d.app_id),
bind AS (
  SELECT p_partkey AS p, v.variant,
         CAST(floor(p_partkey / 100) AS BIGINT) AS page_no,
         CASE WHEN v.variant = 2 THEN NULL WHEN v.variant = 3 THEN '' ELSE 'Q' || CAST(p_partkey AS VARCHAR) END AS wikidata_qid,
         CASE WHEN v.variant = 2 THEN '' WHEN v.variant = 3 THEN '{URI}' ELSE '{URI}Q' || CAST(p_partkey AS VARCHAR) END AS wikidata_uri,
         CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN CAST(p_partkey AS INTEGER) END AS steam_app_id,
         CASE WHEN v.variant = 2 THEN 'unnamed ' || CAST(p_partkey AS VARCHAR)
              WHEN v.variant = 3 THEN 'no id ' || CAST(p_partkey AS VARCHAR)
              ELSE p_name || ' ' || lower(p_brand) || ' ' || CAST(p_partkey AS VARCHAR) END AS name,
         CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size + 1970 AS VARCHAR) || '-01-01T00:00:00Z' END AS release_date,
         CASE WHEN p_partkey % 11 = 0 THEN CAST(p_size * 2 AS VARCHAR) END AS metacritic,
         CASE WHEN v.variant = 1 THEN 'Second publisher' WHEN p_partkey % 7 <> 0 THEN s_name END AS publisher,
         n_name AS country
  FROM part
  LEFT JOIN supl ON s_suppkey = p_partkey % (SELECT n FROM ns)
  JOIN (VALUES (0), (1), (2), (3)) v(variant)
    ON v.variant = 0 OR (v.variant = 1 AND p_partkey % 13 = 0) OR (v.variant = 2 AND p_partkey % 17 = 0)
       OR (v.variant = 3 AND p_partkey % 19 = 0)),
bindings AS (
  SELECT page_no,
         CAST(row_number() OVER (PARTITION BY page_no ORDER BY p, variant) - 1 AS INTEGER) AS pos,
         p, variant, wikidata_qid, wikidata_uri, steam_app_id, name, release_date, metacritic, publisher, country
  FROM bind)
"""

KB_FLAT_COLS = "wikidata_qid, wikidata_uri, steam_app_id, name, release_date, metacritic, publisher, country"


def _w(sql: str) -> str:
    return f"WITH {BASE.strip()}\n{sql.strip()}"


def _dropna_part(name: str, src: str, cond: str) -> str:
    return (
        f"SELECT '{name}' AS source, count(*) AS rows_before, "
        f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS rows_after FROM {src}"
    )


_NULL_RATE_COLS = Q.NULL_RATE_COLUMNS


def _null_rate_sql(src: str, cols: tuple[str, ...]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, CASE WHEN count(*) = 0 THEN 0.0 "
            f"ELSE CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) END AS null_rate FROM {src}"
        )
    return " UNION ALL ".join(parts)


_COUNTS = """
counts AS (
  SELECT 'games' AS source, count(*) AS num_rows, 2 AS num_columns FROM g
  UNION ALL SELECT 'metadata', count(*), 2 FROM m
  UNION ALL SELECT 'recs', count(*), 6 FROM r
  UNION ALL SELECT 'popularity', count(*), 2 FROM s
  UNION ALL SELECT 'categories', count(*), 2 FROM c
  UNION ALL SELECT 'kb', count(*), 8 FROM k)
"""


def _sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["game_summary"] = _w("SELECT * FROM summary")
    o["parquet_round_trip"] = o["game_summary"]
    o["optional_kb_absent"] = _w(
        "SELECT app_id, steam_recommend_rate, num_reviews, num_positive_reviews, title, primary_tag, "
        "genre_category, price FROM summary"
    )
    o["scan_csv"] = _w(
        "SELECT TRY_CAST(app_id AS INTEGER) AS app_id, user_id, is_recommended, l_orderkey, l_linenumber FROM r"
    )
    o["scan_json_lines"] = _w(
        "SELECT wikidata_qid, wikidata_uri, TRY_CAST(steam_app_id AS INTEGER) AS steam_app_id, name, "
        "release_date, metacritic, publisher, country FROM k"
    )
    o["record_counts"] = f"WITH {BASE.strip()},\n{_COUNTS.strip()}\nSELECT source, num_rows, num_columns FROM counts"
    o["parse_kb_bindings"] = _w(f"SELECT {KB_FLAT_COLS} FROM bindings")
    o["cap_rows"] = _w(
        f"SELECT page_no, pos, {KB_FLAT_COLS} FROM bindings ORDER BY page_no, pos LIMIT {Q.CAP_ROWS}"
    )
    o["dedup_kb_by_qid"] = _w(
        f"SELECT page_no, pos, {KB_FLAT_COLS} FROM bindings "
        "QUALIFY wikidata_qid IS NULL OR wikidata_qid = '' OR row_number() OVER (PARTITION BY wikidata_qid ORDER BY page_no, pos) = 1"
    )
    o["parse_popularity_payload"] = _w(
        """
        SELECT CAST(p_partkey AS INTEGER) AS appid, p_name AS name, 'Studio ' || p_brand AS developer,
               p_brand AS publisher,
               CAST(p_size * 1000 AS VARCHAR) || ' .. ' || CAST(p_size * 2000 AS VARCHAR) AS owners,
               CAST(p_size * 10 AS INTEGER) AS average_forever, CAST(p_size * 5 AS INTEGER) AS median_forever,
               CAST(p_size AS INTEGER) AS ccu,
               CASE WHEN p_partkey % 40 <> 0 THEN CAST(floor(p_retailprice) AS INTEGER) END AS price
        FROM part
        """
    )
    o["csv_preview"] = _w(f"SELECT * FROM summary ORDER BY app_id LIMIT {Q.PREVIEW_N}")
    o["sample_rows"] = _w(f"SELECT * FROM summary ORDER BY app_id LIMIT {Q.SAMPLE_N}")
    o["cast_key"] = _w(
        "SELECT wikidata_qid, steam_app_id AS steam_app_id_raw, TRY_CAST(steam_app_id AS INTEGER) AS steam_app_id FROM k"
    )
    o["rename_key"] = _w("SELECT TRY_CAST(appid AS INTEGER) AS app_id, price FROM s")
    o["project_kb"] = _w(
        "SELECT TRY_CAST(steam_app_id AS INTEGER) AS app_id, wikidata_qid, release_date AS wd_release_date, "
        "metacritic AS wd_metacritic, publisher AS wd_publisher, country AS wd_country FROM k"
    )
    o["tag_count"] = _w(
        "SELECT TRY_CAST(app_id AS INTEGER) AS app_id, CASE WHEN tags IS NULL THEN 0 ELSE len(tags) END AS tag_count FROM m"
    )
    o["primary_tag"] = _w("SELECT TRY_CAST(app_id AS INTEGER) AS app_id, tags[1] AS primary_tag FROM m")
    o["flag_to_int"] = _w(
        f"SELECT l_orderkey, l_linenumber, is_recommended, {flag('is_recommended')} AS is_recommended_num FROM r"
    )
    o["normalize_title"] = _w(f"SELECT doc_id, {norm('text')} AS title_key FROM documents")
    o["coalesce_fields"] = _w(
        """
        SELECT app_id,
               coalesce(wikidata_qid, wikidata_qid_t) AS wikidata_qid,
               coalesce(wd_release_date, wd_release_date_t) AS wd_release_date,
               coalesce(wd_metacritic, wd_metacritic_t) AS wd_metacritic,
               coalesce(wd_publisher, wd_publisher_t) AS wd_publisher,
               coalesce(wd_country, wd_country_t) AS wd_country,
               CASE WHEN id_hit THEN wikidata_qid ELSE wikidata_qid_t END AS wikidata_qid_entity,
               CASE WHEN id_hit THEN wd_release_date ELSE wd_release_date_t END AS wd_release_date_entity,
               CASE WHEN id_hit THEN wd_metacritic ELSE wd_metacritic_t END AS wd_metacritic_entity,
               CASE WHEN id_hit THEN wd_publisher ELSE wd_publisher_t END AS wd_publisher_entity,
               CASE WHEN id_hit THEN wd_country ELSE wd_country_t END AS wd_country_entity
        FROM staged
        """
    )
    o["join_category"] = _w("SELECT app_id, primary_tag, genre_category FROM staged")
    o["dropna_required"] = _w(
        " UNION ALL ".join(
            [
                _dropna_part("games", "g", "TRY_CAST(app_id AS INTEGER) IS NOT NULL AND title IS NOT NULL"),
                _dropna_part("metadata", "m", "TRY_CAST(app_id AS INTEGER) IS NOT NULL"),
                _dropna_part("recs", "r", "TRY_CAST(app_id AS INTEGER) IS NOT NULL AND is_recommended IS NOT NULL"),
            ]
        )
    )
    o["filter_not_null"] = _w(
        "SELECT wikidata_qid, TRY_CAST(steam_app_id AS INTEGER) AS steam_app_id FROM k "
        "WHERE TRY_CAST(steam_app_id AS INTEGER) IS NOT NULL"
    )
    o["null_rates"] = _w(_null_rate_sql("enriched", _NULL_RATE_COLS))
    o["top_in_country"] = _w(
        f"""
        SELECT title, steam_recommend_rate, num_reviews, wd_publisher FROM summary
        WHERE wd_country = '{Q.TOP_COUNTRY}' AND num_reviews > {Q.TOP_MIN_REVIEWS}
        ORDER BY steam_recommend_rate DESC, app_id ASC LIMIT {Q.TOP_K}
        """
    )
    o["dedup_reviews"] = _w(
        "SELECT app_id, user_id, is_recommended, l_orderkey, l_linenumber, is_recommended_num FROM rc"
    )
    o["dedup_kb_by_id"] = _w("SELECT * FROM kid")
    o["dedup_kb_by_title"] = _w(
        "SELECT title_key, wikidata_qid_t AS wikidata_qid, wd_release_date_t AS wd_release_date, "
        "wd_metacritic_t AS wd_metacritic, wd_publisher_t AS wd_publisher, wd_country_t AS wd_country FROM kt"
    )
    o["match_rate"] = _w(
        """
        SELECT count(DISTINCT CASE WHEN wikidata_qid IS NOT NULL THEN app_id END) AS matched,
               count(DISTINCT app_id) AS total,
               count(DISTINCT CASE WHEN wd_match_stage = 'id' THEN app_id END) AS matched_by_id,
               count(DISTINCT CASE WHEN wd_match_stage = 'title' THEN app_id END) AS matched_by_title,
               CASE WHEN count(DISTINCT app_id) = 0 THEN 0.0
                    ELSE count(DISTINCT CASE WHEN wikidata_qid IS NOT NULL THEN app_id END)
                         / count(DISTINCT app_id) * 100 END AS match_rate_pct
        FROM facts
        """
    )
    o["join_metadata"] = _w("SELECT app_id, title, tag_count FROM gm")
    o["join_reviews"] = _w(
        "SELECT gm.app_id, gm.title, gm.tag_count, rc.user_id, rc.l_orderkey, rc.l_linenumber, rc.is_recommended_num "
        "FROM gm JOIN rc ON gm.app_id = rc.app_id"
    )
    o["join_popularity"] = _w("SELECT gc.app_id, gc.title, sc.price FROM gc LEFT JOIN sc ON gc.app_id = sc.app_id")
    o["join_kb_by_id"] = _w(
        "SELECT gc.app_id, gc.title, kid.wikidata_qid, kid.wd_release_date, kid.wd_metacritic, kid.wd_publisher, "
        "kid.wd_country FROM gc LEFT JOIN kid ON gc.app_id = kid.app_id"
    )
    o["join_kb_by_title"] = _w(
        f"SELECT gc.app_id, gc.title, kt.wikidata_qid_t, kt.wd_release_date_t, kt.wd_metacritic_t, kt.wd_publisher_t, "
        f"kt.wd_country_t FROM gc LEFT JOIN kt ON kt.title_key = NULLIF({norm('gc.title')}, '')"
    )
    o["resolve_entities"] = _w(
        "SELECT app_id, title, wikidata_qid, wd_release_date, wd_metacritic, wd_publisher, wd_country, wd_match_stage "
        "FROM (SELECT gc.app_id, gc.title FROM gc) x JOIN dims USING (app_id, title)"
    )
    o["enrich_reviews"] = _w("SELECT * FROM enriched")
    o["summary_stats"] = _w(
        """
        SELECT 'steam_recommend_rate' AS column_name, CAST(min(steam_recommend_rate) AS DOUBLE) AS min,
               CAST(max(steam_recommend_rate) AS DOUBLE) AS max, round(avg(steam_recommend_rate), 9) AS mean FROM summary
        UNION ALL
        SELECT 'num_reviews', CAST(min(num_reviews) AS DOUBLE), CAST(max(num_reviews) AS DOUBLE), CAST(sum(num_reviews) AS DOUBLE) / count(num_reviews) FROM summary
        UNION ALL
        SELECT 'num_positive_reviews', CAST(min(num_positive_reviews) AS DOUBLE), CAST(max(num_positive_reviews) AS DOUBLE),
               CAST(sum(num_positive_reviews) AS DOUBLE) / count(num_positive_reviews) FROM summary
        """
    )
    o["rate_by_country"] = _w(
        """
        SELECT wd_country, count(*) AS num_games, CAST(sum(num_reviews) AS BIGINT) AS num_reviews,
               CAST(sum(num_positive_reviews) AS BIGINT) AS num_positive_reviews,
               round(avg(steam_recommend_rate), 9) AS mean_game_rate,
               CAST(sum(num_positive_reviews) AS DOUBLE) / sum(num_reviews) AS review_weighted_rate
        FROM summary WHERE wd_country IS NOT NULL GROUP BY wd_country
        """
    )
    o["threshold_violations"] = (
        f"WITH {BASE.strip()},\n{_COUNTS.strip()},\n"
        f"rates AS ({_null_rate_sql('g', ('app_id', 'title'))} UNION ALL {_null_rate_sql('r', ('is_recommended',))})\n"
        "SELECT 'min_records' AS check_name, source AS subject, CAST(num_rows AS DOUBLE) AS observed, "
        "100.0 AS threshold FROM counts WHERE num_rows < 100\n"
        "UNION ALL SELECT 'max_null_rate', column_name, null_rate, "
        f"{Q.MAX_NULL_RATE}::DOUBLE FROM rates WHERE null_rate > {Q.MAX_NULL_RATE}"
    )
    o["load_sources"] = o["game_summary"]
    o["run_pipeline"] = o["game_summary"]
    o["required_sources"] = " UNION ALL ".join(
        f"SELECT '{t}' AS source, true AS present, count(*) AS num_rows FROM {t}" for t in sorted(Q.REQUIRED_TABLES)
    ) + " UNION ALL SELECT 'absent', false, 0"
    o["merge_kb_pages"] = o["dedup_kb_by_qid"]
    o["dedup_reviews_delta"] = o["dedup_reviews"]
    o["game_summary_delta"] = o["game_summary"]
    o["top_in_country_first"] = o["top_in_country"]
    o["enrich_known_reviews"] = o["enrich_reviews"]
    o["enrich_reviews_colocated"] = o["enrich_reviews"]
    o["game_summary_colocated"] = o["game_summary"]
    o["schema_conformance"] = """
        WITH kinds(source, days, day, "column", expected, found, kind) AS (VALUES
          ('popularity', 6, 1, 'price', 'int', NULL, 'missing'), ('popularity', 6, 2, 'note', NULL, 'string', 'extra'),
          ('popularity', 6, 3, 'price', 'int', 'smallint', 'narrowed'), ('popularity', 6, 4, 'price', 'int', 'bigint', 'widened'),
          ('popularity', 6, 4, 'ccu', 'bigint', 'double', 'type'), ('popularity', 6, 5, 'appid', 'not null', 'null', 'nullable'),
          ('popularity', 6, 5, 'price', 'int', 'string', 'type'),
          ('games', 2, 1, 'app_id', 'string', NULL, 'missing'), ('games', 2, 1, 'extra note', NULL, NULL, 'extra'),
          ('metadata', 2, 1, 'app_id', 'bigint', 'string', 'type'), ('metadata', 2, 1, 'tags', 'array<string>', NULL, 'missing'),
          ('metadata', 2, 1, 'box', NULL, 'struct<size:bigint>', 'extra'))
        SELECT source, day, "column", expected, found, kind, count(*) AS num_rows
        FROM kinds JOIN part ON p_partkey % days = day GROUP BY ALL
        """
    o["rejected_cells"] = """
        WITH c AS (
          SELECT l_orderkey AS k, CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supp,
                 CASE WHEN l_orderkey % 53 = 0 THEN 'x' ELSE '' END || l_partkey AS app_id,
                 CASE WHEN l_orderkey % 59 = 0 THEN '99999999999999999999' ELSE CAST(l_orderkey AS VARCHAR) END AS orderkey,
                 CASE WHEN l_orderkey % 47 = 0 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS shipdate FROM lineitem),
        rows AS (SELECT *, k % 61 <> 0 AND k % 67 = 0 AS few FROM c)
        SELECT 'recs' AS source, NULL AS "column", 'row of another length' AS expected,
               CASE WHEN few THEN part || ',' || supp ELSE app_id || ',' || supp || ',' || orderkey || ',' || shipdate || ',True,more' END AS raw
        FROM rows WHERE few OR k % 61 = 0
        UNION ALL SELECT 'recs', 'app_id', 'int', app_id FROM rows WHERE NOT few AND k % 53 = 0
        UNION ALL SELECT 'recs', 'l_orderkey', 'bigint', orderkey FROM rows WHERE NOT few AND k % 59 = 0
        UNION ALL SELECT 'recs', 'l_shipdate', 'date', shipdate FROM rows WHERE NOT few AND k % 47 = 0
        """
    o["json_drift"] = """
        WITH p AS (SELECT p_partkey % 10 AS d FROM part), o AS (SELECT count(*) AS n FROM p WHERE d NOT IN (3, 4, 5))
        SELECT 'metadata' AS source, 'app_id' AS key, 'bigint' AS expected, 'variant' AS found, n AS lines, 0 AS absent,
               (SELECT count(*) FROM p WHERE d = 8) AS nulls, 'type' AS kind FROM o
        UNION ALL SELECT 'metadata', 'tags', 'array<string>', 'array<string>', n - (SELECT count(*) FROM p WHERE d = 9), (SELECT count(*) FROM p WHERE d = 9), 0, 'declared' FROM o
        UNION ALL SELECT 'metadata', 'pages', NULL, 'bigint', (SELECT count(*) FROM p WHERE d = 6), n - (SELECT count(*) FROM p WHERE d = 6), 0, 'new' FROM o
        UNION ALL SELECT 'metadata', 'notes', 'string', NULL, 0, n, 0, 'missing' FROM o
        UNION ALL SELECT 'metadata', NULL, 'json object', NULL, (SELECT count(*) FROM p WHERE d IN (3, 4)), 0, 0, 'malformed'
        """
    o["dq_report"] = (
        f"WITH {BASE.strip()},\n{_COUNTS.strip()},\n"
        """
        wrates AS (
          SELECT 'app_id' AS column_name,
                 CASE WHEN coalesce(sum(num_reviews), 0) = 0 THEN 0.0
                      ELSE sum(CASE WHEN app_id IS NULL THEN num_reviews ELSE 0 END) / sum(num_reviews) END AS null_rate
          FROM facts
          UNION ALL
          SELECT 'title', CASE WHEN coalesce(sum(num_reviews), 0) = 0 THEN 0.0
                 ELSE sum(CASE WHEN title IS NULL THEN num_reviews ELSE 0 END) / sum(num_reviews) END FROM facts
          UNION ALL
          SELECT 'is_recommended', CASE WHEN coalesce(sum(num_reviews), 0) = 0 THEN 0.0
                 ELSE sum(num_reviews - num_flags_present) / sum(num_reviews) END FROM facts)
        SELECT 'record_counts' AS section, 'raw:' || source AS subject, 'rows' AS metric, CAST(num_rows AS DOUBLE) AS value
        FROM counts
        UNION ALL SELECT 'raw_null_rates', 'games.app_id', 'null_rate',
                  CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN app_id IS NULL THEN 1 ELSE 0 END) / count(*) END FROM g
        UNION ALL SELECT 'raw_null_rates', 'games.title', 'null_rate',
                  CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN title IS NULL THEN 1 ELSE 0 END) / count(*) END FROM g
        UNION ALL SELECT 'raw_null_rates', 'metadata.app_id', 'null_rate',
                  CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN app_id IS NULL THEN 1 ELSE 0 END) / count(*) END FROM m
        UNION ALL SELECT 'raw_null_rates', 'recs.app_id', 'null_rate',
                  CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN app_id IS NULL THEN 1 ELSE 0 END) / count(*) END FROM r
        UNION ALL SELECT 'raw_null_rates', 'recs.is_recommended', 'null_rate',
                  CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN is_recommended IS NULL THEN 1 ELSE 0 END) / count(*) END FROM r
        UNION ALL SELECT 'record_counts', 'processed', 'rows', CAST(coalesce(sum(num_reviews), 0) AS DOUBLE) FROM facts
        UNION ALL SELECT 'record_counts', 'aggregated', 'rows', CAST(count(*) AS DOUBLE) FROM facts
        UNION ALL SELECT 'null_rates', column_name, 'null_rate', null_rate FROM wrates
        UNION ALL SELECT 'summary_stats', 'steam_recommend_rate', 'min', min(steam_recommend_rate) FROM facts
        UNION ALL SELECT 'summary_stats', 'steam_recommend_rate', 'max', max(steam_recommend_rate) FROM facts
        UNION ALL SELECT 'summary_stats', 'steam_recommend_rate', 'mean', round(avg(steam_recommend_rate), 9) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_reviews', 'min', CAST(min(num_reviews) AS DOUBLE) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_reviews', 'max', CAST(max(num_reviews) AS DOUBLE) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_reviews', 'mean', CAST(sum(num_reviews) AS DOUBLE) / count(num_reviews) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_positive_reviews', 'min', CAST(min(num_positive_reviews) AS DOUBLE) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_positive_reviews', 'max', CAST(max(num_positive_reviews) AS DOUBLE) FROM facts
        UNION ALL SELECT 'summary_stats', 'num_positive_reviews', 'mean', CAST(sum(num_positive_reviews) AS DOUBLE) / count(num_positive_reviews) FROM facts
        UNION ALL SELECT 'threshold_violations', 'min_records:' || source, 'observed', CAST(num_rows AS DOUBLE)
                  FROM counts WHERE num_rows < 100
        UNION ALL SELECT 'threshold_violations', 'max_null_rate:' || column_name, 'observed', null_rate
                  FROM wrates WHERE null_rate > 0.05
        UNION ALL SELECT 'match_rate', 'kb', 'matched',
                  CAST(count(DISTINCT CASE WHEN wikidata_qid IS NOT NULL THEN app_id END) AS DOUBLE) FROM facts
        UNION ALL SELECT 'match_rate', 'kb', 'total', CAST(count(DISTINCT app_id) AS DOUBLE) FROM facts
        UNION ALL SELECT 'match_rate', 'kb', 'match_rate_pct',
                  CASE WHEN count(DISTINCT app_id) = 0 THEN 0.0
                       ELSE count(DISTINCT CASE WHEN wikidata_qid IS NOT NULL THEN app_id END) / count(DISTINCT app_id) * 100 END
                  FROM facts
        UNION ALL SELECT 'match_rate', 'kb', 'matched_by_id',
                  CAST(count(DISTINCT CASE WHEN wd_match_stage = 'id' THEN app_id END) AS DOUBLE) FROM facts
        UNION ALL SELECT 'match_rate', 'kb', 'matched_by_title',
                  CAST(count(DISTINCT CASE WHEN wd_match_stage = 'title' THEN app_id END) AS DOUBLE) FROM facts
        """
    )
    earlier = o["dq_report"].replace("FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 2 = 1")
    o["metric_drift"] = f"""
        WITH a AS ({earlier}), b AS ({o["dq_report"]}),
        j AS (SELECT coalesce(a.section, b.section) AS section, coalesce(a.subject, b.subject) AS subject, coalesce(a.metric, b.metric) AS metric,
                     a.value AS previous, b.value AS current, b.value - a.value AS change,
                     CASE WHEN a.section IS NULL THEN 'new' WHEN b.section IS NULL THEN 'gone'
                          WHEN a.value IS NOT DISTINCT FROM b.value THEN 'same' ELSE 'changed' END AS status
              FROM a FULL JOIN b ON a.section = b.section AND a.subject = b.subject AND a.metric = b.metric)
        SELECT *, CASE status WHEN 'same' THEN false WHEN 'changed' THEN coalesce(abs(change) > 0.1::DOUBLE * abs(previous), true) ELSE true END AS alarm FROM j
        """
    return o


ORACLE_SQL: dict[str, str] = _sql()
