"""Cleaning, dedup, entity resolution and aggregation semantics on tiny frames."""

from pyspark.sql import functions as F

from crosslink.config import Options
from crosslink.operators.aggregate import game_summary
from crosslink.operators.clean import dedup_first, drop_incomplete, keep_first_with_key
from crosslink.operators.enrich import clean_categories, clean_recs
from crosslink.operators.resolve import resolve_entities
from crosslink.sources.readers import Sources

KB_DDL = (
    "wikidata_qid string, wikidata_uri string, steam_app_id string, name string, "
    "release_date string, metacritic string, publisher string, country string"
)


def _sources(spark, kb_rows=None, pop_rows=None, games=None, recs=None, cats=None):
    games = games or [("1", "Star-Fall"), ("2", "Harbor"), ("3", "東方")]
    recs = recs or [
        ("1", "10", "true"), ("1", "11", "False"), ("1", "12", "True"),
        ("2", "10", "TRUE"), ("3", "10", "false"), ("9", "10", "true"),
    ]
    return Sources(
        games=spark.createDataFrame(games, "app_id string, title string"),
        metadata=spark.createDataFrame([("1", ["Action", "FPS"]), ("2", [])], "app_id string, tags array<string>"),
        recs=spark.createDataFrame(recs, "app_id string, user_id string, is_recommended string"),
        popularity=spark.createDataFrame(pop_rows or [("1", 999)], "appid string, price int"),
        categories=spark.createDataFrame(cats or [("action", "Popular")], "genre string, category string"),
        kb=spark.createDataFrame(kb_rows, KB_DDL) if kb_rows is not None else None,
    )


def test_dedup_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "x"), (None, "y")], "k int, v string")
    got = sorted(((r.k or 0), r.v) for r in dedup_first(df, ["k"], ["v"]).collect())
    assert got == [(0, "x"), (1, "a"), (2, "c")]


def test_t8_null_users_collapse_to_one(spark):
    recs = spark.createDataFrame(
        [("1", None, "true", 2), ("1", None, "false", 1), ("1", "u", "true", 3)],
        "app_id string, user_id string, is_recommended string, ord int",
    )
    out = clean_recs(recs, ("ord",)).orderBy("ord").collect()
    assert [(r.user_id, r.is_recommended) for r in out] == [(None, "false"), ("u", "true")]


def test_drop_incomplete_any(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "app_id int, title string")
    assert drop_incomplete(df, ["app_id", "title", "missing"]).count() == 1


def test_e4_keep_first_but_all_null_keys(spark):
    df = spark.createDataFrame([("Q1", 0), ("Q1", 1), (None, 2), (None, 3)], "q string, pos int")
    got = sorted(keep_first_with_key(df, "q", ["pos"]).collect(), key=lambda r: r.pos)
    assert [(r.q, r.pos) for r in got] == [("Q1", 0), (None, 2), (None, 3)]


def test_category_lookup_case_fold_and_dedup(spark):
    cats = spark.createDataFrame([("Action", "B"), ("action", "A"), ("RPG", "Story")], "genre string, category string")
    got = {r.genre_key: r.genre_category for r in clean_categories(cats).collect()}
    assert got == {"action": "B", "rpg": "Story"}


def test_t4_field_vs_entity_fallback(spark):
    games = spark.createDataFrame([(1, "Star-Fall")], "app_id int, title string")
    kb = spark.createDataFrame(
        [
            ("Q1", "u", "1", "Other name", None, None, None, "US"),
            ("Q2", "u", None, "STAR-FALL!", "1998", None, "North", "DE"),
        ],
        KB_DDL,
    )
    field = resolve_entities(games, kb, Options(fallback="field"), provenance=True).first()
    assert (field.wikidata_qid, field.wd_publisher, field.wd_country, field.wd_release_date) == ("Q1", "North", "US", "1998")
    assert field.wd_match_stage == "id"
    entity = resolve_entities(games, kb, Options(fallback="entity")).first()
    assert (entity.wikidata_qid, entity.wd_publisher, entity.wd_country) == ("Q1", None, "US")


def test_t5_empty_title_key_matches_nothing_by_default(spark):
    games = spark.createDataFrame([(3, "東方")], "app_id int, title string")
    kb = spark.createDataFrame([("QE", "u", None, "!!!", None, None, "Empty", None)], KB_DDL)
    assert resolve_entities(games, kb).first().wikidata_qid is None
    on = resolve_entities(games, kb, Options(empty_title_matches=True)).first()
    assert on.wikidata_qid == "QE"


def test_kb_never_changes_row_count(spark):
    kb = [
        ("Q1", "u", "1", "Star-Fall", None, None, "North", "US"),
        ("Q1b", "u", "1", "Star Fall", None, None, "North", "US"),
        ("Q9", "u", "n/a", "harbor", None, None, "North", "US"),
    ]
    src = _sources(spark, kb_rows=kb)
    with_kb = game_summary(src)
    without = game_summary(src.without_kb())
    assert with_kb.count() == without.count() == 3
    row = with_kb.filter("app_id = 1").first()
    assert row.wikidata_qid == "Q1"  # first by qid among duplicates
    assert with_kb.filter("app_id = 2").first().wikidata_qid == "Q9"  # title stage


def test_t16_kb_absent_means_absent_columns(spark):
    cols = game_summary(_sources(spark)).columns
    assert cols == [
        "app_id", "steam_recommend_rate", "num_reviews", "num_positive_reviews",
        "title", "primary_tag", "genre_category", "price",
    ]


def test_summary_values(spark):
    rows = {r.app_id: r for r in game_summary(_sources(spark)).collect()}
    assert set(rows) == {1, 2, 3}  # app 9 has no game row: inner join drops it
    r1 = rows[1]
    assert (r1.num_reviews, r1.num_positive_reviews) == (3, 2)
    assert abs(r1.steam_recommend_rate - 2 / 3) < 1e-15
    assert (r1.title, r1.primary_tag, r1.genre_category, r1.price) == ("Star-Fall", "Action", "Popular", 999)
    assert rows[2].primary_tag is None and rows[2].price is None


def test_t6_duplicate_dimension_rows_do_not_inflate(spark):
    src = _sources(spark, pop_rows=[("1", 999), ("1", 999), ("1", 5)], games=[("1", "Star-Fall"), ("1", "Star-Fall")])
    r1 = game_summary(src).filter("app_id = 1").first()
    assert r1.num_reviews == 3 and r1.price == 5


def test_aggregate_first_equals_review_grain(spark, small_sources):
    """Reviews joined to games and counted one by one, in plain SQL, give the same counts."""
    from crosslink.operators.enrich import enrich_reviews

    a = game_summary(small_sources)
    b = spark.sql(
        """
        SELECT app_id, avg(is_recommended_num) AS steam_recommend_rate, count(*) AS num_reviews,
               sum(is_recommended_num) AS num_positive_reviews, max(title) AS title, max(primary_tag) AS primary_tag,
               max(genre_category) AS genre_category, max(price) AS price, max(wikidata_qid) AS wikidata_qid,
               max(wd_release_date) AS wd_release_date, max(wd_metacritic) AS wd_metacritic,
               max(wd_publisher) AS wd_publisher, max(wd_country) AS wd_country
        FROM {reviews} GROUP BY app_id
        """,
        reviews=enrich_reviews(small_sources),
    ).select(*a.columns)
    assert a.count() == b.count() == 196
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_default_survivor_favours_no_flag(spark):
    """Without an order, conflicting reviews of a user survive about evenly."""
    rows = [("1", str(u), flag) for u in range(400) for flag in ("True", "False")]
    recs = spark.createDataFrame(rows, "app_id string, user_id string, is_recommended string")
    kept = clean_recs(recs)
    assert kept.count() == 400
    assert 120 < kept.filter("is_recommended_num = 1").count() < 280
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, clean_recs(recs.repartition(7)).collect()))


def test_conflicting_flags_follow_the_given_order(spark):
    recs = spark.createDataFrame([("1", "7", "False", 2), ("1", "7", "True", 1)], "app_id string, user_id string, is_recommended string, review_id int")
    assert clean_recs(recs, ("review_id",)).first().is_recommended == "True"


def test_keyless_rows_stay_spread(spark):
    """Nine tenths of the rows lack an id: they aren't ranked, so no task gathers them."""
    df = spark.range(20000).selectExpr("CASE WHEN id % 10 = 0 THEN 'Q' || (id % 500) WHEN id % 10 < 6 THEN '' END AS qid", "id AS pos")
    out = keep_first_with_key(df.repartition(8), "qid", ["pos"])
    assert out.filter("qid IS NULL OR qid = ''").count() == 18000
    assert out.filter("qid <> ''").count() == 50
    sizes = [n for n in out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
    assert max(sizes) < 0.3 * sum(sizes)
    assert "WindowGroupLimit" in out._jdf.queryExecution().optimizedPlan().toString()


def test_review_columns_that_clash_are_prefixed(spark):
    from crosslink.operators.enrich import join_reviews

    games = spark.createDataFrame([(1, "A")], "app_id int, title string")
    reviews = spark.createDataFrame([(1, "fine", 3)], "app_id int, title string, hours int")
    assert join_reviews(games, reviews).columns == ["app_id", "title", "review_title", "hours"]


def test_invariants(spark, small_sources):
    from crosslink.operators.enrich import enrich_reviews

    s = game_summary(small_sources)
    bad = s.filter(
        (F.col("steam_recommend_rate") < 0)
        | (F.col("steam_recommend_rate") > 1)
        | (F.abs(F.col("steam_recommend_rate") - F.col("num_positive_reviews") / F.col("num_reviews")) > 1e-12)
    )
    assert bad.count() == 0
    assert s.select("app_id").distinct().count() == s.count()
    total = s.agg(F.sum("num_reviews")).first()[0]
    assert total == enrich_reviews(small_sources).count() == 5210
    assert s.agg(F.sum("num_positive_reviews")).first()[0] == 3478


def test_fixture_counts_sf0001(small_sources):
    rows = game_summary(small_sources).collect()
    assert len(rows) == 196
    from collections import Counter

    cats = Counter(r.genre_category for r in rows)
    assert cats == Counter({None: 130, "Warm": 38, "Age": 18, "Size": 10})
    assert sum(r.price is not None for r in rows) == 171  # every part is in the feed; some keys miss, some prices are null
    assert sum(r.primary_tag is None for r in rows) == 56
    assert sum(r.wikidata_qid is not None for r in rows) == 80
