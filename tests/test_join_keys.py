"""Keys of the dimension joins are columns: a join's sort must not compute them in each comparison (H1, F5)."""

import re

import pytest
from pyspark.sql import functions as F

from crosslink.config import Options
from crosslink.functions import title_key
from crosslink.operators.enrich import join_category
from crosslink.operators.resolve import join_kb_by_title, kb_by_id, kb_by_title

KB = "wikidata_qid string, wikidata_uri string, steam_app_id string, name string, release_date string, metacritic string, publisher string, country string"


@pytest.fixture
def sort_merge(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _keyed(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if re.search(r"\b(Sort|SortMergeJoin|Exchange)\b", ln)]


def test_title_join_sorts_by_a_column(spark, sort_merge):
    kb = spark.createDataFrame([("Q1", "u", None, "A  b!", None, None, None, "X"), ("Q2", "u", None, None, None, None, None, "Y")], KB)
    games = spark.createDataFrame([(1, "a B"), (2, "東方"), (3, None), (4, "c"), (4, "a b")], "app_id int, title string").withColumn("title_key", F.lit("own"))
    out = join_kb_by_title(games, kb)
    lines = _keyed(out)
    assert any("SortMergeJoin" in ln for ln in lines) and not any("regexp_replace" in ln for ln in lines)
    assert sorted((r.app_id, r.title_key, r.wikidata_qid_t) for r in out.collect() if r.wikidata_qid_t) == [(1, "own", "Q1"), (4, "own", "Q1")]
    assert out.count() == 5 and not any(c.startswith("__") for c in out.columns)


def test_category_join_sorts_by_a_column(spark, sort_merge):
    lookup = spark.createDataFrame([("red", "Warm"), ("old", None)], "genre_key string, genre_category string")
    games = spark.createDataFrame([(1, "RED"), (2, None), (3, "Old"), (4, "blue")], "app_id int, primary_tag string")
    out = join_category(games, lookup)
    lines = _keyed(out)
    assert any("SortMergeJoin" in ln for ln in lines) and not any("lower(" in ln for ln in lines)
    assert out.columns == ["app_id", "primary_tag", "genre_category"]
    assert sorted(map(tuple, out.collect())) == [(1, "RED", "Warm"), (2, None, None), (3, "Old", None), (4, "blue", None)]


def _entities(spark, pairs):
    return spark.createDataFrame([(f"Q{i}", "u", key, name, None, None, None, None) for i, (key, name) in enumerate(pairs)], KB)


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


NAMES = ["A  b!", "a B", "\u6771\u65b9", "", None, " \t\n\u00a0", "\u00c9", "\u212a", "7", " x\ty ", "\u0130", "--\x0b--"]


@pytest.mark.parametrize("empty_matches", [False, True])
def test_each_entity_name_is_normalized_once(spark, empty_matches):
    """a filter on the key, pushed below its projection or inferred by the join, normalized each name three times."""
    kb = _entities(spark, [(None, n) for n in NAMES]).repartition(3)
    games = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "app_id int, title string")
    side = kb_by_title(kb, empty_matches)
    assert _optimized(side).count("regexp_replace") == 2  # the two steps of one normalization
    joined = join_kb_by_title(games, kb, Options(empty_title_matches=empty_matches))
    assert _optimized(joined).count("regexp_replace") <= 4  # one of the names and one of the titles
    keys = kb.select("wikidata_qid", title_key("name", empty_matches).alias("k")).filter("k IS NOT NULL").collect()
    first = {}
    for r in sorted(keys):
        first.setdefault(r.k, r.wikidata_qid)
    assert {r.title_key: r.wikidata_qid for r in side.collect()} == first and side.count() == len(first)
    assert ("" in first) == empty_matches and {"a b", "k", "7", "x y"} <= set(first)


def test_ids_without_a_digit_are_not_cast(spark):
    """each such text raised an error inside the cast."""
    ids = ["n/a", "", None, " 8 ", "8", "-3", "+4", "abc", "x1", "1.5", "99999999999", "\u0663", "007"]
    kb = _entities(spark, [(i, "t") for i in ids]).repartition(3)
    side = kb_by_id(kb)
    plan = _optimized(side)
    assert -1 < plan.find("RLIKE") < plan.find("isnotnull(try_cast")
    assert {r.app_id: r.wikidata_qid for r in side.collect()} == {8: "Q3", -3: "Q5", 4: "Q6", 7: "Q12"}
    whole = kb.withColumn("steam_app_id", F.expr("try_cast(steam_app_id AS bigint)"))
    assert {r.app_id for r in kb_by_id(whole).collect()} == {8, -3, 4, 7}
