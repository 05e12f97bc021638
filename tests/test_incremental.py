"""Batch-wise state equals one full run, for any split (A10, E1, E4, G1); plans that filter first (F2, H1)."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from crosslink.operators import incremental as inc
from crosslink.operators.aggregate import game_summary, review_stats, top_in_country, top_in_country_first
from crosslink.operators.enrich import clean_recs, enrich_known_reviews, enrich_reviews
from crosslink.segments import SegmentStore
from crosslink.sources import payloads
from pyspark.sql.types import LongType, StructField, StructType

ORDER = ("when", "id")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


# --- segments ---------------------------------------------------------------------


def test_segments_count_once_they_are_committed(spark, tmp_path):
    schema = StructType([StructField("x", LongType())])
    store = SegmentStore(spark, str(tmp_path / "s"), a=schema, b=schema)
    assert store.read("a").count() == 0 and store.mark() is None and store.commits() == []
    one = spark.createDataFrame([(1,)], "x int")
    assert store.append("m", {"a": one, "b": one}, mark="7")
    one.write.parquet(str(tmp_path / "s" / "segments" / "died-1" / "a"))  # written, never committed
    assert not store.append("m", {"a": one, "b": one})
    assert store.append("n", {"a": one, "b": one.limit(0)})
    assert [r.x for r in store.read("a").collect()] == [1, 1] and store.read("b").count() == 1 and store.mark() == "7"
    store.compact({"a": spark.createDataFrame([(5,)], "x int"), "b": one})
    assert [r.x for r in store.read("a").collect()] == [5] and store.mark() == "7"
    assert not store.append("n", {"a": one, "b": one})  # also beyond a base
    assert store.append("o", {"a": one, "b": one}) and sorted(r.x for r in store.read("a").collect()) == [1, 5]
    with pytest.raises(ValueError):
        store.append("p", {"a": one})


def test_a_batch_that_fails_leaves_nothing(spark, tmp_path):
    schema = StructType([StructField("x", LongType())])
    store = SegmentStore(spark, str(tmp_path / "s"), a=schema, b=schema)
    bad = spark.createDataFrame([("no number",)], "x string")
    with pytest.raises(Exception):
        store.append("m", {"a": spark.range(3).withColumnRenamed("id", "x"), "b": bad})
    assert store.commits() == [] and store.read("a").count() == 0
    fine = spark.range(3).withColumnRenamed("id", "x")
    assert store.append("m", {"a": fine, "b": fine}) and store.read("a").count() == 3


# --- knowledge-base pages ----------------------------------------------------------


def page(no, qids):
    bindings = ", ".join('{"game": {"value": "http://k/%s"}, "gameLabel": {"value": "%s of %s"}}' % (q, q, no) if q is not None else '{"gameLabel": {"value": "none"}}' for q in qids)
    return no, '{"results": {"bindings": [%s]}}' % bindings


@pytest.mark.parametrize("seed", range(3))
def test_pages_in_any_split_equal_one_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    pages = [page(n, [rng.choice(["Q1", "Q2", "Q3", f"Q{rng.randrange(40)}", None, ""]) for _ in range(rng.randint(0, 8))]) for n in range(12)]
    shape = "page_no long, payload string"
    whole = payloads.dedup_kb_by_qid(payloads.parse_kb_bindings(spark.createDataFrame(pages, shape)))
    store = inc.kb_store(spark, str(tmp_path / "kb"))
    cut = sorted(rng.sample(range(1, 12), 2))
    for k, (a, b) in enumerate(zip([0, *cut], [*cut, 12])):
        inc.merge_kb_pages(store, spark.createDataFrame(pages[max(0, a - 2) : b], shape), f"run{k}")  # pages come again
    assert rows(store.read("bindings")) == rows(whole)
    assert not inc.merge_kb_pages(store, spark.createDataFrame(pages, shape), "again")
    assert rows(store.read("bindings")) == rows(whole)


def test_a_page_that_comes_again_with_more_bindings(spark, tmp_path):
    shape = "page_no long, payload string"
    store = inc.kb_store(spark, str(tmp_path / "kb"))
    inc.merge_kb_pages(store, spark.createDataFrame([page(0, ["Q1", "Q2"]), page(1, ["Q3"])], shape), "a")
    assert store.mark() == "1,0"
    inc.merge_kb_pages(store, spark.createDataFrame([page(1, ["Q3", "Q1", "Q4"])], shape), "b")
    assert store.mark() == "1,2"
    assert sorted((r.wikidata_qid, r.page_no, r.pos) for r in store.read("bindings").collect()) == [("Q1", 0, 0), ("Q2", 0, 1), ("Q3", 1, 0), ("Q4", 1, 2)]


# --- reviews --------------------------------------------------------------------


def some_reviews(seed, n=300):
    rng = random.Random(seed)
    one = lambda k: (rng.choice(["1", "2", "3", " 4 ", "x", None]), rng.choice([None, *range(6)]), rng.choice(["True", "False", "true", None]), rng.randrange(50), k)
    out = [one(k) for k in range(n)]
    return out + out[:20]


SHAPE = "app_id string, user_id long, is_recommended string, when int, id long"


@pytest.mark.parametrize("order", [ORDER, ()])
@pytest.mark.parametrize("seed", [1, 2])
def test_reviews_in_any_split_equal_one_run(spark, tmp_path, seed, order):
    reviews = some_reviews(seed)
    whole = clean_recs(spark.createDataFrame(reviews, SHAPE), order)
    rng = random.Random(seed + 10)
    store = inc.review_store(spark, str(tmp_path / "r"), spark.createDataFrame(reviews, SHAPE))
    parts = [[], [], [], []]
    for r in reviews:
        parts[rng.randrange(3)].append(r)
    parts[3] = parts[0]  # delivered twice, as another batch
    for k, part in enumerate(parts):
        assert inc.add_reviews(store, spark.createDataFrame(part, SHAPE), f"b{k}", order)
        assert not inc.add_reviews(store, spark.createDataFrame(reviews, SHAPE), f"b{k}", order)  # applied before
        if k == 1:
            inc.compact_reviews(store, order)
    assert rows(inc.current_reviews(store, order)) == rows(whole)
    assert rows(inc.current_stats(store)) == rows(review_stats(whole))
    assert store.read("changes").where(f"{inc.SIGN} < 0").count() > 0  # some survivors were replaced


def test_a_replay_adds_no_change(spark, tmp_path):
    recs = spark.createDataFrame(some_reviews(5), SHAPE)
    store = inc.review_store(spark, str(tmp_path / "r"), recs)
    inc.add_reviews(store, recs, "a", ORDER)
    assert inc.review_changes(store.read("changes"), recs, ORDER).count() == 0


def test_summary_of_batches(spark, tmp_path, small_sources):
    src = small_sources
    store = inc.review_store(spark, str(tmp_path / "r"), src.recs)
    for k in (1, 0):
        inc.add_reviews(store, src.recs.where(F.col("l_linenumber") % 2 == k), f"b{k}", src.review_order)
    assert rows(inc.current_summary(store, src)) == rows(game_summary(src))


def test_the_summary_of_batches_reads_no_reviews(spark, tmp_path, small_sources):
    store = inc.review_store(spark, str(tmp_path / "r"), small_sources.recs)
    inc.add_reviews(store, small_sources.recs, "b", small_sources.review_order)
    plan = inc.current_summary(store, small_sources)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_returnflag" not in plan and "user_id" not in plan


# --- filters first ----------------------------------------------------------------




def test_country_first_equals_country_last(spark, small_sources):
    for country in ("NATION_15", "NATION_3", "nowhere"):
        assert rows(top_in_country_first(small_sources, country, 5)) == rows(top_in_country(game_summary(small_sources), country, 5))


def test_known_reviews_equal_all(spark, small_sources):
    assert rows(enrich_known_reviews(small_sources)) == rows(enrich_reviews(small_sources))


def test_filters_come_before_the_shuffle_of_reviews(spark, small_sources):
    for df in (enrich_known_reviews(small_sources), top_in_country_first(small_sources, "NATION_15", 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        window = plan[plan.index("WindowGroupLimit") :]  # the partial one stands before the exchange of the reviews
        semi = window.index("LeftSemi")
        assert "Partial" in plan and semi > 0 and "hashpartitioning(app_id" in plan
        assert plan.index("Exchange hashpartitioning(app_id") < plan.index("LeftSemi")
