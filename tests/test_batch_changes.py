"""A batch's changes: the batch is evaluated once, the state is shuffled once, and what is written is not written twice (E1, G1)."""

import re

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from crosslink.operators import incremental as inc
from crosslink.operators.aggregate import review_stats
from crosslink.operators.enrich import clean_recs
from crosslink.segments import SegmentStore

SHAPE = "app_id string, user_id long, is_recommended string, when int, id long"
ORDER = ("when", "id")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_plan_of_a_batch(spark, tmp_path):
    recs = spark.createDataFrame([("1", 7, "True", 5, 1), ("1", None, "True", 5, 2)], SHAPE)
    recs.write.parquet(str(tmp_path / "recs"))
    recs = spark.read.parquet(str(tmp_path / "recs"))
    store = inc.review_store(spark, str(tmp_path / "r"), recs)
    inc.add_reviews(store, recs, "a", ORDER)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = inc.review_changes(store.read("changes"), recs, ORDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert str(tmp_path / "recs") not in plan  # the batch is not evaluated again
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3  # the batch's rows, their keys, the state


@pytest.mark.parametrize("order", [ORDER, ()])
def test_null_users_null_places_and_equal_places(spark, tmp_path, order):
    first = [("1", None, "True", None, 1), ("1", 7, "True", 5, None), ("2", 7, "False", 3, 3), ("3", None, "False", 3, 3), ("4", 1, "True", 2, 2)]
    second = [("1", None, "False", 9, 9), ("1", 7, "False", 5, 4), ("2", 7, "False", 3, 3), ("3", None, "True", 3, 2), ("5", None, None, 1, 1), ("x", 1, "True", 1, 1)]
    store = inc.review_store(spark, str(tmp_path / "r"), spark.createDataFrame(first, SHAPE))
    for k, batch in enumerate((first, second)):
        assert inc.add_reviews(store, spark.createDataFrame(batch, SHAPE), f"b{k}", order)
    whole = clean_recs(spark.createDataFrame(first + second, SHAPE), order)
    assert rows(inc.current_reviews(store, order)) == rows(whole) and rows(inc.current_stats(store)) == rows(review_stats(whole))
    if order:
        changes = [(r.app_id, r.user_id, r.id, r[inc.SIGN]) for r in store.read("changes").collect()]
        new = sorted(changes, key=str)
        assert [c for c in new if c[3] < 0] == [(1, 7, None, -1), (1, None, 1, -1), (3, None, 3, -1)]
        assert len(changes) == 5 + 2 * 3  # the equal review of game 2 changes nothing


def test_a_frame_made_from_those_written_before(spark, tmp_path):
    schema = StructType([StructField("x", LongType())])
    store = SegmentStore(spark, str(tmp_path / "s"), a=schema, b=schema)
    assert store.append("m", {"a": spark.range(3).withColumnRenamed("id", "x"), "b": lambda written: written["a"].where("x > 0")})
    assert sorted(r.x for r in store.read("b").collect()) == [1, 2]
