"""Scalar expressions — one test per trap."""

from pyspark.sql import functions as F

from crosslink.functions import (
    flag_to_int,
    normalize_title,
    null_or_nan,
    primary_tag,
    qid_from_uri,
    tag_count,
    title_key,
    to_int_key,
)


def _col(spark, values, ddl, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_t1_int_key_is_lenient(spark):
    got = _col(spark, ["70", "abc", "99999999999", " 8 ", None], "string", to_int_key)
    assert got == [70, None, None, 8, None]


def test_t3_primary_tag_never_raises(spark):
    assert _col(spark, [[], ["x", "y"], None], "array<string>", primary_tag) == [None, "x", None]


def test_tag_count(spark):
    assert _col(spark, [[], ["x", "y"], None], "array<string>", tag_count) == [0, 2, 0]


def test_t7_flag_to_int(spark):
    vals = ["true", "True", "TRUE", "1", "yes", "False", None]
    assert _col(spark, vals, "string", flag_to_int) == [1, 1, 1, 0, 0, 0, 0]


def test_t7_flag_from_boolean_and_int(spark):
    assert _col(spark, [True, False, None], "boolean", flag_to_int) == [1, 0, 0]
    assert _col(spark, [1, 0], "int", flag_to_int) == [0, 0]


def test_c7_normalize_title(spark):
    vals = ["Pokémon: Red!", "  A   B\tC ", "İX", "a b", "!!!", None, "東方"]
    got = _col(spark, vals, "string", normalize_title)
    assert got == ["pokmon red", "a b c", "ix", "ab", "", None, ""]


def test_t5_title_key_empty_is_null_by_default(spark):
    assert _col(spark, ["東方", "!!!", "Star-Fall"], "string", title_key) == [None, None, "starfall"]
    keep = lambda c: title_key(c, empty_matches=True)
    assert _col(spark, ["東方", "!!!"], "string", keep) == ["", ""]


def test_qid_from_uri(spark):
    vals = ["http://www.wikidata.org/entity/Q1001", "Q5", "", None, "a/"]
    assert _col(spark, vals, "string", qid_from_uri) == ["Q1001", "Q5", None, None, ""]


def test_null_or_nan_only_for_floats(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "d double, s string")
    dt = {f.name: f.dataType for f in df.schema.fields}
    rows = df.select(null_or_nan("d", dt["d"]).alias("d"), null_or_nan("s", dt["s"]).alias("s")).collect()
    assert [(r.d, r.s) for r in rows] == [(False, False), (True, True), (True, False)]
