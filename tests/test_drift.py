"""Schema conformance, the ledger of rejected cells, JSON drift and the metric history (I1, I3, A1, A2)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from crosslink import schemas
from crosslink.operators import history
from crosslink.plans.pipeline import run_pipeline
from crosslink.sources.conformance import FIELDS, csv_fields, differences, json_fields, parquet_fields, schema_conformance
from crosslink.sources.ledger import key_census, ledger_counts, malformed_lines, rejected_cells
from crosslink.sources.readers import SourcePaths, load_sources


def s(*fields):
    return StructType([StructField(*f) for f in fields])


def told(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# --- conformance ----------------------------------------------------------------


def test_kinds_of_differences(spark):
    fields = [
        ("same", [("a", "int", False), ("b", "double", True)]),
        ("small", [("a", "smallint", False), ("b", "float", True)]),
        ("large", [("a", "bigint", True), ("b", "double", True), ("c", "date", True)]),
        ("other", [("a", "string", False)]),
        ("unknown", [("a", None, False), ("b", None, True)]),
    ]
    df = spark.createDataFrame([(f, 1, [dict(zip(("name", "type", "nullable"), x)) for x in own], None) for f, own in fields] + [("bad", None, None, "OSError")], FIELDS)
    declared = s(("a", IntegerType(), False), ("b", DoubleType()))
    assert told(differences(df, declared, "x"), "file", "column", "expected", "found", "kind") == sorted(
        [
            ("small", "a", "int", "smallint", "narrowed"),
            ("small", "b", "double", "float", "narrowed"),
            ("large", "a", "int", "bigint", "widened"),
            ("large", "a", "not null", "null", "nullable"),
            ("large", "c", None, "date", "extra"),
            ("other", "a", "int", "string", "type"),
            ("other", "b", "double", None, "missing"),
            ("bad", None, None, "OSError", "unreadable"),
        ],
        key=str,
    )


def test_parquet_footers(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).select(F.col("id").cast("int").alias("a")).coalesce(1).write.parquet(f"{path}/x")
    spark.range(5).select(F.array(F.col("id").cast("string")).alias("a")).coalesce(1).write.parquet(f"{path}/y z")
    (tmp_path / "p" / "broken.parquet").write_bytes(b"no footer")
    got = {r.file.rsplit("/", 2)[1]: r for r in parquet_fields(spark, path).collect()}
    assert [f.asDict() for f in got["x"].fields] == [{"name": "a", "type": "int", "nullable": False}] and got["x"].num_rows == 10
    assert got["y z"].fields[0].type == "array<string>" and got["y z"].num_rows == 5
    assert got["p"].failure is not None and got["p"].fields is None


def test_footers_of_other_writers(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": pa.array([1, 2], pa.int16()), "b": pa.array([[1.0], None], pa.list_(pa.float64()))}), tmp_path / "f.parquet")
    (row,) = parquet_fields(spark, str(tmp_path)).collect()
    assert [(f.name, f.type) for f in row.fields] == [("a", "smallint"), ("b", "array<double>")]


def test_csv_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿"app_id","title"\r\n1,x\r\n2,y\r\n')
    (tmp_path / "b.csv").write_text("title|more\nx|y\n")
    (tmp_path / "empty.csv").write_text("")
    got = {r.file.rsplit("/")[-1]: ([f.name for f in r.fields], r.num_rows) for r in csv_fields(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"a.csv": (["app_id", "title"], 2)}
    (row,) = csv_fields(spark, str(tmp_path / "b.csv"), "|").collect()
    assert [f.name for f in row.fields] == ["title", "more"]
    both = schema_conformance(spark, str(tmp_path), schemas.GAMES, "games", "csv")
    assert ("title|more", "extra") in told(both, "column", "kind")
    with pytest.raises(ValueError):
        schema_conformance(spark, str(tmp_path), schemas.GAMES, "games", "orc")


def test_json_keys(spark, tmp_path):
    lines = [{"a": 1, "t": ["x"]}, {"a": 2, "t": []}, {"a": 3, "o": {"k": {"z": 1}}}]
    (tmp_path / "f.json").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n[1]\n\n")
    (row,) = json_fields(spark, str(tmp_path)).collect()
    assert {f.name: f.type for f in row.fields} == {"a": "bigint", "t": "array<string>", "o": "struct<k:struct<z:bigint>>"}
    declared = s(("a", LongType()), ("t", ArrayType(StringType())), ("gone", StringType()))
    assert told(differences(json_fields(spark, str(tmp_path)), declared, "j"), "column", "kind") == [("gone", "missing"), ("o", "extra")]


def test_conforming_files_have_no_rows(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([("1", "x")], schemas.GAMES).write.parquet(path)
    assert schema_conformance(spark, path, schemas.GAMES, "games", "parquet").collect() == []


# --- ledger ---------------------------------------------------------------------


def test_rejected_cells_keep_their_raw_text(spark, tmp_path):
    path = tmp_path / "recs"
    path.mkdir()
    (path / "a.csv").write_text('app_id,user_id,is_recommended,when\n1,2,True,2020-01-02\n x ,3,True,soon\n4,5\n"6,7",8,True,2020-01-01\n9,9,False,,\n,1,True,\n')
    (path / "b.csv").write_text("app_id,user_id,is_recommended,when\n99999999999,1,True,2020-01-01\n 8 ,1,True,2020-01-01\n")
    got = rejected_cells(spark, str(path), schemas.RECS, "recs", types={"when": "date"})
    assert got.columns == ["source", "file", "column", "expected", "raw"]
    assert {r.file.rsplit("/")[-1] for r in got.collect()} == {"a.csv", "b.csv"}
    assert told(got, "column", "expected", "raw") == sorted(
        [
            ("app_id", "int", " x "),
            ("when", "date", "soon"),
            (None, "row of another length", "4,5"),
            ("app_id", "int", "6,7"),
            (None, "row of another length", "9,9,False,,"),
            ("app_id", "int", "99999999999"),
        ],
        key=str,
    )
    counts = {r.subject: r.value for r in ledger_counts(got).collect()}
    assert counts == {"recs.app_id": 3.0, "recs.when": 1.0, "recs.row of another length": 2.0}


def test_ledger_and_reader_agree(spark, tmp_path):
    """Each cell that the reader turns into null is in the ledger, and no other."""
    from crosslink.plans.queries_state import LOOSE_REVIEWS, write_loose_reviews
    from crosslink.sources.readers import read_csv

    path = write_loose_reviews(spark, "/root/testdata/sf0.001")
    raw = spark.read.option("header", True).csv(path)
    typed = read_csv(spark, path, LOOSE_REVIEWS)
    lost = lambda c: raw.where(F.col(c).isNotNull()).count() - typed.where(F.col(c).isNotNull()).count()
    ledger = rejected_cells(spark, path, LOOSE_REVIEWS, "recs")
    for c in ("l_orderkey", "l_shipdate"):
        assert ledger.where(F.col("column") == c).count() == lost(c) > 0


def test_malformed_lines_and_key_census(spark, tmp_path):
    lines = ['{"a": 1}', '{"a": "x", "b": [1]}', '{"a": null}', '{"a": 1', "[1]", '"text"', "", "  ", "7", '{}']
    (tmp_path / "l.json").write_text("\n".join(lines))
    bad = malformed_lines(spark, str(tmp_path), "src")
    assert told(bad, "raw", "column") == sorted([('{"a": 1', None), ("[1]", None), ('"text"', None), ("7", None)], key=str)
    declared = s(("a", LongType()), ("c", StringType()))
    census = key_census(spark, str(tmp_path), declared, "src")
    assert told(census, "key", "expected", "found", "lines", "absent", "nulls", "kind") == [
        ("a", "bigint", "variant", 3, 1, 1, "type"),
        ("b", None, "array<bigint>", 1, 3, 0, "new"),
        ("c", "string", None, 0, 4, 0, "missing"),
    ]


def test_the_job_writes_the_ledger_and_reports_it(spark, tmp_path):
    at = lambda name, text: str((tmp_path / name).write_text(text) and tmp_path / name)
    paths = SourcePaths(
        games=at("games.csv", "app_id,title\n1,One\nbad,Two\n"),
        metadata=at("meta.json", '{"app_id":"1","tags":["red"]}\n{"app_id":\n'),
        recs=at("recs.csv", "app_id,user_id,is_recommended\n1,1,True\n1,2,False,more\n"),
        popularity=at("pop.csv", "appid,price\n1,5\n2,cheap\n"),
        categories=at("cat.csv", "genre,category\nred,Warm\n"),
    )
    assert load_sources(spark, paths).rejected is None
    result = run_pipeline(spark, load_sources(spark, paths, ledger=True), str(tmp_path / "out"))
    ledger = spark.read.parquet(result.rejected_path)
    assert told(ledger, "source", "column", "raw") == sorted(
        [("games", "app_id", "bad"), ("metadata", None, '{"app_id":'), ("recs", None, "1,2,False,more"), ("popularity", "price", "cheap")], key=str
    )
    assert result.report.where("section = 'rejected'").count() == 4
    text = "\n".join(r.value for r in spark.read.text(result.markdown_path).collect())
    assert "Cells, rows and lines that did not parse" in text and "| games.app_id | lost | 1 |" in text
    assert result.result.count() == 1


# --- history --------------------------------------------------------------------


def test_metric_drift(spark, tmp_path):
    store = history.history_store(spark, str(tmp_path / "h"))
    assert history.metric_drift(store).collect() == []
    shape = "section string, subject string, metric string, value double"
    nan = float("nan")
    first = [("c", "a", "rows", 100.0), ("c", "b", "rows", 10.0), ("c", "z", "rows", 0.0), ("n", "x", "rate", nan), ("n", "y", "rate", None), ("g", "g", "g", 1.0)]
    second = [("c", "a", "rows", 105.0), ("c", "b", "rows", 20.0), ("c", "z", "rows", 1.0), ("n", "x", "rate", nan), ("n", "y", "rate", None), ("f", "f", "f", 1.0)]
    assert history.record_run(store, "one", spark.createDataFrame(first, shape))
    assert {r.status for r in history.metric_drift(store).collect()} == {"new"}
    assert history.record_run(store, "two", spark.createDataFrame(second, shape))
    assert not history.record_run(store, "two", spark.createDataFrame(first, shape))
    assert history.runs(store) == ["one", "two"]
    got = {(r.section, r.subject): (r.status, r.alarm, r.change) for r in history.metric_drift(store).collect()}
    assert got[("c", "a")] == ("changed", False, 5.0) and got[("c", "b")] == ("changed", True, 10.0) and got[("c", "z")] == ("changed", True, 1.0)
    assert got[("n", "x")][:2] == ("same", False) and got[("n", "y")] == ("same", False, None)
    assert got[("g", "g")][:2] == ("gone", True) and got[("f", "f")][:2] == ("new", True)
    back = {(r.section, r.subject): r.status for r in history.metric_drift(store, "one", "two").collect()}
    assert back[("g", "g")] == "new"
