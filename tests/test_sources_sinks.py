"""Source contract, readers, payload parsing, sinks and the end-to-end job."""

import json
import os

import pytest
from pyspark.sql import functions as F

from crosslink import schemas
from crosslink.plans.pipeline import run_pipeline
from crosslink.sources.contract import available, require
from crosslink.sources.payloads import cap_rows, dedup_kb_by_qid, parse_kb_bindings, parse_popularity_payload
from crosslink.sources.readers import SourcePaths, load_sources, read_categories, read_csv


def _write(path, text, mode="w"):
    with open(path, mode, newline="", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_a3_contract(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        require(spark, str(tmp_path / "nope.csv"))
    empty = _write(tmp_path / "empty.csv", "")
    with pytest.raises(ValueError):
        require(spark, empty)
    ok = _write(tmp_path / "ok.csv", "a\n1\n")
    assert require(spark, ok) == ok
    assert not available(spark, str(tmp_path / "nope.json"))
    assert not available(spark, empty)
    assert not available(spark, None)


def test_t12_lookup_comma_lf_and_tab_crlf(spark, tmp_path):
    a = _write(tmp_path / "a.csv", "genre,category\nAction,Popular\nRPG,Story\n")
    b = _write(tmp_path / "b.csv", "genre\tcategory\r\nAction\tPopular\r\nRPG\tStory\r\n")
    ra = sorted(tuple(r) for r in read_categories(spark, a).collect())
    rb = sorted(tuple(r) for r in read_categories(spark, b, delimiter="\t").collect())
    assert ra == rb == [("Action", "Popular"), ("RPG", "Story")]


def test_csv_columns_by_header_name(spark, tmp_path):
    p = _write(tmp_path / "recs.csv", "helpful,is_recommended,user_id,app_id\n3,true,7, 70 \n1,x,8,abc\n")
    df = read_csv(spark, p, schemas.RECS)
    assert df.columns == ["app_id", "user_id", "is_recommended", "helpful"]
    from crosslink.functions import to_int_key

    got = sorted(df.select(to_int_key("app_id").alias("a"), "user_id", "is_recommended").collect(), key=lambda r: r.user_id)
    assert [tuple(r) for r in got] == [(70, "7", "true"), (None, "8", "x")]


def _source_files(tmp_path, with_kb=True):
    d = tmp_path / "raw"
    d.mkdir()
    _write(d / "games.csv", "app_id,title,date\n70,Star-Fall,1998\n300,Night Shift: Redux,2005\n5,,2000\n")
    _write(d / "meta.json", "\n".join(json.dumps(r) for r in [
        {"app_id": 70, "tags": ["FPS", "Action"], "description": "x"},
        {"app_id": 300, "tags": ["FPS"]},
    ]) + "\n")
    _write(d / "recs.csv", "app_id,helpful,is_recommended,user_id\n70,1,true,1\n70,0,false,2\n70,0,true,2\n300,0,True,1\n999,0,true,1\n")
    _write(d / "pop.csv", "appid,name,developer,publisher,owners,average_forever,median_forever,ccu,price\n70,Star-Fall,North,North,\"10,000\",1,1,1,999\n")
    _write(d / "genres.csv", "genre\tcategory\r\nAction\tPopular\r\nFPS\tShooter\r\n")
    kb = str(d / "kb.json")
    if with_kb:
        _write(d / "kb.json", json.dumps({
            "wikidata_qid": "Q1001", "wikidata_uri": "http://www.wikidata.org/entity/Q1001",
            "steam_app_id": 70, "name": "Star-Fall", "release_date": "1998-11-19T00:00:00Z",
            "metacritic": None, "publisher": "North Studio", "country": "Freedonia",
        }, ensure_ascii=False) + "\n")
    return SourcePaths(
        games=str(d / "games.csv"), metadata=str(d / "meta.json"), recs=str(d / "recs.csv"),
        popularity=str(d / "pop.csv"), categories=str(d / "genres.csv"), kb=kb,
        categories_delimiter="\t",
    )


def test_a6_load_sources_and_run_pipeline(spark, tmp_path):
    src = load_sources(spark, _source_files(tmp_path))
    assert src.kb is not None
    out = str(tmp_path / "out")
    res = run_pipeline(spark, src, out)
    rows = {r.app_id: r for r in res.result.collect()}
    assert set(rows) == {70, 300}
    hl = rows[70]
    assert (hl.num_reviews, hl.num_positive_reviews, hl.price, hl.primary_tag, hl.genre_category) == (2, 1, 999, "FPS", "Shooter")
    assert (hl.wikidata_qid, hl.wd_publisher, hl.wd_country) == ("Q1001", "North Studio", "Freedonia")
    assert rows[300].wikidata_qid is None
    # B2: preview is a directory holding one CSV file
    parts = [f for f in os.listdir(res.preview_path) if f.endswith(".csv")]
    assert len(parts) == 1
    samples = spark.read.parquet(res.samples_path).orderBy("app_id").collect()
    assert [r.app_id for r in samples] == [70, 300]
    rep = {(r.section, r.subject, r.metric): r.value for r in res.report.collect()}
    assert rep[("record_counts", "processed", "rows")] == 3.0
    assert rep[("record_counts", "aggregated", "rows")] == 2.0
    assert rep[("null_rates", "title", "null_rate")] == 0.0
    assert rep[("match_rate", "kb", "matched")] == 1.0
    assert rep[("match_rate", "kb", "match_rate_pct")] == 50.0
    assert ("threshold_violations", "min_records:games", "observed") in rep
    # B5: the report rendered as Markdown, one text file
    md_parts = [f for f in os.listdir(res.markdown_path) if f.startswith("part-")]
    assert len(md_parts) == 1
    md = open(os.path.join(res.markdown_path, md_parts[0]), encoding="utf-8").read()
    assert md.startswith("# Data quality report")
    assert "## 1. Record counts" in md and "| processed | rows | 3 |" in md
    assert "Threshold violations" in md and "min_records:games" in md
    assert "Sample rows" in md and "North Studio" in md
    # raw-source null rates of critical columns
    assert rep[("raw_null_rates", "games.title", "null_rate")] == 1 / 3
    assert rep[("raw_null_rates", "recs.is_recommended", "null_rate")] == 0.0
    assert ("raw_null_rates", "popularity.app_id", "null_rate") not in rep
    # raw counts
    raw = {k[1]: v for k, v in rep.items() if k[0] == "record_counts" and k[1].startswith("raw:")}
    assert raw == {"raw:games": 3.0, "raw:metadata": 2.0, "raw:recs": 5.0, "raw:popularity": 1.0,
                   "raw:categories": 2.0, "raw:kb": 1.0}


def test_a4_optional_kb_absent(spark, tmp_path):
    src = load_sources(spark, _source_files(tmp_path, with_kb=False))
    assert src.kb is None
    res = run_pipeline(spark, src, str(tmp_path / "out"))
    assert "wikidata_qid" not in res.result.columns
    assert res.report.filter("section = 'match_rate'").count() == 0
    md = "".join(r.value + "\n" for r in spark.read.text(res.markdown_path).collect())
    assert "No knowledge base was joined." in md


def test_a8_parse_bindings_and_e4_dedup(spark):
    def b(qid, app=None, label=None):
        d = {}
        if qid:
            d["game"] = {"type": "uri", "value": f"http://www.wikidata.org/entity/{qid}"}
        if app is not None:
            d["steamAppId"] = {"type": "literal", "value": app}
        if label:
            d["gameLabel"] = {"value": label}
        return d

    page = {"results": {"bindings": [b("Q1", "70", "A"), b("Q1", "70", "B"), b(None, "x", "C"), b(None, None, "D")]}}
    pages = spark.createDataFrame([(0, json.dumps(page))], "page_no long, payload string")
    flat = parse_kb_bindings(pages)
    rows = flat.orderBy("pos").collect()
    assert [(r.wikidata_qid, r.wikidata_uri != "", r.steam_app_id, r.name) for r in rows] == [
        ("Q1", True, 70, "A"), ("Q1", True, 70, "B"), (None, False, None, "C"), (None, False, None, "D")
    ]
    kept = dedup_kb_by_qid(flat).orderBy("pos").collect()
    assert [r.name for r in kept] == ["A", "C", "D"]
    assert [r.name for r in cap_rows(flat, 2).collect()] == ["A", "B"]


def test_a9_parse_popularity_payload(spark):
    page = {
        "70": {"appid": 70, "name": "Star-Fall", "price": 999},
        "10": {"appid": "10", "name": "Cards"},
        "20": {"appid": 20, "price": "1999", "ccu": "n/a"},
    }
    pages = spark.createDataFrame([(0, json.dumps(page))], "page_no long, payload string")
    rows = {r.appid: r for r in parse_popularity_payload(pages).collect()}
    assert rows[70].price == 999 and rows[10].price is None and rows[10].developer is None
    assert rows[20].price == 1999 and rows[20].ccu is None
    assert list(parse_popularity_payload(pages).columns) == list(schemas.POPULARITY_FIELDS)


def test_parquet_round_trip_and_pushdown(spark, small_sources, tmp_path):
    from crosslink.operators.aggregate import game_summary, top_in_country

    p = str(tmp_path / "result")
    game_summary(small_sources).write.parquet(p)
    back = spark.read.parquet(p)
    assert back.count() == 196
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        top_in_country(back, "NATION_15", 25).explain(mode="formatted")
    plan = buf.getvalue()
    assert "EqualTo(wd_country,NATION_15)" in plan and "GreaterThan(num_reviews,25)" in plan
    assert "TakeOrderedAndProject" in plan
    # column pruning: only the five needed columns are read
    assert "ReadSchema: struct<app_id:int,steam_recommend_rate:double,num_reviews:bigint,title:string,wd_publisher:string,wd_country:string>" in plan
    assert F is not None


def test_b5_render_report_markdown():
    from datetime import datetime, timezone

    from crosslink.sinks.report import render_report_markdown

    rows = [
        ("record_counts", "raw:games", "rows", 200.0),
        ("null_rates", "title", "null_rate", float("nan")),
        ("summary_stats", "steam_recommend_rate", "mean", 0.66838),
        ("custom", "a|b", "m", None),
    ]
    md = render_report_markdown(
        rows, ["app_id", "title"], [(1, "A")], 1.26, datetime(2026, 1, 2, tzinfo=timezone.utc)
    )
    lines = md.splitlines()
    assert lines[2] == "_Generated: 2026-01-02 00:00:00 UTC_"
    assert "| raw:games | rows | 200 |" in lines
    assert "| title | null_rate | NaN |" in lines
    assert "| steam_recommend_rate | mean | 0.6684 |" in lines
    # no violations → an explicit "None."; unknown sections are kept, pipes escaped
    assert "None." in lines and "| a\\|b | m |  |" in lines
    assert "| 1 | A |" in lines
    assert lines[-1].endswith("1.3 s")


def test_a1_csv_keeps_columns_outside_the_schema(spark, tmp_path):
    p = tmp_path / "recs.csv"
    p.write_text("date,app_id,hours,user_id,is_recommended\n2020-01-02,1,3.5,7,True\n2020-01-01,1,9,7,False\n")
    got = read_csv(spark, str(p), schemas.RECS)
    assert got.columns == ["app_id", "user_id", "is_recommended", "date", "hours"]


def test_a6_review_order_from_a_file(spark, tmp_path):
    from dataclasses import replace

    from crosslink.operators.aggregate import game_summary

    paths = _source_files(tmp_path, with_kb=False)
    p = tmp_path / "ordered.csv"
    p.write_text("review_id,app_id,user_id,is_recommended\n10,70,1,False\n9,70,1,True\n")
    src = load_sources(spark, replace(paths, recs=str(p), review_order=("review_id",), review_types={"review_id": "bigint"}))
    row = game_summary(src).filter("app_id = 70").first()
    assert (row.num_reviews, row.num_positive_reviews) == (1, 1)  # 9 comes before 10
    with pytest.raises(ValueError, match="no_such"):
        load_sources(spark, replace(paths, review_order=("no_such",)))


def test_a2_kb_ids_may_be_quoted(spark, tmp_path):
    from crosslink.operators.resolve import kb_by_id
    from crosslink.sources.readers import read_json_lines

    p = tmp_path / "kb.json"
    p.write_text('{"wikidata_qid":"Q1","steam_app_id":"1"}\n{"wikidata_qid":"Q2","steam_app_id":2}\n')
    got = {r.app_id: r.wikidata_qid for r in kb_by_id(read_json_lines(spark, str(p), schemas.KB)).collect()}
    assert got == {1: "Q1", 2: "Q2"}


@pytest.mark.parametrize("case", ["no_review_survives", "unknown_games_only", "empty_reviews", "empty_everything"])
def test_j1_job_finishes_with_warnings(spark, tmp_path, case):
    from crosslink.sources.readers import Sources

    empty = case == "empty_everything"
    recs = {"no_review_survives": [("x", "1", "True")], "unknown_games_only": [("99", "1", "True")]}.get(case, [])
    src = Sources(
        games=spark.createDataFrame([] if empty else [("1", "Star-Fall")], "app_id string, title string"),
        metadata=spark.createDataFrame([] if empty else [("1", ["Action"])], "app_id string, tags array<string>"),
        recs=spark.createDataFrame(recs, "app_id string, user_id string, is_recommended string"),
        popularity=spark.createDataFrame([] if empty else [("1", 5)], "appid string, price int"),
        categories=spark.createDataFrame([] if empty else [("action", "Popular")], "genre string, category string"),
    )
    res = run_pipeline(spark, src, str(tmp_path / "out"))
    assert res.result.count() == 0
    rep = {(r.section, r.subject): r.value for r in res.report.collect()}
    assert rep["record_counts", "raw:recs"] == len(recs) and rep["record_counts", "processed"] == 0.0
    assert ("threshold_violations", "min_records:recs") in rep


def test_kb_from_pages_caps_only_when_asked(spark, caplog):
    from crosslink.sources.payloads import kb_from_pages

    bindings = [{"game": {"value": f"http://x/Q{i}"}} for i in range(30)]
    pages = spark.createDataFrame([(0, json.dumps({"results": {"bindings": bindings}}))], "page_no long, payload string")
    assert kb_from_pages(pages).count() == 30
    with caplog.at_level("WARNING"):
        assert kb_from_pages(pages, max_games=20).count() == 20
    assert "10 of 30 left out" in caplog.text


def test_null_rate_threshold_fires(spark):
    from crosslink.config import Options
    from crosslink.operators.quality import facts_report

    facts = spark.createDataFrame([(1, 10, None), (2, 30, "B")], "app_id int, num_reviews long, title string")
    got = {(r.section, r.subject): r.value for r in facts_report(facts, Options(max_null_rate=0.2)).collect()}
    assert got["threshold_violations", "max_null_rate:title"] == 0.25
    assert ("threshold_violations", "max_null_rate:app_id") not in got


def test_submit_script(spark, tmp_path):
    import submit_job

    paths = _source_files(tmp_path, with_kb=True)
    out = str(tmp_path / "job")
    names = ("games", "metadata", "recs", "popularity", "categories")
    argv = [x for n in names for x in (f"--{n}", getattr(paths, n))] + ["--kb", paths.kb, "--out", out, "--review-order", "user_id"]
    if paths.categories_delimiter != ",":
        argv += ["--categories-delimiter", paths.categories_delimiter]
    assert submit_job.main(argv) == 0
    assert spark.read.parquet(f"{out}/result_parquet").count() > 0
    argv[1] = str(tmp_path / "absent.csv")
    assert submit_job.main(argv) == 2
