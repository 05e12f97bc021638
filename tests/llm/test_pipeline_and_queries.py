"""The pipeline against brute force, stage by stage, and the registered queries against their SQL."""

import math
from collections import Counter

import __spark_entry__ as E
import corpus_pipeline
import duckdb
import pytest
from conftest import SF_SMALL
from llm import registry, sql
from llm.op5_quality_rules import quality
from llm.op7_sentencepiece import model_path

from llm_fixtures import alnum, awkward_texts, brute_components, brute_suffix, frame, sha

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage is written and read again, and judged on its own input."""
    import sentencepiece

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "ngram_jaccard_join", "suffix_dedup", "benchmark_decontamination", "sentencepiece"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for _, t in items if (w := alnum(t)) for k in range(max(1, len(w) - 9))}
    assert {len(w) for w in windows} == {10}
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in new.collect()}
        assert len(after) == new.count()
        rows = [(i, r.text) for i, r in before.items()]
        if name != "sentencepiece":
            assert new.columns == columns
        if name == "quality_rules":
            assert set(after) == {r.doc_id for r in quality(docs).where("kept").collect()}
        elif name == "ngram_jaccard_join":
            assert set(after) == {i for i, _, c in brute_components(rows, 80, 5) if i == c}
        elif name == "suffix_dedup":
            assert set(after) == set(before)
            for i, n, removed, _, kept_sha in brute_suffix(rows):
                if not removed:
                    assert after[i] == before[i]
                else:
                    assert n - removed - 12 <= len(after[i].text.encode()) <= n - removed and after[i].n_chars == len(after[i].text)
                    assert after[i].lang == before[i].lang and after[i].source == before[i].source
        elif name == "benchmark_decontamination":
            clean = {i for i, t in rows if not any(tuple(w[k : k + 10]) in windows for w in [alnum(t)] for k in range(len(w)))}
            assert set(after) == clean and all(after[i] == before[i] for i in clean)
        else:
            assert set(after) == set(before)
            for i, t in rows:
                ids = [*model.encode(t), model.eos_id()]
                assert after[i].ids == ids and after[i].n_tokens == len(ids) and after[i].decoded_sha256 == sha(model.decode(ids))
        kept.append(len(after))
        docs = new
    assert 0 < kept[-1] <= kept[1] < kept[0] < 200
    assert corpus_pipeline.run(spark, SF_SMALL).count() == kept[-1]


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).collect() == []


def test_stages_on_awkward_rows(spark):
    """Nulls in id and text, wordless and very long texts, repeated rows and ids, further columns."""
    prose = " ".join(f"Word{i} follows word{i * 7 % 90}." for i in range(60))
    rows = [*awkward_texts(), (None, prose), (None, prose), (90001, prose), (90002, (prose + "\n") * 400), (90003, None), (90003, "\t ")]
    docs = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    out = {name: f(spark, docs, SF_SMALL) for name, f in stages.items()}
    assert all(out[n].columns == docs.columns for n in list(stages)[:-1])
    got = {n: [(r.doc_id, r.text) for r in out[n].collect()] for n in list(stages)[:-1]}
    given, wordless = Counter(rows), [(i, t) for i, t in rows if not (t or "").split()]

    kept = {t for _, t in got["quality_rules"]}
    assert all(len((t or "").split()) >= 20 for t in kept)
    assert Counter(got["quality_rules"]) == Counter(r for r in rows if r[1] in kept)
    assert set(wordless) <= set(got["ngram_jaccard_join"]) and len(set(got["ngram_jaccard_join"])) == len(got["ngram_jaccard_join"])
    assert set(got["ngram_jaccard_join"]) <= set(rows)
    assert Counter(i for i, _ in got["suffix_dedup"]) == Counter(i for i, _ in rows)
    assert Counter(i for i, t in got["suffix_dedup"] if t is None) == Counter(i for i, t in rows if t is None)
    clean = Counter(got["benchmark_decontamination"])
    assert all(clean[r] == given[r] for r in wordless) and all(clean[r] == given[r] for r in clean)
    ends = [r.n_tokens for r in out["sentencepiece"].collect()]
    assert len(ends) == len(rows) and min(ends) == 1


def test_run_writes_each_stage(spark, monkeypatch):
    plans = []

    def noted(_, docs, __):
        plans.append(docs._jdf.queryExecution().optimizedPlan().toString())
        return docs.where("doc_id >= 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", noted), ("b", noted)])
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    assert len(plans) == 2 and "Filter" not in plans[1]


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(E.queries()) and set(registry.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(round(r[i], 5) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(out, key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    df = (registry.QUERIES | registry.FURTHER)[name](spark, SF_SMALL)
    cur = con.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, cur.fetchall())


def test_sql_is_registered():
    assert {n for n in vars(sql) if n.startswith("OP")} == {"OP6_LINKS"} | {f"OP{n[2:].split('_')[0]}" for n in registry.ORACLE_SQL}
