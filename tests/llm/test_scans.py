"""Operators 3, 5, 7 and 8 against brute force, on awkward rows and on the small tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm import op7_sentencepiece, op8_decontamination
from llm.op3_license_scan import BASE, evaluate, license_scan, postfix, rights
from llm.op5_quality_rules import COUNTS, REPEAT_WINDOW, fit, good_documents, quality
from llm.op7_sentencepiece import encode_texts, model_path
from llm.op8_decontamination import clean_documents, decontaminate

from llm_fixtures import alnum, awkward_texts, frame, sha, words


def by_row(frame_rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame_rows), key=str)


# --- 3 -----------------------------------------------------------------------------


def brute_base(text):
    w = alnum(text)
    hits = [(k, label) for phrase, label in BASE.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


LICENCE_TEXTS = [
    "All rights reserved. all RIGHTS\nreserved", "Licensed under CC BY-NC 4.0.", "cc by cc by cc", "ccby general public license, version 3",
    "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode", "// spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0",
    "SPDX-License-Identifier: (MIT", "spdx license identifier in prose", "General-Public-License", "é all rights reserved é", None, "", "general public",
]


def test_license_base_columns_and_labels(spark):
    rows = awkward_texts() + list(enumerate(LICENCE_TEXTS, 1000)) + [(None, LICENCE_TEXTS[0])]
    got = license_scan(frame(spark, rows)).collect()
    want = sorted(((i, *brute_base(t)) for i, t in rows), key=str)
    assert by_row(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    at = {r.doc_id: r for r in got}
    assert at[1000].labels == "reserved" and at[1000].score == 0.0
    assert at[1001].labels == "cc-by,cc-by-nc" and at[1001].score == rights("cc-by-nc")
    assert at[1003].labels == "gpl,gpl-3.0"
    assert at[1004].labels == "apache-2.0,bsd-3-clause,mit" and at[1004].score == 1.0
    assert at[1005].labels == "gpl-2.0-only" and at[1005].score == pytest.approx(0.7)
    assert at[1006].labels == "unparsed" and at[1006].score == 0.0
    assert at[1007].labels == "" and all(0 <= r.score <= 1 for r in got)
    assert license_scan(frame(spark, [])).collect() == []


def test_expressions():
    assert postfix("a or b and c") == ["a", "b", "c", "and", "or"]
    assert postfix("(a OR b) AND c with d") == ["a", "b", "or", "c", "d", "with", "and"]
    assert evaluate("MIT OR GPL-3.0") == ({"mit", "gpl-3.0"}, 1.0)
    assert evaluate("MIT AND GPL-3.0")[1] == rights("gpl-3.0") == 0.4
    assert evaluate("LGPL-2.1+ */")[0] == {"lgpl-2.1+"}
    for bad in ("", "and", "MIT AND", "(MIT", "MIT)", "( OR MIT)", "MIT (BSD)"):
        with pytest.raises(ValueError):
            postfix(bad)
    # any bracketing of a random tree evaluates like the tree
    rng = random.Random(3)
    names = ["mit", "gpl-3.0", "cc-by-nc", "mpl-2.0"]

    def tree(depth):
        if not depth:
            name = rng.choice(names)
            return name, rights(name)
        (a, x), (b, y) = tree(depth - 1), tree(rng.randrange(depth))
        op = rng.choice(["and", "or"])
        return f"({a} {op} {b})", (min if op == "and" else max)(x, y)

    for _ in range(50):
        text, value = tree(3)
        assert evaluate(text)[1] == value


# --- 5 -----------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[k : k + REPEAT_WINDOW]) for k in range(len(w) - REPEAT_WINDOW + 1)]
    twice = {x for x in windows if windows.count(x) > 1} if len(windows) < 400 else {x for x, n in __import__("collections").Counter(windows).items() if n > 1}
    repeated = {k + j for k, x in enumerate(windows) if x in twice for j in range(REPEAT_WINDOW)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:k] for k, x in enumerate(lines)), len(repeated)


def test_quality_base_columns(spark):
    rows = awkward_texts() + [(900, "a b\na b\n \na b\n\nc#*$ %&|<>"), (901, "a b c d e f g h " * 4), (902, "x\x0by\x0cz")]
    got = quality(frame(spark, rows)).collect()
    assert by_row(got, "doc_id", *COUNTS[:5]) == sorted(((i, *brute_counts(t)) for i, t in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert 0 <= r.p_good <= 1 and r.kept == (not r.base_failed and r.p_good >= 0.5)
    assert quality(frame(spark, [])).collect() == [] and good_documents(frame(spark, [])).collect() == []


def test_quality_verdicts_on_labelled_rows(spark):
    """Labels are never read by the operator; nearly all clean rows stay, and the bad ones go."""
    base = SF_SMALL.replace("0.001", "0.1")
    got = quality(spark.read.parquet(f"{base}/documents.parquet")).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").collect()
    clean = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in clean) > 0.995 * len(clean)
    assert sum(r.kept for r in bad) < 0.02 * len(bad)


def test_good_documents_are_the_kept_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumnRenamed("lang", "n_words").withColumnRenamed("source", "row")
    kept = {r.doc_id for r in quality(docs).where("kept").collect()}
    got = good_documents(docs)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == kept


def test_fit_finds_planted_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.7])
    votes = np.where(rng.random((20000, 4)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = -1
    patterns, member, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = fit(patterns, weight.astype(float))[member.ravel()]
    assert ((p >= 0.5) == good).mean() > 0.95


# --- 7 -----------------------------------------------------------------------------

MARKED = ["a  b ", " a", "   ", "▁", "x▁ y", "▁▁", "\n \n", "a b", "ＡＢＣ ﬁ", "<s> </s> <unk> <0x41>", "a\tb", "🙂 🙂", "x" * 5000]


@pytest.mark.parametrize("limit", [300_000, 20])
def test_encoding_equals_the_library(spark, monkeypatch, limit):
    import sentencepiece

    monkeypatch.setattr(op7_sentencepiece, "TABLE_CHUNKS", limit)
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rows = awkward_texts() + list(enumerate(MARKED, 2000))
    docs = frame(spark, rows)
    want = []
    for i, t in rows:
        ids = [*model.encode(t or ""), model.eos_id()]
        want.append((i, len(ids), ids, model.decode(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    if limit == 20:  # the table in this process: workers have their own copy of the module
        table = op7_sentencepiece.ChunkTable(model_path())
        got = [x for own in op7_sentencepiece.portions([t or "" for _, t in rows]) for x in table.encode(own)]
        assert [ids for ids, _ in got] == [w[2] for w in want]
        return
    got = encode_texts(docs).collect()
    assert by_row(got, "doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    assert encode_texts(frame(spark, [])).collect() == []


def test_notices_of_a_very_long_text_take_linear_time():
    import time

    from llm import op3_license_scan as op3

    notice = "All rights reserved under the General Public License, cc by me. "
    text = notice * (5_000_000 // len(notice))
    begin = time.perf_counter()
    n_words, n_base, first, last, base, labels, _ = op3.scan(op3.build(), text)
    assert time.perf_counter() - begin < 15
    per = len(alnum(notice))
    repeats = len(text) // len(notice)
    assert (n_words, n_base, first, last) == (per * repeats, 3 * repeats, 0, per * (repeats - 1) + 8)
    assert base == "cc-by,gpl,reserved" and set(base.split(",")) <= set(labels.split(","))


# --- 8 -----------------------------------------------------------------------------


def brute_hits(rows, items, width=10):
    out = []
    for i, t in rows:
        w = alnum(t)
        gone, ids = set(), set()
        for item, text in items:
            b = alnum(text)
            for k in range(max(1, len(b) - width + 1) if b else 0):
                own = b[k : k + width]
                for at in range(len(w) - len(own) + 1):
                    if w[at : at + len(own)] == own:
                        gone.update(range(at, at + len(own)))
                        ids |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(gone), sorted(ids)))
    return out


def contaminated_rows():
    rng = random.Random(11)
    vocabulary = ["was", "ist", "größe", "東方", "x1", "no", "yes", "why", "how", "when", "über"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(1, " ".join(make(40))), (2, "Yes; no."), (3, ""), (None, " ".join(make(12))), (10, " ".join(make(10))), (4, None), (5, "why how when")]
    items.append((6, items[0][1].upper()))
    rows = []
    for k in range(30):
        item = rng.choice([t for _, t in items if t])
        w = item.split()
        a = rng.randrange(max(1, len(w) - 9))
        rows.append((k, " — ".join([*make(rng.randint(0, 15)), *w[a : a + rng.randint(8, 14)], *make(rng.randint(0, 15))])))
    return rows + awkward_texts() + [(777, "YES, no; yes!no"), (777, "yes"), (None, items[0][1])], items


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(op8_decontamination, "BLOCK_CHARS", block)
    monkeypatch.setattr(op8_decontamination.item_blocks, "__defaults__", (block,))
    rows, items = contaminated_rows()
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    docs = frame(spark, rows)
    got = decontaminate(docs, table).collect()
    assert by_row(got, "doc_id", "n_words", "n_hit", "item_ids") == sorted(brute_hits(rows, items), key=str)
    texts = dict(rows)
    for r in got:
        assert r.contaminated == (r.n_hit > 0) == bool(r.spans)
        if r.spans and r.doc_id not in (None, 777):
            assert sum(len(alnum(texts[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit
    clean = clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r.n_hit == 0 for r in got)


def test_blocks_of_items_leave_the_plan(spark, monkeypatch):
    """With many blocks the plan has no scan of texts left: their hits are tables, read without the texts."""
    monkeypatch.setattr(op8_decontamination.item_blocks, "__defaults__", (60,))
    rows, items = contaminated_rows()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(op8_decontamination.item_blocks(table))) > 3
    plan = decontaminate(frame(spark, rows), table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "text#" not in plan.split("MapInArrow")[1]


def test_merged_runs():
    run = lambda a, b: {"first": a, "last": b, "start": 10 * a, "end": 10 * b - 1}
    assert op8_decontamination.merged([run(5, 8), run(0, 3), run(3, 4), run(6, 7), run(7, 9)]) == [run(0, 4), run(5, 9)]
    assert op8_decontamination.merged([]) == []


def test_decontamination_of_empty_tables(spark):
    rows, items = contaminated_rows()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(frame(spark, []), table).collect() == []
    assert not any(r.contaminated for r in decontaminate(frame(spark, rows), table.limit(0)).collect())


def test_slices_cover_a_batch():
    from llm.rolling import slices

    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 90, 3, 3, 200, 1)] + [None]})
    parts = list(slices(batch, "text", 10))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert list(slices(batch.slice(0, 0), "text")) == []
