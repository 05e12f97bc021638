"""Operators 11 to 13 against brute force, on awkward rows and in small blocks, ranges and filters."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm import op11_hard_negatives as op11
from llm import op12_phrase_collocations as op12
from llm import op13_line_dedup as op13

from llm_fixtures import awkward_texts, frame, lower, sha

# --- 11 ----------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=10, band=(30, 90), every=100):
    code = {}
    for i, label, v in sorted((r for r in rows if None not in r[:2] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0], (label_of(r), r[2]))):
        code.setdefault(i, (label_of((i, label)), [int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256) for x in v]))
    out = []
    for a, (label, v) in code.items():
        if math.fmod(a, every):
            continue
        scored = sorted(((max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), i, own) for i, (own, w) in code.items() if i != a), key=lambda s: (-s[0], s[1]))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            far = [s for s in scored if s[2] != label and band[0] * p <= 100 * s[0] <= band[1] * p][:negatives]
            out += [(a, i, k, j, p, s) for k, (s, j, _) in enumerate(far, 1)]
    return sorted(out)


def label_of(row):
    return int(math.fmod(row[1] + 1, 10)) if row[0] % 7 == 0 else row[1]


def vectors(seed: int, n: int, sizes=(1.0,), dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in rng.sample(range(-50, 4 * n), n):
        v = [rng.choice(sizes) * (x + rng.gauss(0, 0.6)) for x in rng.choice(centres)]
        rows.append((i, rng.randrange(4), v))
    return rows


SHAPE = "vec_id long, label int, embedding array<double>, rank int, block string, score string"


def negatives_of(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "b", "s") for r in rows], SHAPE)
    return sorted(tuple(r) for r in op11.hard_negatives(df, **more).collect())


@pytest.mark.parametrize("sizes", [(1.0,), (0.01, 1.0, 3.0, 900.0)])
def test_hard_negatives_in_small_blocks(spark, monkeypatch, sizes):
    monkeypatch.setattr(op11, "LEAST_ROWS", 16)
    monkeypatch.setattr(op11, "CHUNK_ROWS", 7)
    rows = vectors(3, 240, sizes)
    got = negatives_of(spark, rows, anchor_every=10)
    assert got == brute_negatives(rows, every=10) and len(got) > 100


def test_hard_negatives_of_awkward_rows(spark):
    rows = vectors(8, 60)
    rows += [(None, 1, [1.0] * 6), (1000, None, [1.0] * 6), (1001, 1, None), (1002, 1, [1.0, None]), (1003, 2, [math.nan] * 6), (1004, 2, [1.0, math.inf])]
    rows += [(1100, 0, []), (1200, 1, [0.0] * 6), (1300, 2, [1.0, 2.0]), (1301, 2, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 5.0]), (1302, 3, [0.8, 1.0])]
    rows += [rows[0], rows[1], (rows[2][0], rows[2][1], [9.0] * 6), (1400, 1, [2.0] * 6), (1400, 1, [2.0] * 6)]
    assert negatives_of(spark, rows, anchor_every=4) == brute_negatives(rows, every=4)
    assert negatives_of(spark, []) == []
    assert negatives_of(spark, [(100, 1, [1.0])]) == []


def test_hard_negatives_beyond_doubles_and_longs(spark):
    rows = [(100, 1, [1e6, 1e7 + 0.003]), (101, 1, [1e9, 123456789.123]), (102, 2, [6e8, 1e8]), (103, 2, [6e8, 1e8 + 1]), (104, 3, [1e9, 2.0])]
    assert negatives_of(spark, rows) == brute_negatives(rows)
    rows += [(200, 1, [1e200, -1e180]), (201, 2, [1e200, 3.0]), (202, 1, [1e155, 1e155])]
    assert negatives_of(spark, rows) == brute_negatives(rows)


def test_ranges_of_focus_coordinates_lose_no_row_and_leave_rows_out():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(500, 8)) * rng.uniform(0.9, 1.0, (500, 1))
    table = pa.table({"vec_id": np.arange(500), "label": np.zeros(500, np.int64), "vector": pa.array(v.tolist(), pa.list_(pa.float64()))})
    lists = op11.Lists(table, 8)
    left_out = 0
    for i in range(0, 500, 10):
        score = lists.codes @ lists.codes[i]
        for least in (int(np.sort(score)[-6]), 1, 0, -1000):
            rows = lists.feasible(lists.codes[i], float(lists.vectors.long[i]), least)
            rows = np.arange(500) if rows is None else rows
            assert set(np.flatnonzero(score >= least)) <= set(rows.tolist())
            left_out += 500 - len(rows)
    assert left_out > 50 * 150


def test_blocks_hold_neighbouring_sizes():
    runs = op11.blocks_of([(-5, 3), (-4, 4), (0, 1000), (1, 2), (7, 1)], 10)
    assert runs == [(-5, 0, 0, 101), (1, 7, 101, 1)] or runs[0][:2] == (-5, 0)
    assert [r[2] for r in runs[1:]] == [r[2] + r[3] for r in runs[:-1]]


# --- 12 ----------------------------------------------------------------------


def brute_collocations(rows, least=30, top=2000):
    count, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        said = lower(text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            said = said.replace(c, "\0|")
        for piece in said.split("\0|"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            words[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    count[lang][tuple(w[i : i + n])] += 1
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {p[i : i + m] for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * f[p[i : i + m]]}
        scored = []
        for p, a in candidates.items():
            if p not in hidden:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -s))
    return sorted(out)


def said(seed: int, n: int):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "東方", "x" * 300, "—", "a\x00b", "\x01", "b c"] + [f"w{k}" for k in range(20)]
    fixed = ["new york city", "of the", "of the of the", "é 東方 x\ty", "one two three four five", "b c w1"]
    make = lambda: "".join(rng.choice([*vocabulary, *fixed]) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "; "]) for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice(["en", "en", "de", None, "und"]), make()) for _ in range(n)]
    return rows + [("en", None), ("de", ""), ("en", " \n\t "), (None, "of the " * 4000), ("fr", "alone"), *rows[:3]]


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, g, 1, "p", "q", 2) for k, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string, part string, f int").repartition(5)


@pytest.mark.parametrize("ranges", [1 << 30, 4000])
def test_collocations(spark, monkeypatch, ranges):
    monkeypatch.setattr(op12, "RANGE_BYTES", ranges)
    monkeypatch.setattr(op12, "LEAST_RANGE_BYTES", ranges)
    rows = said(2, 300)
    got = sorted(tuple(r) for r in op12.collocations(docs_of(spark, rows)).collect())
    assert got == brute_collocations(rows) and len(got) >= 20
    few = sorted(tuple(r) for r in op12.collocations(docs_of(spark, rows), least=3, top=5).collect())
    assert few == brute_collocations(rows, 3, 5)


def test_heavy_pairs_are_spread_and_summed(spark, monkeypatch):
    monkeypatch.setattr(op12, "RANGE_BYTES", 2000)
    rng = random.Random(1)
    rows = [("en", " ".join(rng.choice(["of the", f"w{rng.randrange(40)}", "of the of"]) for _ in range(60))) for _ in range(200)]
    docs = docs_of(spark, rows)
    pairs, triples = op12.heavy_prefixes(docs.select("lang", "text"), 10**5, 50)
    assert len(pairs) and len(triples)
    counted, words = op12.counted_phrases(docs, 30)
    want = Counter()
    for _, t in rows:
        w = t.split(" ")
        want.update(" ".join(w[i : i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
    assert {r.phrase: r.f for r in counted.collect()} == {p: c for p, c in want.items() if c >= 30}
    assert [tuple(r) for r in words.collect()] == [("en", sum(len(t.split(" ")) for _, t in rows))]


def test_collocations_of_an_empty_table(spark):
    assert op12.collocations(docs_of(spark, [("en", "a")]).limit(0)).collect() == []


def random_automaton(seed: int):
    rng = random.Random(seed)
    text = [rng.choice("abcdefg.") for _ in range(300)]
    vocabulary = op12.Vocabulary()
    numbers = np.array([vocabulary[op12.BREAK if c == "." else c.encode()] for c in [*text, "."]], np.int32)
    words, paths, counts = op12.n_grams(numbers, list(vocabulary)[1:])
    return op12.CountAutomaton.of(words, paths, counts)


def phrases(a):
    return {tuple(a.words[k - 1] for k in p if k): int(w) for p, w in zip(a.paths(), a.weights)}


def test_automata_unite_compose_and_travel():
    a, b = random_automaton(1), random_automaton(2)
    both = op12.CountAutomaton.union([a, b])
    assert phrases(both) == dict(Counter(phrases(a)) + Counter(phrases(b)))
    assert list(phrases(both)) == sorted(phrases(both))
    again = op12.CountAutomaton.from_bytes(both.to_bytes())
    assert phrases(again) == phrases(both) and again.words == both.words
    assert [*a.composed(b)] == [phrases(a).get(p, 0) for p in phrases(b)]
    assert len(both.labels[0]) == len(both.words) and sum(both.below[0]) == len(both.labels[1])  # prefixes are shared


# --- 13 ----------------------------------------------------------------------


def brute_lines(rows, documents=10, chars=1, keep_first=False):
    split = [[(x, lower(x.strip(" \t\n\x0b\x0c\r"))) for x in (t or "").split("\n")] for _, t in rows]
    name = [(i is None, t if i is None else i) for i, t in rows]
    seen = defaultdict(set)
    for lines, who in zip(split, name):
        for _, k in lines:
            seen[k].add(who)
    gone = {k for k, s in seen.items() if len(s) >= documents and len(k) >= chars}
    out = []
    for (i, _), lines, who in zip(rows, split, name):
        kept, once = [], set()
        for line, k in lines:
            stays = keep_first and k not in once and who == min(seen[k])
            if k not in gone or stays:
                kept.append(line)
            once.add(k)
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def lines_of(spark, rows, **more):
    df = op13.without_repeated_lines(frame(spark, rows).repartition(6), **more)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.kept)) for r in df.collect()), key=str)


def line_rows():
    rng = random.Random(4)
    common = ["Subscribe", "  subscribe\t", "ÉTÉ", "été", "a", "", " ", "東", "x" * 5000]
    rows = [(k, "\n".join(rng.choice([*common, f"own {k}", f"shared {k // 4}", f"line {rng.randrange(30)}"]) for _ in range(rng.randint(1, 12)))) for k in range(120)]
    return rows + awkward_texts() + [(7, "Subscribe\nagain"), (None, "line 1"), (3000, "Subscribe\n" * 5000)]


@pytest.mark.parametrize("documents, chars, bits", [(10, 1, op13.MOST_BITS), (2, 1, 1 << 18), (3, 2, 1 << 20)])
def test_repeated_lines(spark, documents, chars, bits):
    rows = line_rows()
    got = lines_of(spark, rows, least_documents=documents, least_chars=chars, most_bits=bits)
    assert got == brute_lines(rows, documents, chars) and sum(r[2] for r in got) > 100


def test_first_line_stays(spark):
    rows = [r for r in line_rows() if r[0] is not None]
    assert lines_of(spark, rows, least_documents=4, keep_first=True) == brute_lines(rows, 4, keep_first=True)


def test_lines_of_an_empty_table(spark):
    assert op13.without_repeated_lines(frame(spark, line_rows()).limit(0)).collect() == []
    with pytest.raises(ValueError):
        op13.without_repeated_lines(frame(spark, line_rows()), least_documents=1)


def test_only_keys_in_the_twice_seen_filter_leave_their_task(spark):
    rows = [(k, "\n".join(f"{k} {j}" for j in range(50)) + f"\npair {k // 2}") for k in range(400)]
    df = frame(spark, rows)
    sent = spark.sparkContext.broadcast(op13.seen_twice(df))
    found = df.selectExpr("doc_id AS doc", "false AS nameless", "text").mapInArrow(op13._suspect(sent, 1), "doc long, nameless boolean, key binary")
    keys = Counter(bytes(r.key) for r in found.collect())
    assert {op13.digest(f"pair {k}".encode()) for k in range(200)} <= set(keys) and len(keys) < 400


def test_a_saturated_filter_costs_no_result(spark):
    rows = [(k, f"same {k % 3}\nown {k}") for k in range(60)]
    filtered = np.full(1 << 15, 255, np.uint8)
    sent = spark.sparkContext.broadcast(filtered)
    df = frame(spark, rows)
    found = df.selectExpr("doc_id AS doc", "false AS nameless", "text").mapInArrow(op13._suspect(sent, 1), "doc long, nameless boolean, key binary")
    assert found.count() == 120
