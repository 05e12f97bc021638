"""Operators 1, 2 and 6 against brute force, over many small shards and buckets."""

import hashlib
import random

import pytest
from llm import exchange, op2_suffix_dedup, op6_ngram_jaccard_join
from llm.op1_substring_dedup import block_words, substring_dedup
from llm.op2_suffix_dedup import suffix_dedup, without_repeats
from llm.op6_ngram_jaccard_join import distinct_documents, early_length, jaccard_components, jaccard_links, labelled_classes, prefix_length, visits
from pyspark.sql import functions as F

from llm_fixtures import awkward_texts, brute_components, brute_substring, brute_suffix, frame, shingles


@pytest.fixture(params=["one shard", "many shards"])
def sizes(request, monkeypatch):
    if request.param == "many shards":
        monkeypatch.setattr(exchange, "SHARD_BYTES", 6000)
        monkeypatch.setattr(exchange, "BUCKET_BYTES", 9000)
        monkeypatch.setattr(op2_suffix_dedup, "SHARD_BYTES", 5000)


def ordered(rows):
    return sorted(rows, key=str)


def test_substring_dedup(spark, sizes):
    rows = awkward_texts()
    got = substring_dedup(frame(spark, rows).repartition(3)).collect()
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == ordered(brute_substring(rows))
    assert sum(r.n_removed for r in got) > 300


def test_block_words_fit_every_window():
    for window in range(1, 40):
        b = block_words(window)
        # some block start lies so that the block ends inside the window, for all phases
        assert all(any((phase + k) % b == 0 and k + b <= window for k in range(window)) for phase in range(b))


def test_suffix_dedup(spark, sizes):
    rows = [(i, t) for i, t in awkward_texts() if i is not None]
    got = suffix_dedup(frame(spark, rows)).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == ordered(brute_suffix(rows))
    assert sum(r.n_removed for r in got) > 3000


@pytest.mark.parametrize("length", [20, 32, 64, 150])
def test_suffix_dedup_of_other_lengths(spark, length):
    rows = [(i, t) for i, t in awkward_texts(9)[:30] if i is not None]
    got = suffix_dedup(frame(spark, rows), length).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == ordered(brute_suffix(rows, length))


def test_suffix_dedup_null_ids_come_last(spark):
    text = "the quick brown fox " * 1 + "jumps over some lazy dogs and then goes on for quite a long while until the line is full"
    got = suffix_dedup(frame(spark, [(None, text * 2), (4, text * 2)])).collect()
    assert {r.doc_id: r.n_removed > 100 for r in got} == {None: True, 4: True}  # the second half repeats the first
    assert next(r.n_removed for r in got if r.doc_id is None) == len(text) * 2


def test_suffix_dedup_of_null_ids(spark, sizes):
    """Each passage stays once, in one shard or many; copies of a text are one document."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passages = [" ".join(word() for _ in range(30)) for _ in range(3)]
    texts = [f"{' '.join(word() for _ in range(40))} {p} {' '.join(word() for _ in range(40))}" for p in passages * 12]
    texts += [texts[0], texts[0], None, "short"]
    key = lambda t: int.from_bytes(hashlib.blake2b((t or "").encode(), digest_size=8).digest(), "little") | 1
    rows = [(7, texts[5]), *((None, t) for t in texts)]
    want = brute_suffix([((0, 7) if i is not None else (1, key(t)), t) for i, t in rows])
    want = [(7 if i == (0, 7) else None, *x) for i, *x in want]
    docs = frame(spark, rows).repartition(3)
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs).collect()) == ordered(want)
    left = [r.text or "" for r in without_repeats(docs).collect()]
    assert len(left) == len(rows) and [sum(p in t for t in left) for p in passages] == [1, 1, 1]


def test_without_repeats_keeps_rows_and_columns(spark, sizes):
    rows = [(i, t) for i, t in awkward_texts() if i is not None]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    got = without_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    kept = {r[0]: (r[1], r[2]) for r in zip([x[0] for x in rows], [x[1] for x in rows], brute_suffix(rows), strict=True)}
    for r in got.collect():
        text, (_, n, removed, _, _) = kept[r.doc_id]
        assert (r.text is None) == (text is None) and r.lang == "en" and r.row == "r"
        if text and not removed:
            assert r.text == text and r.n_chars == len(text)


@pytest.mark.parametrize("block_sets", [1000, 4])
def test_jaccard_components(spark, sizes, block_sets):
    rows = awkward_texts()
    got = jaccard_components(frame(spark, rows).repartition(3), block_sets=block_sets).collect()
    assert ordered(map(tuple, got)) == ordered(brute_components(rows))
    assert sum(r.component_id != r.doc_id for r in got) > 8


def near_copies(n: int, seed: int) -> list[tuple[int, str]]:
    """A chain of texts, each a few words from the last: ends are far apart, so links matter one by one."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    own = [word() for _ in range(80)]
    rows = []
    for i in range(n):
        own = list(own)
        if i % 3:
            own[rng.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_hot_groups_lose_no_link(spark, monkeypatch, seed):
    """Groups split over many small tries, with chains that only single links hold together."""
    monkeypatch.setattr(exchange, "SHARD_BYTES", 4000)
    rows = near_copies(60, seed) + [(100 + i, t) for i, t in near_copies(25, seed + 50)]
    got = jaccard_components(frame(spark, rows), block_sets=3).collect()
    assert ordered(map(tuple, got)) == ordered(brute_components(rows))


@pytest.mark.parametrize("block_sets", [1000, 3])
def test_all_links_are_counted(spark, monkeypatch, block_sets):
    """Groups of many linked texts, copies among them, in one trie and over many."""
    monkeypatch.setattr(op6_ngram_jaccard_join, "PROBING", 2)
    rows = near_copies(45, 7) + [(100 + i, t) for i, t in near_copies(15, 8)] + [(None, "one two"), (None, "one two"), (300, ""), (301, None)]
    sets = [shingles(t) for _, t in rows]
    links = [sum(a != b and len(x & y) > 0 and 100 * len(x & y) >= 85 * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)]
    got = jaccard_links(frame(spark, rows), block_sets=block_sets).collect()
    assert ordered(map(tuple, got)) == ordered((i, len(x), n) for (i, _), x, n in zip(rows, sets, links, strict=True))
    assert max(links) > 5


def test_prefix_length_is_exact():
    for n in range(1, 200):
        # a partner with none of the prefix shares too few
        assert 100 * (n - prefix_length(n, 85)) < 85 * n <= 100 * (n - prefix_length(n, 85) + 1)


def test_early_length_is_exact():
    for p in (80, 85):
        for n in range(1, 200):
            # a partner of n or more with none of the early ones shares too few; with one more it can link
            short = n - early_length(n, p)
            assert (100 + p) * short < p * 2 * n <= (100 + p) * (short + 1)
            assert early_length(n, p) <= prefix_length(n, p)


@pytest.mark.parametrize("percent", [60, 85])
def test_links_of_sets_of_unlike_sizes(spark, percent):
    """Texts that are parts of others, so that sizes decide which shingles must meet; tries of two sets."""
    rng = random.Random(percent)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(i, " ".join(base[(a := rng.randrange(20)) : a + rng.randrange(55, 100)])) for i in range(40)]
    got = jaccard_components(frame(spark, rows), percent=percent, block_sets=2).collect()
    sets = [shingles(t) for _, t in rows]
    links = [sum(a != b and 100 * len(x & y) >= percent * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)]
    assert ordered(map(tuple, got)) == ordered(brute_components(rows, percent, 4))
    assert ordered(tuple(r) for r in jaccard_links(frame(spark, rows), percent=percent, block_sets=2).collect()) == ordered((i, len(x), n) for (i, _), x, n in zip(rows, sets, links, strict=True))
    assert 0 < sum(links) < len(rows) * (len(rows) - 1)


def passages(n: int) -> list[tuple[int, str]]:
    """Unlike texts of six passages of 30 words, each passage in about 24 texts: no link."""
    rng = random.Random(n)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    pool = [" ".join(word() for _ in range(30)) for _ in range(n // 4)]
    return [(i, " ".join(rng.sample(pool, 6))) for i in range(n)]


def test_shared_passages_send_few_probes(spark, monkeypatch):
    """Twice the texts give about twice the probes."""
    sent = {}
    for n in (400, 800):
        seen = []

        def noted(sets, own, seen=seen):
            out = visits(sets, own)
            seen.append(out.count())
            return out

        monkeypatch.setattr(op6_ngram_jaccard_join, "visits", noted)
        linked = labelled_classes(frame(spark, passages(n)), 4, 85, 25)[1]
        assert linked.where("label != cls").isEmpty()
        sent[n] = sum(seen)
    assert sent[800] <= 2.3 * sent[400] + 50


def test_distinct_documents(spark, sizes):
    rows = awkward_texts()
    docs = frame(spark, rows)
    got = distinct_documents(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    least = {(i, t): c for (i, t), (_, _, c) in zip(rows, brute_components(rows), strict=True)}
    assert len(kept) == len(set(kept))
    assert {k for k in kept if k[0] is not None} == {k for k, c in least.items() if k[0] is not None and k[0] == c}
    assert sum(bool(shingles(t)) for _, t in kept) < len({shingles(t) for _, t in rows})


def test_rows_that_share_a_doc_id_stay_apart(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(5, a), (5, b), (9, a), (7, b + " more")]
    got = jaccard_components(frame(spark, rows)).collect()
    assert ordered(map(tuple, got)) == ordered(brute_components(rows))
    assert {(r.doc_id, r.text) for r in distinct_documents(frame(spark, rows)).collect()} == {(5, a), (5, b)}


def test_ids_of_all_64_bits(spark):
    """Hash ids: no range is reserved, the least is a component's id, and null ids come after all others."""
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(2**62 + 5, a), (2**62 + 9, a), (2**63 - 1, b), (None, b), (-(2**63), "one"), (None, "one"), (2**63 - 1, "two"), (None, "three")]
    assert ordered(map(tuple, jaccard_components(frame(spark, rows)).collect())) == ordered(brute_components(rows))
    assert ordered((r.doc_id, r.n_links) for r in jaccard_links(frame(spark, rows)).collect()) == ordered((i, sum(t == u for _, u in rows) - 1) for i, t in rows)
    kept = [(2**62 + 5, a), (2**63 - 1, b), (-(2**63), "one"), (2**63 - 1, "two"), (None, "three")]
    assert ordered((r.doc_id, r.text) for r in distinct_documents(frame(spark, rows)).collect()) == ordered(kept)


def test_one_row_of_each_component_stays(spark):
    """Rows that share a doc_id with near copies, and one whose doc_id is the least of another group."""
    a, b = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    changed = " ".join([*a[:-1], "other"])
    a, b = " ".join(a), " ".join(b)
    kept = distinct_documents(frame(spark, [(5, a), (5, changed)])).collect()
    assert len(kept) == 1 and kept[0].text in (a, changed)
    rows = [(3, a), (5, changed), (5, b), (8, b), (9, ""), (9, ""), (9, " ")]
    assert ordered((r.doc_id, r.text) for r in distinct_documents(frame(spark, rows)).collect()) == ordered([(3, a), (5, b), (9, ""), (9, " ")])


def test_empty_tables(spark):
    empty = frame(spark, [])
    for f in (substring_dedup, suffix_dedup, jaccard_components, without_repeats, distinct_documents):
        assert f(empty).collect() == []
    assert op6_ngram_jaccard_join.BLOCK_SETS > 0
