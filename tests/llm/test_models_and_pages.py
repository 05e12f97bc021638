"""Operators 4, 9 and 10 on hand-made inputs, and against brute force."""

import json
import math
import random
from collections import Counter

import pytest
from conftest import SF_SMALL
from llm import exchange, op4_html_extraction
from llm.op4_html_extraction import deduce, extract, main_text, occurrences, templates
from llm.op9_lm_scoring import ADD, FOLDS, PAIR_PRIOR, PRIOR, held_out, lm_scores
from llm.op10_chat_formatting import link_tool_calls, with_tools
from pyspark.sql import functions as F

from llm_fixtures import awkward_texts, frame, lower, words

# --- 4 -----------------------------------------------------------------------------

ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body class="home"><header><p>Site name</p></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Big &amp; &eacute;lan</h1></header><p>First <b>bo</b>ld&nbsp; para<!-- no > -->.<p>Second<br>line</p>
<script>var a = "</p>";</script><aside>Aside</aside><form><label>Name</label></form><div class="ad-box ad">Buy</div>
<ul class="steps"></ul><pre>x
 y</pre><div class="comments"><p>Reader says</p></div></article></main><div id="sidebar"><p>Side</p></div><footer>Foot</footer></body></html>"""
TEXT = "Big & élan\nFirst bold para.\nSecond\nline\nx y"


def test_main_text_without_a_template():
    assert main_text(ARTICLE, [], []) == TEXT
    assert main_text("", [], []) == "" and main_text("plain &lt;words&gt;", [], []) == "plain <words>"
    assert main_text("<body><p>one</p><div class=menu>m</div><p>two", [], []) == "one\ntwo"
    assert main_text("<article>a <a href='x>y'>b</a> c</article> d", [], []) == "a b c"
    assert main_text("<article><p>a<!-- never ends <p>b", [], []) == "a"
    assert main_text("<article><script>x", [], []) == ""
    assert main_text("<article><p class='advert'>buy<p>a<li id=ad>b</li><div hidden>c</div><div style='display: none'>d</div><div class='overflow-hidden'>e</div></article>", [], []) == "a\ne"
    assert main_text("<div class='page-header'>site</div><article><div class='entry-header'><h1>T</h1></div>x</article>", [], []) == "T\nx"
    assert main_text("<article></div></p>a</article>", [], []) == "a"


def plain_site(n: int) -> list[tuple]:
    """Pages without any telling element or name: only the template shows what is content."""
    page = "<html><body><div><p>Welcome to the site</p></div><div><a href='/'>Home</a> <a href='/x'>Other</a></div><div><p>{0}</p><p>{0} more</p></div><div><p>Contact us</p></div></body></html>"
    return [(k, f"https://plain.example.com/{k}", page.format(f"story {k} " * (k + 5))) for k in range(n)]


def test_template_of_a_site_without_names(spark):
    pages = spark.createDataFrame(plain_site(8), "page_id long, url string, html string")
    (t,) = templates(pages).collect()
    assert t.host == "plain.example.com" and t.content == [">html>body>div[3]"]
    for r in extract(pages).collect():
        story = " ".join([f"story {r.page_id}"] * (r.page_id + 5))
        assert r.text == f"{story}\n{story} more" and r.n_chars == len(r.text)


@pytest.mark.parametrize("share", [1, 2, 1000])
def test_hot_and_other_hosts_get_their_templates(spark, monkeypatch, share):
    """With a share of 1 no host is hot, with 2 the larger one, with 1000 both."""
    monkeypatch.setattr(op4_html_extraction, "HOT_SHARE", share)
    rows = plain_site(8) + [(100 + k, f"https://other.example.com/{k}", h.replace("story", "tale")) for k, _, h in plain_site(4)] + [(200, None, "<p>alone")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[200] == "alone"
    for k in range(8):
        assert got[k].startswith(f"story {k}") and "Welcome" not in got[k] and "Home" not in got[k]
    for k in range(4):
        assert got[100 + k].startswith(f"tale {k}") and "Contact" not in got[100 + k]


def slot(token, pages, print1, chars=0, link=0, least=0, most=1):
    return {"token": token, "pages": pages, "total": pages, "print1": print1, "print2": 0, "chars": chars, "link_chars": link, "least_text": least, "most_text": most}


def test_deduced_template():
    own = [slot("#page", 10, 1), slot(">html", 10, 1), slot(">html>body", 10, 1), slot(">html>body>div.a", 10, 1, 900), slot(">html>body>div.b", 10, 1, 50, 0, 7, 7), slot(">html>body>div.c", 10, 1, 80, 70), slot(">html>body>div.d", 4, 2, 5000)]
    content, fixed = deduce(own)
    assert content == [">html>body>div.a"]  # div.d is in no valid class: on fewer than half of the pages
    assert ">html>body>div.b" in fixed and ">html>body>div.c" in fixed
    own.append(slot(">html>body>article", 9, 3, 10))
    assert deduce(own)[0] == [">html>body>article"]
    assert deduce([slot("#page", 1, 1), slot(">html", 1, 1)]) == ([], [])
    orphan = [slot("#page", 10, 1), slot(">html", 10, 1), slot(">html>x>article", 10, 1, 10)]
    assert deduce(orphan)[0] == []  # its parent is in no valid class


def page_texts(spark, htmls: list[str]) -> list[str]:
    rows = [(k, f"https://a.example/{k}", h) for k, h in enumerate(htmls)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[k] for k in range(len(htmls))]


def test_no_sibling_is_left_behind(spark):
    first, second = (lambda k: f"first {k} " * 30), (lambda k: f"second {k} " * 20)
    two = [f"<body><div class=one><p>{first(k)}</p></div><div class=two><p>{second(k)}</p></div><div>Contact</div></body>" for k in range(6)]
    assert page_texts(spark, two) == [f"{first(k).strip()}\n{second(k).strip()}" for k in range(6)]
    # a rare second article, and a rare article of another name
    more = [f"<body><div>site</div><article><p>{first(k)}</article>" + f"<article><p>{second(k)}</article>" * (k == 1) + f"<article class=late><p>{second(k)}</article>" * (k == 2) for k in range(6)]
    assert page_texts(spark, more) == [first(k).strip() + f"\n{second(k).strip()}" * (k in (1, 2)) for k in range(6)]


def test_one_more_element_moves_nothing(spark):
    page = "<html><body><div><p>Welcome to the site</p></div><div><a href='/'>Home</a> <a href='/x'>Other</a></div>{1}<div><p>{0}</p></div></body></html>"
    got = page_texts(spark, [page.format(f"story {k} of all", "<div><p>Flash</p></div>" * (k == 3)) for k in range(8)])
    assert got == ["Flash\n" * (k == 3) + f"story {k} of all" for k in range(8)]


def test_texts_of_the_template_within_an_article(spark):
    story = lambda k: f"story {k} " * 30
    page = "<body><article><p>Read on every page</p><p>{0}</p>{1}<ul><li>subscribe now</li></ul></article></body>"
    got = page_texts(spark, [page.format(story(k), "<p>seldom</p>" * (k < 2)) for k in range(8)])
    assert got == [story(k).strip() + "\nseldom" * (k < 2) for k in range(8)]
    # out of the template's order it is a text like others
    moved = page_texts(spark, [page.format(story(k), "") for k in range(7)] + [f"<body><article><ul><li>subscribe now</li></ul><p>{story(7)}</p><p>Read on every page</p></article></body>"])
    assert moved[:7] == [story(k).strip() for k in range(7)] and sum(x in moved[7] for x in ("Read on", "subscribe")) == 1
    # copies of an article, with a date or not, are no template
    for last in ("", "<p>seen {0}</p>"):
        copies = page_texts(spark, [f"<body><article><p>{story(1)}</p><p>{story(2)}</p>{last.format(k)}</article></body>" for k in range(5)])
        assert all(t.startswith(f"{story(1).strip()}\n{story(2).strip()}") for t in copies)


def test_template_goes_however_long_it_is(spark):
    page = "<body><article><p>tale {0}</p><div><p>Subscribe to our letter, it comes once a week and is free of charge</p><p>Copyright of this and all other pages</p></div></article></body>"
    tales = ("sun", "moon", "star", "sea", "hill")
    assert page_texts(spark, [page.format(t) for t in tales * 4]) == [f"tale {t}" for t in tales * 4]


def optional_site(n: int) -> tuple[list[str], list[str]]:
    """A site without names: a menu, a notice in its own element on some pages, one story on others, a footer."""
    tale = "".join(f"<p>the tale that many pages carry, part {k}</p>" for k in "abc")
    page = "<body><div>Welcome</div><div><a href=/>Home</a> <a href=/x>Other</a></div><div><p>{0}</p>{1}</div>{2}<div>Contact</div></body>"
    own, want = [], []
    for k in range(n):
        carried = k % 3 > 0
        story = f"story {'abcdefghijklm'[k]} " * (k + 3)
        own.append(page.format(story, tale * carried, "<div>This site keeps notes<ul><li>agree</li></ul></div>" * ((k + 1) % 3 > 0)))
        parts = [f"the tale that many pages carry, part {c}" for c in "abc"] if carried else []
        want.append("\n".join([story.strip(), *parts]))
    return own, want


def test_optional_template_and_a_story_on_many_pages(spark):
    own, want = optional_site(12)
    assert page_texts(spark, own) == want


@pytest.mark.parametrize("vector", ["shuffled", "zeros"])
def test_classes_need_their_occurrence_vectors(spark, vector):
    """Other vectors, other classes: without them the notice stays or the story goes."""
    own, want = optional_site(12)
    pages = spark.createDataFrame([(k, "https://a.example/", h) for k, h in enumerate(own)], "page_id long, url string, html string")
    slots = [r.asDict() for r in occurrences(pages).collect()]
    content, fixed = deduce(slots)
    assert [main_text(h, content, fixed) for h in own] == want
    prints = [(s["print1"], s["print2"]) for s in slots]
    random.Random(7).shuffle(prints)
    for s, p in zip(slots, prints, strict=True):
        s["print1"], s["print2"] = p if vector == "shuffled" else (0, 0)
    other = deduce(slots)  # with zeros, equally many pages make one class
    assert [main_text(h, *other) for h in own] != want


def test_article_below_a_told_off_ancestor():
    assert main_text("<body><div class='widget page'><article><p>a<div class=comments>c</div></article></div>", [], []) == "a"
    assert main_text("<body><form><main><p>a</p><div class=ad>b</div></main></form>", [], []) == "a"
    assert main_text("<article>a</article><div class=related><article>b</article></div>", [], []) == "a"
    assert main_text("<p>a</p><div hidden><article>b</article></div><aside><article>c</article></aside>", [], []) == "a"


def test_extraction_of_awkward_rows(spark):
    rows = [(1, "https://a.example/x", ARTICLE), (1, "https://a.example/x", ARTICLE), (2, None, ARTICLE), (None, "not a url", ARTICLE), (3, "https://a.example/y", None), (4, "HTTP://u@A.example:80/z", ""), (5, "https://a.example/l", "<article>" + "<p>word</p>" * 20000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, pages int")
    got = extract(pages).collect()
    texts = sorted((str(r.page_id), r.url or "", r.text) for r in got)
    assert len(got) == len(rows) and [t for *_, t in texts].count(TEXT) == 4
    assert {r.page_id: r.text for r in got}[3] == "" and {r.page_id: r.n_chars for r in got}[5] == 20000 * 5 - 1
    assert extract(pages.limit(0)).collect() == []


def test_extraction_of_the_small_table(spark):
    """These pages keep their article in an article element; everything else is to go."""
    import html
    import re

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.DOTALL)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner))
        assert r.text == "\n".join(p for p in parts if p)


# --- 9 -----------------------------------------------------------------------------


def brute_scores(rows):
    tokens = [(i, [*words(lower(t or "")), None]) for i, t in rows]
    train = [w for i, w in tokens if not held_out(i, FOLDS)]
    uni = Counter(x for w in train for x in w)
    state = Counter(x for w in train for x in ["<start>", *w[:-1]])
    pair = Counter(p for w in train for p in zip(["<start>", *w[:-1]], w, strict=True))
    triple = Counter(t for w in train for t in zip(["<start>", *w], w, w[1:], strict=False))
    after = Counter()
    for (g, h, _), c in triple.items():
        after[g, h] += c
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, w in tokens:
        base = score = 0.0
        for g, h, x in zip([None, "<start>", *w], ["<start>", *w], w, strict=False):
            p = (uni[x] + ADD) / (n + ADD * (v + 1))
            base += math.log10(p)
            p = (pair[h, x] + PRIOR * p) / (state[h] + PRIOR) if state[h] else p
            score += math.log10((triple[g, h, x] + PAIR_PRIOR * p) / (after[g, h] + PAIR_PRIOR) if after[g, h] else p)
        out.append((i, held_out(i, FOLDS), len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("shard_bytes", [2 << 20, 3000])
def test_scores(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(exchange, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 2 * shard_bytes)
    rows = awkward_texts()
    got = sorted(map(tuple, lm_scores(frame(spark, rows)).collect()), key=lambda r: (str(r[0]), *r[2:6]))
    want = sorted(brute_scores(rows), key=lambda r: (str(r[0]), *r[2:6]))
    assert len({r[4] for r in want}) == 1 and any(r[1] for r in want) and not all(r[1] for r in want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=2e-6) and g[6] == pytest.approx(w[6], abs=2e-6)
    assert lm_scores(frame(spark, [])).collect() == []


def test_automaton_is_a_distribution_and_predicts(spark):
    """Out of any state the weights sum to one; held-out texts are likelier than under single words."""
    uni, pair = Counter("aab"), Counter([("a", "a"), ("a", "b")])
    n, v = 3, 2
    p = {x: (uni[x] + ADD) / (n + ADD * (v + 1)) for x in "ab?"}  # ?: any unseen word
    assert sum(p.values()) == pytest.approx(1)
    short = {x: (pair["a", x] + PRIOR * p[x]) / (2 + PRIOR) for x in p}
    assert sum(short.values()) == pytest.approx(1)
    assert sum(((x == "b") + PAIR_PRIOR * short[x]) / (1 + PAIR_PRIOR) for x in p) == pytest.approx(1)  # out of the pair a a
    held = lm_scores(spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_third_order_tells_texts_that_occur_twice(spark):
    """With the same words and pairs, a training text that occurs twice is likelier than texts that occur once; no pair of words tells them apart."""
    ids = [i for i in range(1, 200) if not held_out(i, FOLDS)]
    rows = [(ids[0], "a b c"), (ids[1], "a b c"), (ids[2], "a b d"), (ids[3], "e b d"), (ids[4], "e b d"), (ids[5], "e b c")]
    score = {r.doc_id: r.score for r in lm_scores(frame(spark, rows)).collect()}
    assert score[ids[0]] == score[ids[1]] > score[ids[2]] and score[ids[3]] == score[ids[4]] > score[ids[5]]
    pairs = {r.doc_id: r.score for r in lm_scores(frame(spark, rows), pair_prior=1e12).collect()}
    assert pairs[ids[0]] == pytest.approx(pairs[ids[2]], abs=1e-5)


# --- 10 ----------------------------------------------------------------------------


def call(*calls, content="c"):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls], "content": content})


def result(i, content="r"):
    return json.dumps({"content": content, "tool_call_id": i})


def test_tool_calls_are_linked_ordered_and_checked(spark):
    rows = [
        (1, 0, "tool", result("b", 'late "é"')),  # before its call
        (1, 1, "user", 'q "x"\n'),
        (1, 2, "assistant", call(("a", "find", {"text": "t", "pattern": "p"}), ("b", "count_words", {"text": "t", "limit": 3}))),
        (1, 3, "tool", result("a")),
        (1, 4, "tool", result("none")),
        (1, 5, "assistant", call(("a", "find", {"text": "again", "pattern": "p"}))),
        (1, 6, "tool", result("a", {"z": 1, "a": [2]})),
        (2, 0, "tool", result("a")),
        (3, 0, "assistant", "not { json"), (3, 1, "assistant", None), (3, 2, "tool", ""), (None, 0, "tool", result("a")), (3, 3, None, "x"),
        (4, 0, "assistant", call(("1", "find", {"text": "t"}), ("2", "find", {"text": 1, "pattern": "p"}), ("3", "find", {"text": "", "pattern": "", "more": 0}), ("4", "nope", {}), ("5", "count_words", {"text": "t", "limit": 2.5}), ("6", "count_words", None), ("7", "count_words", {"text": "t"}))),
    ]
    messages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, json string, calls int")
    got = link_tool_calls(messages).collect()
    assert len(got) == len(rows)
    first = sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_step, r.order_call, r.turn))
    assert [r.turn for r in first] == [1, 2, 3, 6, 0, 4, 5]
    assert [r.linked for r in first] == [False, False, True, True, True, False, False]
    texts = {r.turn: r.json for r in first}
    assert texts[1] == '{"content":"q \\"x\\"\\n","role":"user"}'
    assert texts[0] == '{"content":"late \\"é\\"","role":"tool","tool_call_id":"b"}'
    assert texts[6] == '{"content":"{\\"a\\":[2],\\"z\\":1}","role":"tool","tool_call_id":"a"}'
    assert json.loads(texts[2])["tool_calls"][0] == {"arguments": {"pattern": "p", "text": "t"}, "id": "a", "name": "find", "valid": True}
    assert texts[2].index('"pattern"') < texts[2].index('"text"') and " " not in texts[2]
    rest = {(r.conv_id, r.turn): r for r in got if r.conv_id != 1}
    assert not rest[2, 0].linked and not rest[None, 0].linked and rest[3, 0].kind == "content" and rest[3, 3].json == '{"content":"x"}'
    checks = [c["valid"] for c in json.loads(rest[4, 0].json)["tool_calls"]]
    assert checks == [False, False, False, False, False, False, True] and (rest[4, 0].n_calls, rest[4, 0].n_valid) == (7, 1)
    assert link_tool_calls(messages.limit(0)).collect() == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, 0, "assistant", call(("a", "find", {"text": "t", "pattern": "p"})))] * 2 + [(1, 1, "tool", result("a"))] * 3
    got = link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 5 and sum(r.linked for r in got) == 3 and {r.order_turn for r in got if r.linked} == {0}


def test_no_python_in_the_native_plan(spark):
    df = link_tool_calls(with_tools(spark.read.parquet(f"{SF_SMALL}/conversations.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapPartitions", "Window"))
    ids = {(r.conv_id, r.call_id) for r in df.where("kind = 'result' AND linked").collect()}
    assert ids and all(i % 7 for i, _ in ids)
