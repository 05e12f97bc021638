"""Main text of web pages by template deduction.

1. Every page is parsed into *tokens*: its container elements, named by their
   path with class and role words and by their number among equal siblings, and
   its blocks of text, named by their text and their container's path without
   numbers.  For each host and token Spark adds up the
   occurrence vector over all the host's pages as a fingerprint, so tokens fall
   into one equivalence class if they occur equally often on every page.  Sums
   are formed in the tasks first; a host with a third of all pages adds a few
   rows a task.
2. A class is valid, as a whole, if it occurs on at least half of the host's
   pages and nests: the parent of each of its elements belongs to a valid class
   too.  The nested valid classes are the host's template; what stands between
   their tokens are slots.  A text is template if its class, on three pages or
   more and once on each, also holds the markup around it: the page itself (the
   outermost class), or an element of the path that the text stands in (a notice
   that only some pages have brings its own element).  Texts whose class has no
   such markup, as those of a story that many pages carry, are data in a slot of
   the class around them.  A class is no template either if its slots are empty,
   that is if its pages show the same texts but for digits (copies of one
   article, with a date or not).  On a page the texts of valid classes go as far
   as they come in the order that they have on the host, however long they are.
3. Slots of menus, adverts, forms, comments and the like (by element, class or
   role), slots with one and the same text on all pages, and slots that are
   mostly links are no content.  If the template has an article or main element,
   content is what stands in such elements; else it is all that is left.
4. Every page is parsed again with its host's template, and the text of the
   content is returned: character references decoded, white space in a
   block turned into one space, blocks in page order joined by a newline.  Fixed
   slots are known again by their path without sibling numbers and their text,
   link slots by that path and their links on the page itself, so an element more
   or less on a page moves nothing.

All article and main elements of a page count, also those that few pages of the
host have.  A main element below an ancestor whose name or form element tells it
off is shown; an article there if the page has no other article or main text.  A
page without such elements, or whose host has no template, gives its own article
or main elements, or else its body without the slots named above.

Defined results: a null or empty page, or one without content, has empty text; a
null or malformed url has the empty host; repeated rows are extracted each; a
null page_id stays null; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.storage import saved

RAW = "script|style|textarea|title|xmp"
MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*+>", re.DOTALL | re.IGNORECASE)
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
NUMBER = re.compile(r"\[\d+\]")
DIGITS = re.compile(r"\d+")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
UNSEEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
UNSEEN_FLAG = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.IGNORECASE)
CONTAINERS = frozenset("html head body nav header footer aside main article section div form ul ol table figure dialog menu noscript template iframe svg button select details fieldset object video audio canvas".split())
SEPARATORS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li tr td th caption thead tbody tfoot br hr pre blockquote dl dt dd address figcaption summary legend option center hgroup".split())
NO_CONTENT_TAGS = frozenset("head nav footer aside form noscript template iframe svg button select menu dialog object video audio canvas".split())
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu menubar nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup login comment comments commentlist disqus respond replies share sharing social related recommended recommendations popup modal overlay pagination pager widget widgets complementary contentinfo search skip".split()
)
MAIN_WORDS = frozenset("main articlebody".split())
MAIN_TAGS = frozenset(("article", "main"))
SUPPORT = 0.5  # share of a host's pages that a valid class needs
LEAST_PAGES = 3  # a slot is fixed and a text is template only if seen on so many pages
MOST_TOKENS = 50_000  # sums held in a task before they are passed on
SLOTS = "host string, token string, pages long, total long, print1 long, print2 long, chars long, link_chars long, least_text long, most_text long"
TEMPLATE = "host string, pages long, content array<string>, fixed array<string>"
HOT_SHARE = 1000  # a host with more than a thousandth of all pages is hot; there are fewer than a thousand
RESULT = "page_id long, url string, text string, n_chars long"
PAGE = "#page"


class Element:
    """``hard``: hidden for good; ``soft``: told off by a name or form; ``again``: in an article below one that is told off."""

    __slots__ = ("tag", "path", "hard", "soft", "main", "again", "place", "kids")

    def __init__(self, tag: str = "", path: str = "", hard: bool = False, soft: bool = False, main: bool = False, again: bool = False):
        self.tag, self.path, self.hard, self.soft, self.main, self.again = tag, path, hard, soft, main, again
        self.place: str | None = None  # hash of the path without numbers, once asked for
        self.kids: dict[str, int] = {}  # how many children of a name have come

    @property
    def hidden(self) -> bool:
        return self.hard or self.soft


def host_of(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def names(rest: str) -> list[str]:
    """Words of an element's class, id, role and itemprop."""
    return sorted({w for m in NAMES.findall(rest) for w in WORD.findall("".join(m).lower())}) if "=" in rest else []


def out_of_sight(rest: str) -> bool:
    return bool(rest and (UNSEEN.search(rest) or UNSEEN_FLAG.search(QUOTED.sub("", rest))))


def told_off(rest: str, words: list[str]) -> bool:
    """Whether an element's names or attributes say that it is no content."""
    return not NO_CONTENT_WORDS.isdisjoint(words) or out_of_sight(rest)


def element(tag: str, rest: str, parent: Element) -> Element:
    words = names(rest)
    main = tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)
    whole = tag in ("html", "body", "main") or (tag == "article" and "comment" not in words)
    head = (tag == "header" or "header" in words) and not (parent.main or parent.again) and not whole
    hard = parent.hard or (tag in NO_CONTENT_TAGS and tag != "form") or (not whole and out_of_sight(rest))
    off = tag == "form" or head or (not whole and not NO_CONTENT_WORDS.isdisjoint(words))
    soft = (parent.soft or off) and tag != "main"
    again = soft and not hard and not off and (parent.again or (tag == "article" and whole))
    name = ".".join([tag, *words])
    k = parent.kids[name] = parent.kids.get(name, 0) + 1
    return Element(tag, f"{parent.path}>{name}" + f"[{k}]" * (k > 1), hard, soft, parent.main or (main and not hard and not soft), again)


def unnumbered(path: str) -> str:
    return NUMBER.sub("", path)


def is_main(path: str) -> bool:
    tag, *words = unnumbered(path).rpartition(">")[2].split(".")
    return tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)


def blocks(page: str) -> Iterator[tuple[Element, str, int]]:
    """(innermost container, text, characters in links) of each block; an empty text tells that a container opens."""
    stack, text, link, in_link, at, unseen = [Element()], [], 0, False, 0, False

    def flush():
        nonlocal link
        out = " ".join(references.unescape("".join(text)).split()) if text and not unseen else ""
        text.clear()
        n, link = link, 0
        return [(stack[-1], out, min(n, len(out)))] if out else []

    for m in MARKUP.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            link += (m.start() - at) * in_link
        at = m.end()
        tag = (m["tag"] or "").lower()
        if tag == "a":
            in_link = not m["end"]
        if tag not in SEPARATORS:
            continue
        yield from flush()
        # a paragraph, item or the like may be named as no content too; that holds up to the next block
        unseen = tag not in CONTAINERS and not m["end"] and bool(m["rest"]) and told_off(m["rest"], names(m["rest"]))
        if tag not in CONTAINERS:
            continue
        if not m["end"]:
            if not m["rest"].endswith("/"):
                stack.append(element(tag, m["rest"], stack[-1]))
                yield stack[-1], "", 0
        else:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
    text.append(page[at:])
    yield from flush()


# --- occurrence vectors ----------------------------------------------------------


def _number(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode(), digest_size=8).digest(), "little")


def place_of(path: str) -> str:
    """What a text's token begins with: its container's path without numbers, as a hash."""
    return f"#{_number(unnumbered(path)):016x}"


def text_token(e: Element, text: str) -> str:
    if e.place is None:
        e.place = place_of(e.path)
    return f"{e.place}.{_number(text):x}"


def _print(texts: Iterable[str]) -> int:
    return _number(*texts) >> 1


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums for each host and token; a text's ``chars`` are its places, its least and most texts what its pages show but for digits."""

    def told() -> pa.RecordBatch:
        names = [c.split()[0] for c in SLOTS.split(", ")]
        cols = [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string())]
        return pa.RecordBatch.from_arrays([*cols, *(pa.array([s[i] for s in sums.values()], pa.int64()) for i in range(8))], names)

    for batch in batches:
        sums: dict[tuple[str, str], list[int]] = {}
        for page_id, url, page in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"], strict=True):
            own: dict[str, list] = {PAGE: [1, 0, 0, []]}
            lines: dict[str, list[int]] = {}
            shown: list[str] = []
            for place, (e, text, link) in enumerate(blocks(page.as_py() or "")):
                if text and (not e.hidden or e.again):
                    shown.append(DIGITS.sub("", text))
                    line = lines.setdefault(text_token(e, text), [0, 0])
                    line[0] += 1
                    line[1] += place
                slot = own.setdefault(e.path, [0, 0, 0, []])
                if text:
                    slot[1] += len(text)
                    slot[2] += link
                    slot[3].append(text)
                else:
                    slot[0] += 1
            host = host_of(url)
            whole = _print(shown)
            tokens = [(token, n, chars, link, _print(texts)) for token, (n, chars, link, texts) in own.items()]
            tokens += [(token, n, places, 0, whole) for token, (n, places) in lines.items()]
            prints: dict[int, int] = {}
            for token, n, chars, link, said in tokens:
                seen = prints.get(n)
                if seen is None:
                    seen = prints[n] = _number(page_id, url, n)
                s = sums.setdefault((host, token), [0, 0, 0, 0, 0, 0, said, said])
                for k, v in enumerate((1, n, seen >> 34, seen & 0x3FFFFFFF, chars, link)):
                    s[k] += v
                s[6], s[7] = min(s[6], said), max(s[7], said)
            if len(sums) > MOST_TOKENS:
                yield told()
                sums.clear()
        yield told()


def template_texts(own: list[str], of: dict[str, dict]) -> list[str]:
    """The texts of a class that its own markup makes template; none if its slots are empty."""
    texts = [t for t in own if t.startswith("#") and t != PAGE]
    if not texts or of[texts[0]]["pages"] < LEAST_PAGES or of[texts[0]]["total"] > of[texts[0]]["pages"]:
        return []
    if of[texts[0]]["least_text"] == of[texts[0]]["most_text"]:
        return []
    places = {place_of(t) for t in own if t.startswith(">")}
    return [t for t in texts if PAGE in own or t.partition(".")[0] in places]


def deduce(slots: list[dict]) -> tuple[list[str], list[str]]:
    """(paths of content elements, what is no content) of a host's template: paths, of fixed slots also path#text, then text tokens in order."""
    of = {s["token"]: s for s in slots}
    pages = of[PAGE]["pages"]
    if pages < 2:
        return [], []
    classes: dict[tuple, list[str]] = {}
    for token, s in of.items():
        classes.setdefault((s["pages"], s["total"], s["print1"], s["print2"]), []).append(token)
    often = [own for (seen, *_), own in classes.items() if seen >= SUPPORT * pages]
    lines = [t for own in often for t in template_texts(own, of)]
    lines.sort(key=lambda t: (of[t]["chars"] / of[t]["total"], t))
    nested = [[t for t in own if t.startswith(">")] for own in often]
    while True:  # a class that falls takes along those within its slots
        valid = {t for own in nested for t in own}
        kept = [own for own in nested if all(t.rpartition(">")[0] in valid or t.count(">") == 1 for t in own)]
        if len(kept) == len(nested):
            break
        nested = kept
    fixed = {t for t in valid if pages >= LEAST_PAGES and of[t]["chars"] and of[t]["least_text"] == of[t]["most_text"] and of[t]["pages"] == pages}

    def built(path: str) -> Element:
        e = Element()
        for part in path.split(">")[1:]:
            tag, _, words = part.partition("[")[0].partition(".")
            e = element(tag, f'class="{words.replace(".", " ")}"', e)
        return e

    def told(own: Iterable[str]) -> list[str]:
        return sorted(x for t in own for x in ([t, f"{t}#{of[t]['least_text']}"] if t in fixed else [t])) + lines

    shown = {t: e for t in valid if not (e := built(t)).hidden}
    mains = sorted((t for t, e in shown.items() if e.main), key=len)
    outer = [t for t in mains if not any(t.startswith(m + ">") for m in mains)]
    if outer:
        return outer, told(t for t in fixed if not built(t).main)
    mostly_links = {t for t in shown if 2 * of[t]["link_chars"] > of[t]["chars"]}
    plain = {t: of[t]["chars"] - of[t]["link_chars"] for t in shown if t not in fixed and t not in mostly_links}
    below: dict[str, int] = {}  # text of an element and of all in it
    for t, n in plain.items():
        while t:
            below[t] = below.get(t, 0) + n
            t = t.rpartition(">")[0]
    inner_of: dict[str, list[str]] = {}
    for t in shown:
        inner_of.setdefault(t.rpartition(">")[0], []).append(t)
    at = next((t for t in sorted(shown, key=len) if t.endswith(">body") or ">body." in t), "")
    # one element stands for the content only if its siblings and its parent's own text are no content
    while at and not plain.get(at) and len(inner := [t for t in inner_of.get(at, ()) if below.get(t)]) == 1:
        at = inner[0]
    return [at] if at else [], told(fixed | mostly_links)


def _deduce(table: pa.Table) -> pa.Table:
    slots = table.to_pylist()
    pages = next(s["pages"] for s in slots if s["token"] == PAGE)
    content, fixed = deduce(slots)
    return pa.table({"host": [table["host"][0].as_py()], "pages": pa.array([pages], pa.int64()), "content": pa.array([content], pa.list_(pa.string())), "fixed": pa.array([fixed], pa.list_(pa.string()))})


# --- extraction ---------------------------------------------------------------------


def in_order(places: list[int]) -> set[int]:
    """Indices of a longest ascending subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        before.append(at[k - 1] if k else -1)
        tails[k : k + 1], at[k : k + 1] = [p], [i]
    out, i = set(), at[-1] if at else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def without_template(found: list[tuple[Element, str, int]], lines: list[str]) -> list[tuple[Element, str, int]]:
    """The blocks but for the template's texts that come in the host's order."""
    place = {t: k for k, t in enumerate(lines)}
    known = [(i, place[t]) for i, (e, text, _) in enumerate(found) if (t := text_token(e, text)) in place]
    template = {known[k][0] for k in in_order([p for _, p in known])}
    return [x for i, x in enumerate(found) if i not in template]


def main_text(page: str, content: list[str], fixed: list[str]) -> str:
    found = [x for x in blocks(page) if x[1] and not x[0].hard]
    mains = [x for x in found if x[0].main and not x[0].soft]
    found = [x for x in found if not x[0].soft or (x[0].again and not mains)]
    if not content or any(map(is_main, content)):
        found = mains or found
    lines = [f for f in fixed if f.startswith("#")]
    if len(lines) < len(fixed):
        slots: dict[str, list] = {}
        for e, text, link in found:
            slots.setdefault(e.path, []).append((text, link))
        no_content, gone = {unnumbered(f) for f in fixed if f.startswith(">")}, set()
        for path, own in slots.items():
            name = unnumbered(path)
            links = 2 * sum(link for _, link in own) > sum(len(text) for text, _ in own)
            if (name in no_content and links) or f"{name}#{_print(text for text, _ in own)}" in no_content:
                gone.add(path)
        found = [x for x in found if x[0].path not in gone]
    if lines:
        found = without_template(found, lines)
    return "\n".join(text for _, text, _ in found)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content, fixed = batch["content"].to_pylist(), batch["fixed"].to_pylist()
        texts = [main_text(page.as_py() or "", c or [], f or []) for page, c, f in zip(batch["html"], content, fixed, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def occurrences(pages: DataFrame) -> DataFrame:
    """The tokens of at least half of a host's pages, with their occurrence vectors and what they hold."""
    sums = pages.mapInArrow(_occurrences, SLOTS).groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("pages", "total", "print1", "print2", "chars", "link_chars")), F.min("least_text").alias("least_text"), F.max("most_text").alias("most_text"))
    sums = sums.where(~F.col("token").startswith("#") | (F.col("token") == PAGE) | (F.col("pages") >= LEAST_PAGES))
    seen = sums.where(F.col("token") == PAGE).select("host", F.col("pages").alias("of"))
    # no more than twice the tokens of a page
    return sums.join(seen, "host").where((F.col("token") == PAGE) | (F.col("pages") >= SUPPORT * F.col("of"))).drop("of")


def templates(pages: DataFrame) -> DataFrame:
    """(host, pages, content, fixed): the template of each host, from all its pages."""
    return occurrences(pages).groupBy("host").applyInArrow(_deduce, TEMPLATE)


def extract(pages: DataFrame) -> DataFrame:
    """Returns page_id, url, text and n_chars (code points).

    Pages of hot hosts get their template by a broadcast of fewer than a thousand
    templates, so they are not shuffled; the other hosts' pages are joined by
    host, none of which holds more than a thousandth.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    url = F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    hosted = own.withColumn("host", F.lower(url))
    told = saved(templates(own))
    total = told.agg(F.sum("pages")).first()[0] or 0
    hot = F.broadcast(told.where(F.col("pages") * HOT_SHARE > total).drop("pages"))
    cold = told.where(F.col("pages") * HOT_SHARE <= total).drop("pages")
    rest = hosted.join(hot.select("host"), "host", "left_anti").join(cold, "host", "left")
    return hosted.join(hot, "host").unionByName(rest).mapInArrow(_extract, RESULT)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
