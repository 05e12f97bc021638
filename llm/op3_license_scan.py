"""License scans.

One Aho-Corasick automaton over the normalised words of each whole text finds
notice phrases and the words of identifier tags.  Where a tag is found, its
licence expression is read from the original text and parsed by a shunting-yard
parser with the operators with, and, or; it evaluates to the labels of all
licences named and to the rights of the expression: of alternatives (or) the
best, of joint terms (and) the worst, and an exception (with) grants half of
what its licence withholds.

The score of a text is the rights of its most restrictive notice or expression,
from 0 (all reserved) to 1 (permissive), and 0 if it has none.

Defined results: null and empty texts have no words and no labels; an expression
that cannot be parsed adds the label ``unparsed`` with rights 0; phrases are
counted at every place, overlapping ones too; a null doc_id stays null; repeated
rows are scanned each; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.op8_decontamination import words_of

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "the unlicense": "unlicense",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
#: rights by the longest of these beginnings of a label
RIGHTS = {"mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache": 1.0, "cc0": 1.0, "0bsd": 1.0, "zlib": 1.0, "public-domain": 1.0, "unlicense": 1.0, "cc-by": 0.9, "cc-by-sa": 0.6, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.3, "cc-by-nc": 0.2, "reserved": 0.0, "unparsed": 0.0}
UNKNOWN_RIGHTS = 0.5
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def rights(label: str) -> float:
    known = [k for k in RIGHTS if label == k or label.startswith((k + "-", k + "+"))]
    return RIGHTS[max(known, key=len)] if known else UNKNOWN_RIGHTS


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the tokens of an expression in postfix order; ValueError if it isn't one."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # whether one must come next
    for token in TOKEN.findall(expression):
        word = token.lower()
        if word in BINDS:
            if operand:
                raise ValueError(f"{token} without a left side")
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = True
        elif token == "(":
            if not operand:
                raise ValueError("( after a licence")
            stack.append(token)
        elif token == ")":
            if operand or "(" not in stack:
                raise ValueError("unbalanced )")
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if not operand:
                break  # plain words after the expression
            out.append(word)
            operand = False
    if operand or "(" in stack:
        raise ValueError("unfinished expression")
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels named in a licence expression, and its rights."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix(expression):
        if token not in BINDS:
            stack.append(({token}, rights(token)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, a + (1 - a) / 2))
        else:
            stack.append((left | right, max(a, b) if token == "or" else min(a, b)))
    return stack[0]


def build() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        a.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    a.make_automaton()
    return a


def scan(a: ahocorasick.Automaton, text: str | None) -> tuple:
    """The result's columns after doc_id."""
    words = words_of(text)
    line = (b" " + b" ".join(words) + b" ").decode()
    base, labels, found, starts = set(), set(), [], []
    tagged, so_far, last = False, 0, 0
    for at, (phrase, n) in a.iter(line) if words else ():  # in the order of their ends
        so_far, last = so_far + line.count(" ", last, at), at
        tagged = tagged or phrase == TAG
        if phrase in BASE:
            base.add(BASE[phrase])
            starts.append(so_far - n)
        if phrase != TAG:
            label = NOTICES.get(phrase) or BASE[phrase]
            labels.add(label)
            found.append(rights(label))
    for expression in TAG_LINE.findall(text) if tagged else ():
        try:
            own, value = evaluate(expression)
        except ValueError:
            own, value = {"unparsed"}, 0.0
        labels |= own
        found.append(value)
    join = lambda x: ",".join(sorted(x))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), join(base), join(labels | base), min(found, default=0.0)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = build()
    for batch in batches:
        rows = [scan(a, x.as_py()) for x in batch["text"]]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        names = [c.split()[0] for c in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names)


def license_scan(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, RESULT)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
