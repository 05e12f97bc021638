"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping blocks of ``block_words(window)``
words; the blocks form the index.  Every rolling window of that size probes it:
any repeat of ``window`` words holds at least one whole block of its earlier
copy.  A block met in two documents is *live*.  Around live hits each match is
extended to all full windows that hold it; their names, exchanged once more,
tell which start in an earlier document, and overlapping windows merge into
maximal repeats.

Names are 48 bits for the probes (a false hit only costs a check) and 80 bits
for the windows.

Defined results: a null or empty text has no words; a null doc_id comes after
all others and null ids are not earlier than each other; rows that share a
doc_id are one document to the comparison, so neither removes from the other;
other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import exchange as X
from llm.rolling import SPACE_WORDS, Texts, Words, covered, give_back, mix, pack

WINDOW = 13
PROBE_BITS = 48
LIVE, EARLIER = 1, 2
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def block_words(window: int) -> int:
    """Largest block that every run of ``window`` words must hold whole, wherever blocks begin."""
    return (window + 1) // 2


def _probes(words: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, 48-bit name, whether it is an index block) of each rolling window."""
    at, h = words.windows(words.hashes(), block)
    return at, h >> np.uint64(64 - PROBE_BITS), (at - words.first[words.doc[at]]) % block == 0


def _ask_blocks(block: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        give_back()
        words = Texts(table["text"]).words(SPACE_WORDS)
        at, name, aligned = _probes(words, block)
        doc = X.ids(table)[words.doc[at]]
        order = np.argsort(name, kind="stable")
        name, aligned, doc = name[order], aligned[order], doc[order]
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, int)
        if len(name):
            block_here = np.bitwise_or.reduceat(aligned.astype(np.uint8), first)
            many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        else:
            block_here = many = np.zeros(0, np.uint8)
        return X.requests(X.one_shard(table), buckets, PROBE_BITS, name[first], block_here | (many.astype(np.uint8) << 1))

    return run


def _answer_blocks(table: pa.Table) -> pa.Table:
    """A name is live if it is a block somewhere and occurs in two documents; it goes to all that asked."""
    bucket = table["bucket"][0].as_py()
    shards, sizes, (name, flags) = X.gathered(table)
    order = np.argsort(name, kind="stable")
    sorted_name = name[order]
    first = np.flatnonzero(np.append(True, sorted_name[1:] != sorted_name[:-1]))
    count = np.diff(np.append(first, len(name)))
    any_flag = np.bitwise_or.reduceat(flags[order], first)
    live = np.zeros(len(name), bool)
    live[order] = np.repeat((any_flag & 1 > 0) & ((count > 1) | (any_flag & 2 > 0)), count)
    ends = np.cumsum(sizes)
    rows = [(s, bucket, LIVE, pack(name[a:b][live[a:b]])) for s, a, b in zip(shards, ends - sizes, ends, strict=True) if live[a:b].any()]
    return X.replies(rows)


def _candidates(table: pa.Table, told: pa.Table, words: Words, window: int):
    """Windows that hold a live block: first words, their names, and the distinct names with least doc_id."""
    block = block_words(window)
    values = words.hashes()
    at, name, _ = _probes(words, block)
    (live,) = X.joined(X.answers(told, LIVE), np.uint64)
    hit = np.zeros(words.n + 1, np.int64)
    hit[at[X.contains(live, name)]] = 1
    before = np.append(0, np.cumsum(hit))
    start, h = words.windows(values, window)
    keep = before[start + window - block + 1] > before[start]
    start, h = start[keep], h[keep]
    second, _ = words.windows(mix(values ^ np.uint64(0x5851F42D4C957F2D)), window)[::-1]
    h2 = (second[keep] >> np.uint64(48)).astype(np.uint16)
    doc = X.ids(table)[words.doc[start]]
    order = np.lexsort((doc, h2, h))
    s1, s2, d = h[order], h2[order], doc[order]
    new = np.append(True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) if len(s1) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    least = d[new]
    member = np.empty(len(order), np.int64)
    member[order] = group
    return start, member, doc, s1[new], s2[new], least


def _ask_windows(window: int, buckets: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        give_back()
        words = Texts(table["text"]).words(SPACE_WORDS)
        _, _, _, h, h2, least = _candidates(table, told, words, window)
        return X.requests(X.one_shard(table), buckets, 64, h, h2, least)

    return run


def _cover(window: int, keep_text: bool):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        give_back()
        words = Texts(table["text"]).words(SPACE_WORDS)
        start, member, doc, h, _, least = _candidates(table, told, words, window)
        elsewhere = X.flags(told, EARLIER, len(h))
        gone = covered(start[elsewhere[member] | (doc > least[member])], window, words.n)
        lost = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (words.count > 0)
        sha, kept = [], []
        for i in range(table.num_rows):
            own = words.texts.bytes_of(i).split()
            if lost[i]:
                own = compress(own, ~gone[words.first[i] : words.first[i + 1]])
            text = b" ".join(own)
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode() if keep_text else None)
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(words.count, pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept_sha256": sha, "kept_text": pa.array(kept, pa.string())})

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """Remove every word covered by a ``window``-word run that also starts in a document of smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256 and, with ``keep_text``,
    kept_text (the kept words joined by one space).
    """
    dealt = X.deal(docs)
    shards, block = dealt.frame.groupBy("shard"), block_words(window)
    live = shards.applyInArrow(_ask_blocks(block, dealt.buckets), X.REQUEST).groupBy("bucket").applyInArrow(_answer_blocks, X.REPLY)
    asked = shards.cogroup(live.groupBy("shard")).applyInArrow(_ask_windows(window, dealt.buckets), X.REQUEST)
    earlier = asked.groupBy("bucket").applyInArrow(X.answer_earlier(EARLIER), X.REPLY)
    told = X.union([live, earlier])
    return shards.cogroup(told.groupBy("shard")).applyInArrow(_cover(window, keep_text), RESULT)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False).drop("kept_text")
