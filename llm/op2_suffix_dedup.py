"""Suffix dedup by winnowing and an exact exchange of hashes, in place of prefix doubling.

Positions get names of growing prefixes, ``FIRST`` bytes, then twice that, up to
``length`` bytes, within their shard: the name of 2w bytes at p is a hash of the
names at p and p + w, and the last step overlaps so that the prefix is exactly
``length``.  Names come from the content, so tasks agree on them without a sort
of the corpus; buckets compare them by range, and positions that prove unique
leave before the next round.  Three rounds meet the corpus:

1. the ``FIRST``-byte ranks at *sampled* positions: of each ``length``-byte
   string the place of its smallest rank (equal strings sample the same place,
   so no repeat is missed, and about one position in 35 is sorted);
2. around surviving samples, the whole stretch of strings that share a sample;
   if the stretch as such occurs earlier, all its strings do;
3. only where stretches with the same sample differ, the full ``length``-byte
   ranks of every position, one by one, of the first copy of each stretch.

Names have 48 bits in round 1, which only selects, and 80 bits later.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` lose nothing; a null doc_id comes after all others, null ids in the
order of a hash of their texts, whatever shards they are in; rows that share a
doc_id, or without one a text, count as one document, in the order of their
texts; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import exchange as X
from llm.rolling import BYTE_VALUES, BYTE_VALUES_2, Texts, each_width, give_back, mix, pack, prefix_sums, ranges, span_hash

LENGTH = 100
FIRST = 32
SAMPLE_BITS = 48
POSITION_BITS = 31
SHARD_BYTES = 1 << 19
LIVE, STRETCH_EARLIER, STRETCH_MIXED, EARLIER = 1, 2, 3, 4
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones (block-wise running minima from both ends)."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    head = np.minimum.accumulate(rows, axis=1).reshape(-1)
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def in_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows in the order that holds across shards, and what orders null doc_ids among themselves (0: has a doc_id)."""
    ties = np.zeros(table.num_rows, np.uint64)
    for i in np.flatnonzero(table["doc_id"].is_null().to_numpy()):
        text = (table["text"][int(i)].as_py() or "").encode()
        ties[i] = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little") | 1
    table = table.append_column("tie", pa.array(ties)).sort_by([("doc_id", "ascending"), ("tie", "ascending"), ("text", "ascending")])
    return table.drop_columns("tie"), table["tie"].to_numpy()


class Shard:
    """Ranks, samples and stretches of one shard."""

    def __init__(self, table: pa.Table, length: int):
        give_back()
        self.table, self.ties = in_order(table)
        self.length, first = length, min(FIRST, length)
        self.texts = Texts(self.table["text"])
        self.ids = X.ids(self.table)
        buf, off = self.texts.buf, self.texts.off
        if len(buf) >= 1 << POSITION_BITS:
            raise ValueError("a shard holds over 2 GB of text")
        self.sums = prefix_sums(BYTE_VALUES[buf])
        self.first_rank = each_width(self.sums, first)
        shift = np.uint64(POSITION_BITS)
        places = self.first_rank >> shift
        places <<= shift
        places |= np.arange(len(places), dtype=np.uint64)
        least = sliding_least(places, length - first + 1)
        del places
        size = np.diff(off)
        long = size >= length
        x = ranges(off[:-1][long], size[long] - length + 1)  # starts of all strings
        sample = (least[x] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        del least
        new = np.append(True, (sample[1:] != sample[:-1]) | (x[1:] != x[:-1] + 1)) if len(x) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(x)) - 1
        self.from_, self.to = x[begin], x[last]  # stretches: starts of their first and last string
        self.name = self.first_rank[sample[begin]] >> np.uint64(64 - SAMPLE_BITS)

    def rank(self, x: np.ndarray, width: int) -> np.ndarray:
        """Rank of ``width`` bytes (FIRST, or twice a width that has ranks) at places x."""
        if width <= FIRST:
            return self.first_rank[x]
        half = width // 2
        return mix(self.rank(x, half) * np.uint64(0x9FB21C651E98DF25) + self.rank(x + half, half))

    def full_rank(self, x: np.ndarray) -> np.ndarray:
        """Rank of ``length`` bytes at places x, from a pair of the longest ranks that fit."""
        width = min(FIRST, self.length)
        while 2 * width <= self.length:
            width *= 2
        if width == self.length:
            return self.rank(x, width)
        return mix(self.rank(x, width) * np.uint64(0xA0761D6478BD642F) + self.rank(x + self.length - width, width))

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """16 more bits of the spans' names, from other byte values."""
        if not hasattr(self, "sums2"):
            self.sums2 = prefix_sums(BYTE_VALUES_2[self.texts.buf])
        return (span_hash(self.sums2, start, end) >> np.uint64(48)).astype(np.uint16)

    def doc(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and ties of places x; ties of one byte if all have a doc_id."""
        row = np.searchsorted(self.texts.off, x, side="right") - 1
        tie = self.ties[row]
        return self.ids[row], tie if tie.any() else tie.astype(np.uint8)

    def stretches(self, told: pa.Table) -> Grouped:
        (live,) = X.joined(X.answers(told, LIVE), np.uint64)
        keep = X.contains(live, self.name)
        self.from_, self.to, name = self.from_[keep], self.to[keep], self.name[keep]
        end = self.to + self.length
        return Grouped(self, self.from_, name, span_hash(self.sums, self.from_, end), self.second(self.from_, end))

    def strings(self, told: pa.Table, s: Grouped) -> tuple[np.ndarray, Grouped]:
        """Which stretches occur earlier; the strings of the others where stretches with one sample differ."""
        earlier = X.flags(told, STRETCH_EARLIER, s.n)
        mixed = X.flags(told, STRETCH_MIXED, s.n)
        gone = earlier[s.member] | ~s.is_first
        own = mixed[s.member] & ~gone
        x = ranges(self.from_[own], (self.to - self.from_ + 1)[own])
        return gone, Grouped(self, x, self.full_rank(x), self.second(x, x + self.length))


class Grouped:
    """Distinct names (ascending tuples ``keys``) at places x, the least doc_id of each, and who is first."""

    def __init__(self, shard: Shard, x: np.ndarray, *keys: np.ndarray):
        self.x = x
        order = np.lexsort((x, *keys[::-1]))
        keys = [k[order] for k in keys]
        new = np.zeros(len(x), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        self.n = int(new.sum())
        self.member = np.empty(len(x), np.int64)
        self.member[order] = np.cumsum(new) - 1
        self.is_first = np.zeros(len(x), bool)
        self.is_first[order] = new
        self.keys = [k[new] for k in keys]
        self.least = shard.doc(x[order][new])  # rows are in the order of doc_id and tie


def _ask_samples(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        shard = Shard(table, length)
        name, count = np.unique(shard.name, return_counts=True)
        return X.requests(X.one_shard(table), buckets, SAMPLE_BITS, name, (count > 1).astype(np.uint8))

    return run


def _answer_samples(table: pa.Table) -> pa.Table:
    """Sampled ranks that occur twice survive."""
    bucket = table["bucket"][0].as_py()
    shards, sizes, (name, many) = X.gathered(table)
    _, member, count = np.unique(name, return_inverse=True, return_counts=True)
    live = (count[member] > 1) | np.bincount(member, many)[member].astype(bool)
    ends = np.cumsum(sizes)
    return X.replies([(s, bucket, LIVE, pack(name[a:b][live[a:b]])) for s, a, b in zip(shards, ends - sizes, ends, strict=True) if live[a:b].any()])


def _ask_stretches(length: int, buckets: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        s = Shard(table, length).stretches(told)
        return X.requests(X.one_shard(table), buckets, SAMPLE_BITS, *s.keys, *s.least)

    return run


def _answer_stretches(table: pa.Table) -> pa.Table:
    """Of each stretch: does it occur in an earlier document elsewhere, and do others share its sample?"""
    bucket = table["bucket"][0].as_py()
    shards, sizes, (name, a, b, least, tie) = X.gathered(table)
    order = np.lexsort((*X.tied(tie), least, b, a, name))
    name, a, b = name[order], a[order], b[order]
    new_name = np.append(True, name[1:] != name[:-1])
    new = new_name | np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    count = np.diff(np.append(np.flatnonzero(new), len(a)))
    classes = np.cumsum(new_name) - 1
    earlier, mixed = np.zeros(len(a), bool), np.zeros(len(a), bool)
    earlier[order] = X.after_first(new, count, least[order], tie[order])
    mixed[order] = np.bincount(classes, new)[classes] > 1
    ends = np.cumsum(sizes)
    return X.replies([(s, bucket, kind, X.pack_flags(f[i:j])) for s, i, j in zip(shards, ends - sizes, ends, strict=True) for kind, f in ((STRETCH_EARLIER, earlier), (STRETCH_MIXED, mixed))])


def _ask_strings(length: int, buckets: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        shard = Shard(table, length)
        _, w = shard.strings(told, shard.stretches(told))
        return X.requests(X.one_shard(table), buckets, 64, *w.keys, *w.least)

    return run


def _cut(length: int, keep_bytes: bool):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        shard = Shard(table, length)
        s = shard.stretches(told)
        whole, w = shard.strings(told, s)
        single = X.flags(told, EARLIER, w.n)[w.member] | ~w.is_first
        n, off = len(shard.texts.buf), shard.texts.off
        depth = np.zeros(n + 1, np.int64)
        for start, end in ((shard.from_[whole], shard.to[whole] + length), (w.x[single], w.x[single] + length)):
            depth += np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
        gone = np.cumsum(depth)[:n] > 0
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        edges = off[:-1][off[:-1] < n]
        rise[edges] = gone[edges]
        total = lambda f: np.diff(np.append(0, np.cumsum(f))[off])
        removed, sha, kept = total(gone), [], []
        for i in range(table.num_rows):
            a, b = off[i], off[i + 1]
            own = shard.texts.buf[a:b]
            own = (own[~gone[a:b]] if removed[i] else own).tobytes()
            sha.append(hashlib.sha256(own).hexdigest())
            kept.append(own if keep_bytes else None)
        return pa.table({"doc_id": shard.table["doc_id"], "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(total(rise), pa.int64()), "kept_sha256": sha, "kept_bytes": pa.array(kept, pa.binary())})

    return run


def _answers(shards: GroupedData, buckets: int, length: int) -> DataFrame:
    """The three rounds: all replies to the shards."""

    def ask(told: DataFrame, question) -> GroupedData:
        return shards.cogroup(told.groupBy("shard")).applyInArrow(question(length, buckets), X.REQUEST).groupBy("bucket")

    live = shards.applyInArrow(_ask_samples(length, buckets), X.REQUEST).groupBy("bucket").applyInArrow(_answer_samples, X.REPLY)
    stretches = ask(live, _ask_stretches).applyInArrow(_answer_stretches, X.REPLY)
    strings = ask(X.union([live, stretches]), _ask_strings).applyInArrow(X.answer_earlier(EARLIER), X.REPLY)
    return X.union([live, stretches, strings])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, keep_bytes: bool = True) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Earlier: in a document of smaller doc_id, or before in the same document.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``keep_bytes``, kept_bytes.
    """
    dealt = X.deal(docs, SHARD_BYTES)
    shards = dealt.frame.groupBy("shard")
    told = _answers(shards, dealt.buckets, length)
    return shards.cogroup(told.groupBy("shard")).applyInArrow(_cut(length, keep_bytes), RESULT)


def _texts_left(length: int):
    """The carried rows with what is left of their text; characters that a cut divides go too."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        cut = _cut(length, True)(table, told)
        text = [x.decode(errors="ignore") for x in cut["kept_bytes"].to_pylist()]
        table, _ = in_order(table)
        left = [None if was is None else now for was, now in zip(table["text"].to_pylist(), text, strict=True)]
        return pa.table({"row": table["row"], "kept": pa.array(left, pa.string())})

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of documents, without the repeated bytes of ``text``; n_chars, if there, follows it."""
    dealt = X.deal(docs, SHARD_BYTES, carry=True)
    shards = dealt.frame.groupBy("shard")
    kinds = T.StructType([T.StructField("row", docs.schema), T.StructField("kept", T.StringType())])
    out = shards.cogroup(_answers(shards, dealt.buckets, length).groupBy("shard")).applyInArrow(_texts_left(length), kinds)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return out.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_bytes=False).drop("kept_bytes")
