"""Phrase collocations from weighted acyclic automata of n-grams.

Each portion of documents sorts its n-grams and builds from them, language by
language, acyclic automata whose arcs are words and whose final states weigh the
count (``CountAutomaton``).  An automaton of n-grams is cut into *prefix ranges*,
by a hash of the first two words; a range unites the automata of all portions,
summing weights, a bounded number at a time.  What a range keeps are the phrases
with ``least`` occurrences, since any part of such a phrase is as frequent.  The
parts of the candidates are looked up by composition: an automaton of distinct
parts is walked together with that of the counts of its range, level by level.

Two words that make up much of all text would overload their range.  Pairs and
triples above a share of a bounded sample are therefore *heavy*: their n-grams
are dealt by one word more, and their own counts are summed over the ranges.  The
sample changes how evenly the work lies, not the counts.

Defined results: a null or empty text has no words; a null lang is ``und``;
repeated rows and rows that share a doc_id count each; phrases are ordered by
score, occurrences, then bytes, so there are no ties; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.rolling import give_back, mix
from llm.storage import saved

DEPTH = 4  # words of the longest phrase
LEAST = 30
TOP = 2000
SCALE = 2_000_000
COVERED = 80  # percent of a phrase's occurrences inside a longer one
PORTION_BYTES = 12 << 20
RANGE_BYTES = 4 << 20  # of text, for each prefix range
LEAST_RANGE_BYTES = 1 << 20  # smaller ranges where the cluster has the partitions for them
UNION_PATHS = 1 << 20  # paths that are united at a time
COMPOSED = 200_000  # phrases of a range in look-ups
SAMPLE_BYTES = 32 << 20
SAMPLE_TASKS = 4
MOST_HEAVY = 2000  # pairs, and triples: a share of at least 1 / MOST_HEAVY of the sample

BREAK = b"\xff"  # in no UTF-8 text
SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")
STEP = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary(dict):
    """Numbers words as they come; the break is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, lower-cased (A-Z), with a break between pieces and at the end."""
    out = text.lower().translate(SEPARATORS).replace(BREAK, b" " + BREAK + b" ").split()
    out.append(BREAK)
    return out


def digests(words: list[bytes]) -> np.ndarray:
    """A number for each label: 0 for the end, then one for each word."""
    return np.frombuffer(bytes(8) + b"".join(blake2b(w, digest_size=8).digest() for w in words), np.uint64)


class CountAutomaton:
    """Sorted paths of DEPTH labels with weights, as an acyclic automaton.

    Label 0 ends a phrase, label i is ``words[i - 1]``; words are in byte order, so
    paths are in the order of their phrases.  Kept are, for each depth, the label
    of each state's arc and the number of states below it.
    """

    def __init__(self, words: list[bytes], paths: np.ndarray, weights: np.ndarray):
        """``paths``: distinct rows in ascending order."""
        self.words, self.weights = words, weights
        self.labels: list[np.ndarray] = []
        self.below: list[np.ndarray] = []  # of each state of depths 1 to DEPTH - 1: how many states of the next depth follow it
        new = np.zeros(len(paths), bool)
        new[:1] = True
        starts: list[np.ndarray] = []
        for d in range(DEPTH):
            new[1:] |= paths[1:, d] != paths[:-1, d]
            starts.append(np.flatnonzero(new))
            self.labels.append(paths[starts[-1], d].astype(np.int32))
        for above, own in zip(starts, starts[1:], strict=False):
            self.below.append(np.diff(np.append(np.searchsorted(own, above), len(own))).astype(np.int32))

    @classmethod
    def of(cls, words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> CountAutomaton:
        """From paths in any order, some of them repeated: their weights are summed."""
        high = paths[:, 0].astype(np.uint64) << np.uint64(32) | paths[:, 1].astype(np.uint64)
        low = paths[:, 2].astype(np.uint64) << np.uint64(32) | paths[:, 3].astype(np.uint64)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        at = np.flatnonzero(new)
        return cls(words, paths[order[at]], np.add.reduceat(weights[order], at) if len(at) else weights)

    def paths(self) -> np.ndarray:
        out = np.zeros((len(self.weights), DEPTH), np.int32)
        column = np.zeros((len(self.labels[0]), 0), np.int32)
        for d in range(DEPTH):
            column = np.column_stack([column, self.labels[d]])
            if d < DEPTH - 1:
                column = np.repeat(column, self.below[d], 0)
        out[:] = column
        return out

    def to_bytes(self) -> bytes:
        parts = [b" ".join(self.words), *self.labels, *self.below, self.weights.astype(np.int64)]
        parts = [p if isinstance(p, bytes) else np.ascontiguousarray(p.view(np.uint8).reshape(len(p), -1).T).tobytes() if len(p) else b"" for p in parts]
        head = np.array([len(p) for p in parts], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))

    @classmethod
    def from_bytes(cls, blob: bytes) -> CountAutomaton:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        sizes = np.frombuffer(raw, np.int64, 2 * DEPTH + 1)
        ends = np.cumsum(sizes) + sizes.nbytes
        planes = [np.frombuffer(raw, np.uint8, n, e - n) for n, e in zip(sizes, ends, strict=True)]
        arrays = [np.ascontiguousarray(p.reshape(w, -1).T).view(k).ravel() for p, w, k in zip(planes[1:], [4] * (2 * DEPTH - 1) + [8], [np.int32] * (2 * DEPTH - 1) + [np.int64], strict=True)]
        own = cls.__new__(cls)
        text = planes[0].tobytes()
        own.words = text.split(b" ") if text else []
        own.labels, own.below, own.weights = arrays[:DEPTH], arrays[DEPTH:-1], arrays[-1]
        return own

    @classmethod
    def union(cls, automata: list[CountAutomaton]) -> CountAutomaton:
        """All paths of all automata; a path's weights are summed."""
        words = sorted(set().union(*(a.words for a in automata)))
        number = {w: k for k, w in enumerate(words, 1)}
        moved = [np.array([0, *map(number.__getitem__, a.words)], np.int32)[a.paths()] for a in automata]
        return cls.of(words, np.concatenate(moved), np.concatenate([a.weights for a in automata]))

    def composed(self, other: CountAutomaton) -> np.ndarray:
        """The weight here of each path of the other automaton; 0 where there is none."""
        number = {w: k for k, w in enumerate(self.words, 1)}
        label = np.array([0, *(number.get(w, -1) for w in other.words)], np.int64)
        width = len(self.words) + 1
        above_here, above_there = np.zeros(len(self.labels[0]), np.int64), np.zeros(len(other.labels[0]), np.int64)
        for d in range(DEPTH):
            key = above_here * width + self.labels[d]
            own = label[other.labels[d]]
            wanted = np.where((above_there < 0) | (own < 0), -1, above_there * width + own)
            at = np.searchsorted(key, wanted)
            state = np.where((wanted >= 0) & (np.append(key, -2)[at] == wanted), at, -1)
            if d < DEPTH - 1:
                above_here = np.repeat(np.arange(len(key)), self.below[d])
                above_there = np.repeat(state, other.below[d])
        return np.where(state >= 0, np.append(self.weights, 0)[state], 0)


def n_grams(numbers: np.ndarray, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in byte order, and the distinct paths of a portion's n-grams with their counts; 0 in ``numbers`` is a break.

    A path of one word counts the word; the others count the DEPTH words from each place, or those up to the end of its piece.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.zeros(len(words) + 1, np.int32)
    rank[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
    t = np.append(rank[numbers], np.zeros(DEPTH, np.int32))
    at = np.flatnonzero((t[:-1] > 0) & (t[1:] > 0))
    paths = np.zeros((len(at), DEPTH), np.int32)
    for d in range(DEPTH):
        paths[:, d] = t[at + d] if d < 2 else np.where(paths[:, d - 1] > 0, t[at + d], 0)
    alone = np.zeros((len(words), DEPTH), np.int32)
    alone[:, 0] = np.arange(1, len(words) + 1)
    counts = np.concatenate([np.bincount(t, minlength=len(words) + 1)[1:], np.ones(len(at), np.int64)])
    return [words[k] for k in order], np.concatenate([alone, paths]), counts


def keys_of(paths: np.ndarray, numbers: np.ndarray, heavy: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The key of each path's prefix range, and how many of its words the key has (2, or more after heavy prefixes)."""
    key = mix(numbers[paths[:, 0]] * STEP + numbers[paths[:, 1]])
    depth = np.full(len(paths), 2)
    for d, own in enumerate(heavy, 2):
        more = (depth == d) & np.isin(key, own) & (paths[:, 1] > 0)
        key[more] = mix(key[more] * STEP + numbers[paths[more, d]])
        depth[more] += 1
    return key, depth


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, numbers of the words in the texts) of each language of each portion."""
    own: dict[str, tuple[Vocabulary, list[np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.large_binary()), strict=True):
            text = text.as_py() or b""
            vocabulary, numbers = own.setdefault(lang, (Vocabulary(), []))
            said = tokens(text)
            numbers.append(np.fromiter(map(vocabulary.__getitem__, said), np.int32, len(said)))
            size += len(text)
            if size >= PORTION_BYTES:
                yield from ((g, list(v)[1:], np.concatenate(n)) for g, (v, n) in own.items())
                own, size = {}, 0
                give_back()
    yield from ((g, list(v)[1:], np.concatenate(n)) for g, (v, n) in own.items())


def _weigh(share: float):
    """Of each portion: keys of the pairs (order 2) and triples (3) that make up half of ``share`` of its words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, numbers in _portions(batches):
            words, paths, counts = n_grams(numbers, words)
            number = digests(words)
            paths, counts = paths[len(words) :], counts[len(words) :]
            rows = [(0, 0, len(numbers))]
            key = mix(number[paths[:, 0]] * STEP + number[paths[:, 1]])
            for order in (2, 3):
                if order == 3:
                    key = mix(key[paths[:, 2] > 0] * STEP + number[paths[paths[:, 2] > 0, 2]])
                values, n = np.unique(key, return_counts=True)
                often = n >= max(2, share / 2 * len(numbers))
                rows += [(order, int(v), int(c)) for v, c in zip(values[often].view(np.int64), n[often], strict=True)]
                key = mix(number[paths[:, 0]] * STEP + number[paths[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["order", "key", "n"])

    return run


def heavy_prefixes(texts: DataFrame, total: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of heavy pairs and triples in a sample of about SAMPLE_BYTES; at most MOST_HEAVY of each (and some ten thousand counts reach the driver)."""
    share = max(1 / (4 * ranges), 1 / MOST_HEAVY)
    sample = texts.sample(fraction=min(1.0, SAMPLE_BYTES / max(1, total)), seed=1).repartition(SAMPLE_TASKS)
    told = sample.mapInArrow(_weigh(share), "order int, key long, n long").groupBy("order", "key").agg(F.sum("n").alias("n")).collect()
    words = sum(r["n"] for r in told if r["order"] == 0)
    often = [r for r in told if r["order"] > 0 and r["n"] >= share * words]
    return tuple(np.sort(np.array([r["key"] for r in often if r["order"] == k], np.int64).view(np.uint64)) for k in (2, 3))


def _cut(ranges: int, heavy: tuple[np.ndarray, ...]):
    """Of each portion and language: an automaton for each prefix range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _portions(batches):
            words, paths, counts = n_grams(numbers, words)
            whole = CountAutomaton.of(words, paths, counts)
            paths, counts = whole.paths(), whole.weights
            key, _ = keys_of(paths, digests(words), heavy)
            place = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            order = np.argsort(place, kind="stable")
            place, paths, counts = place[order], paths[order], counts[order]
            cut = np.append(np.flatnonzero(np.diff(place, prepend=np.uint64(2**63))), len(place))
            used = np.zeros(len(words) + 1, np.int32)
            blobs = []
            for i, j in zip(cut, cut[1:], strict=False):
                seen = np.unique(paths[i:j])
                seen = seen[seen > 0]
                used[seen] = np.arange(1, len(seen) + 1)
                blobs.append(CountAutomaton([words[k - 1] for k in seen], used[paths[i:j]], counts[i:j]).to_bytes())
            del whole, paths, counts, key, order
            for k in range(0, len(blobs), 512):
                own = blobs[k : k + 512]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array(place[cut[k : k + len(own)]].astype(np.int32)), pa.array(own, pa.binary())], ["lang", "place", "payload"])

    return run


COUNTED = "lang string, phrase string, n int, f long, part boolean"


def _frequent(least: int, heavy: tuple[np.ndarray, ...]):
    """Of one prefix range: its frequent phrases, the part counts of heavy ones, and (n = 0) the number of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        united: list[CountAutomaton] = []
        size, lang = 0, None
        for batch in batches:
            for payload in batch["payload"]:
                united.append(CountAutomaton.from_bytes(payload.as_py()))
                size += len(united[-1].weights)
                if size >= UNION_PATHS and size >= 2 * len(united[0].weights):
                    united = [CountAutomaton.union(united)]
                    size = len(united[0].weights)
            lang = batch["lang"][0].as_py() if batch.num_rows else lang
        all_ = CountAutomaton.union(united)
        del united
        paths, weights = all_.paths(), all_.weights
        _, depth = keys_of(paths, digests(all_.words) if any(map(len, heavy)) else np.zeros(len(all_.words) + 1, np.uint64), heavy)
        alone = paths[:, 1] == 0
        out = [("", 0, int(weights[alone].sum()), False)]
        new = np.zeros(len(paths), bool)
        new[:1] = True
        for d in range(1, DEPTH + 1):
            new[1:] |= paths[1:, d - 1] != paths[:-1, d - 1]
            at = np.flatnonzero(new)
            f = np.add.reduceat(np.where(alone == (d == 1), weights, 0), at) if len(at) else weights
            part = (depth[at] > d) & (d > 1)
            own = np.flatnonzero((paths[at, d - 1] > 0) & (f > 0) & (part | (f >= least)))
            out += [(b" ".join(all_.words[k - 1] for k in paths[at[i], :d]), d, int(f[i]), bool(part[i])) for i in own]
        phrases, n, f, part = zip(*out, strict=True)
        phrases = pa.array([p or None for p in phrases], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out)), phrases, pa.array(n, pa.int32()), pa.array(f, pa.int64()), pa.array(part)], ["lang", "phrase", "n", "f", "part"])
        give_back()

    return run


def _automaton(column: pa.ChunkedArray, weights: np.ndarray) -> CountAutomaton:
    """Of distinct phrases in ascending order."""
    phrases = [p.split(b" ") for p in column.cast(pa.large_binary()).to_pylist()]
    words = sorted({w for p in phrases for w in p})
    number = {w: k for k, w in enumerate(words, 1)}
    paths = np.zeros((len(phrases), DEPTH), np.int32)
    for i, p in enumerate(phrases):
        paths[i, : len(p)] = [number[w] for w in p]
    order = np.lexsort(paths.T[::-1])
    return CountAutomaton(words, paths[order], weights[order])


def _compose(counted: pa.Table, asked: pa.Table) -> pa.Table:
    """The counts of the parts that are asked for, from the phrases of the same range."""
    if not (counted.num_rows and asked.num_rows):
        return pa.table({"lang": pa.array([], pa.string()), "part": pa.array([], pa.string()), "f": pa.array([], pa.int64())})
    parts = _automaton(asked["part"], np.arange(asked.num_rows))
    f = _automaton(counted["phrase"], counted["f"].to_numpy()).composed(parts)
    give_back()
    return pa.table({"lang": asked["lang"].take(parts.weights), "part": asked["part"].take(parts.weights), "f": pa.array(f, pa.int64())})


def counted_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, f) of all phrases of 1 to 4 words with ``least`` occurrences, and (lang, n) with all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, math.ceil(total / RANGE_BYTES), min(parts, math.ceil(total / LEAST_RANGE_BYTES)))
    heavy = heavy_prefixes(texts, total, ranges)
    automata = texts.mapInArrow(_cut(ranges, heavy), "lang string, place int, payload binary")
    counted = saved(automata.groupBy("lang", "place").applyInArrow(_frequent(least, heavy), COUNTED))
    whole = counted.where("n > 0 AND NOT part").select("lang", "phrase", "n", "f")
    summed = counted.where("n > 0 AND part").groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    words = counted.where("n = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return saved(whole.unionByName(summed)), words


def part_counts(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """(lang, part, f) of distinct parts, by composition with the automata of the counted phrases."""
    rows = phrases.count()
    places = max(1, math.ceil(rows / COMPOSED), min(int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / 2000)))

    def placed(df: DataFrame, column: str) -> DataFrame:
        words = F.split(F.col(column), " ")
        return df.withColumn("place", F.pmod(F.xxhash64("lang", words[0], F.get(words, 1)), F.lit(places)))

    own = placed(phrases.select("lang", "phrase", "f"), "phrase").groupBy("lang", "place")
    return own.cogroup(placed(parts, "part").groupBy("lang", "place")).applyInArrow(_compose, "lang string, part string, f long")


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP, scale: int = SCALE, covered: int = COVERED) -> DataFrame:
    """The phrases of 2 to 4 words of each language that hold together best.

    Returns lang, rank, phrase, a (occurrences), l and r (those of the two parts
    of the lowest-scoring cut), n (words of the language) and score, floor(scale *
    a / (l + r)); without those that a longer candidate covers, and the first
    ``top`` of each language (all, if null).
    """
    phrases, n = counted_phrases(docs, least)
    candidates = phrases.where("n >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("head"), F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("tail"))
    parts = cuts.select("lang", F.explode(F.array("head", "tail")).alias("part")).distinct()
    known = saved(part_counts(phrases, parts))
    cuts = cuts.join(known.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr(f"(CAST({scale} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    longer = candidates.where(F.size("words") > 2).select("lang", F.col("a").alias("f"), F.explode(F.expr(inner)).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    hundred = lambda c, x: F.lit(x).cast("decimal(3,0)") * F.col(c).cast("decimal(20,0)")
    kept = best.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (hundred("longer", 100) < hundred("a", covered)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")).cast("long")
    ranked = kept.withColumn("rank", rank)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
