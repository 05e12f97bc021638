"""Language-model scoring with a weighted backoff automaton of order three.

States are the pairs and the words seen in training, a start state and the root.
A state has an arc for each word that followed it in training and a failure arc
to the state of its last word, that of a word to the root; the root has an arc
for every word, of weight p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).  With a prior
of M tokens and the shorter state's step q(w), an arc out of h weighs
(c(hw) + M q(w)) / (c(h) + M) and the failure arc M / (c(h) + M), so the weights
out of a state sum to 1.  M is 1000 for words and 3 for pairs; both were chosen
on fold 1 of the training documents, learning from folds 2 to 9.

Arcs and states are gathered over all training documents by the shard/bucket
exchange: each shard sends its distinct words, pairs and triples with their
counts, each bucket adds them up and answers.  A shard then holds just the part
of the automaton that its own texts can reach, and traverses each text once from
left to right, carrying the state and summing log10 weights; since the state
after a token is its longest seen ending of two words, the steps of all texts run
as vectors, the failure arcs first.

Defined results: null and empty texts are one end token; a null doc_id counts as
the empty text for the held-out rule; ties and repeated rows are scored one by
one and each counts; other columns are ignored; an empty table gives an empty
result.  Word names have 64 bits, pair and triple names 48: of the triples of
1 TB of text about one in two thousand shares its name with another.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import exchange as X
from llm.rolling import SPACE_WORDS, Texts, give_back, mix, pack, unpack

ADD = 0.1
PRIOR = 1000.0  # M of a word's state
PAIR_PRIOR = 3.0  # M of a pair's state
FOLDS = 10
WORDS, PAIRS, TRIPLES = 0, 1, 2
BITS = {WORDS: 64, PAIRS: 48, TRIPLES: 48}
SHARDS = 2  # shards are so many times larger than those of the other operators: fewer names are sent twice
END, START = np.uint64(1), np.uint64(2)
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int | None, folds: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def _after(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of 64 bits for a word after a state."""
    return mix(mix(state + np.uint64(0x632BE59BD9B4E019)) ^ (word * np.uint64(0x9E3779B97F4A7C15)))


class Tokens:
    """Tokens of a shard: distinct words, pairs and triples, and each token's place among them.

    The first token of a text has no triple: its state is the start.
    """

    def __init__(self, table: pa.Table, folds: int):
        give_back()
        words = Texts(table["text"]).lower().words(SPACE_WORDS)
        n_docs = table.num_rows
        self.n = words.count + 1
        self.first = np.append(0, np.cumsum(self.n))[:-1]
        name = np.full(words.n + n_docs, END)
        ends = self.first + words.count
        inner = np.ones(len(name), bool)
        inner[ends] = False
        name[inner] = words.hashes()
        before = np.empty_like(name)
        before[1:] = name[:-1]
        before[self.first] = START
        self.doc_id = table["doc_id"].to_pylist()
        self.held = np.array([held_out(x, folds) for x in self.doc_id], bool)
        train = np.repeat(~self.held, self.n)
        self.words, self.word = np.unique(np.append(name, START), return_inverse=True)
        self.start, self.word = self.word[-1], self.word[:-1]
        pair = _after(before, name)
        self.later = np.ones(len(name), bool)
        self.later[self.first] = False
        triple = _after(pair[np.flatnonzero(self.later) - 1], name[self.later]) >> np.uint64(64 - BITS[TRIPLES])
        self.triples, self.triple = np.unique(triple, return_inverse=True)
        self.pairs, self.pair = np.unique(pair >> np.uint64(64 - BITS[PAIRS]), return_inverse=True)
        self.before = np.append(self.start, self.word[:-1])
        self.before[self.first] = self.start
        self.word_counts = np.bincount(self.word[train], minlength=len(self.words))
        self.word_counts[self.start] = (~self.held).sum()
        self.pair_counts = np.bincount(self.pair[train], minlength=len(self.pairs))
        self.triple_counts = np.bincount(self.triple[train[self.later]], minlength=len(self.triples))


def _ask(folds: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        t = Tokens(table, folds)
        shard, rows = X.one_shard(table), []
        for kind, name, count in ((WORDS, t.words, t.word_counts), (PAIRS, t.pairs, t.pair_counts), (TRIPLES, t.triples, t.triple_counts)):
            at = X.cuts(name, buckets, BITS[kind])
            rows += [(len(BITS) * b + kind, shard, pack(name[at[b] : at[b + 1]], count[at[b] : at[b + 1]].astype(np.uint32))) for b in range(buckets)]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("bucket", pa.int32()), ("shard", pa.int32()), ("payload", pa.binary())))})

    return run


def _add(table: pa.Table) -> pa.Table:
    """Counts over all shards; buckets of words also tell how many tokens and distinct words they hold."""
    place, kind = divmod(table["bucket"][0].as_py(), len(BITS))
    shards, sizes, (name, count) = X.gathered(table)
    names, member = np.unique(name, return_inverse=True)
    total = np.bincount(member, count, len(names)).astype(np.int64)
    ends, head = np.cumsum(sizes), b""
    if kind == WORDS:
        real = (total > 0) & (names != START)
        head = int(total[real].sum()).to_bytes(8, "little") + int(real.sum()).to_bytes(8, "little")
    each = total[member]
    return X.replies([(s, place, kind, head + pack(np.arange(b - a), each[a:b])) for s, a, b in zip(shards, ends - sizes, ends, strict=True)])


def _counts(told: pa.Table, kind: int, skip: int) -> tuple[np.ndarray, list[bytes]]:
    rows = sorted((b, p) for b, k, p in zip(*(told[c].to_pylist() for c in ("bucket", "kind", "payload")), strict=True) if k == kind)
    return np.concatenate([unpack(p[skip:])[1] for _, p in rows]).astype(np.float64), [p[:skip] for _, p in rows]


def _step(arc: np.ndarray, state: np.ndarray, shorter: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the steps out of states seen ``state`` times, by arcs seen ``arc`` times or the failure arc to the shorter state; unseen states are that state."""
    return np.where(state > 0, (arc + prior * shorter) / (state + prior), shorter)


def _score(folds: int, add: float, prior: float, pair_prior: float):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        t = Tokens(table, folds)
        c_word, heads = _counts(told, WORDS, 16)
        c_pair, c_triple = (_counts(told, kind, 0)[0] for kind in (PAIRS, TRIPLES))
        total = sum(int.from_bytes(h[:8], "little") for h in heads)
        distinct = sum(int.from_bytes(h[8:], "little") for h in heads)
        p_word = (c_word + add) / (total + add * (distinct + 1))
        p = p_word[t.word]
        step = _step(c_pair[t.pair], c_word[t.before], p, prior)
        step[t.later] = _step(c_triple[t.triple], c_pair[t.pair[np.flatnonzero(t.later) - 1]], step[t.later], pair_prior)
        sums = lambda x: np.round(np.add.reduceat(np.log10(x), t.first), 6) + 0.0
        known = np.add.reduceat((c_word[t.word] > 0).astype(np.int64), t.first)
        return pa.table({"doc_id": table["doc_id"], "held_out": pa.array(t.held), "n_tokens": pa.array(t.n, pa.int64()), "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([total] * len(t.n), pa.int64()), "base_score": pa.array(sums(p)), "score": pa.array(sums(step))})

    return run


def lm_scores(docs: DataFrame, folds: int = FOLDS, add: float = ADD, prior: float = PRIOR, pair_prior: float = PAIR_PRIOR) -> DataFrame:
    """Scores of all texts under an automaton of order three learnt from those outside fold 0.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (the
    smoothed unigram model) and score (the automaton), log10, to six decimals.
    """
    dealt = X.deal(docs, SHARDS * X.SHARD_BYTES)
    shards = dealt.frame.groupBy("shard")
    told = shards.applyInArrow(_ask(folds, dealt.buckets), X.REQUEST).groupBy("bucket").applyInArrow(_add, X.REPLY)
    return shards.cogroup(told.groupBy("shard")).applyInArrow(_score(folds, add, prior, pair_prior), RESULT)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
