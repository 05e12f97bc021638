"""Quality rules under weak supervision.

Each rule votes good or bad on a text, or abstains.  Expectation-maximisation
estimates without labels how often each rule votes what on good and on bad
texts, from the counts of vote patterns over all texts (the patterns are at most
3 ** rules, a proven bound, so only they reach the driver).  The posterior
probability of being good replaces the demand that a text pass every rule: a
text is kept if it is at least ``KEEP`` and the base rules don't fail it.

Defined results: null and empty texts have no words, so the base rules fail
them; a null doc_id stays null; equal texts get equal verdicts; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.rolling import SPACE_WORDS, SPACES, Texts, covered, give_back, slices
from llm.storage import saved

MIN_WORDS = 20
MOST_REPEATED = 30  # percent of words in repeated windows
REPEAT_WINDOW = 8
KEEP = 0.5
ROUNDS = 100
SPACE_BYTES = bytes(np.flatnonzero(SPACES).tolist())
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTERS = UPPER.copy()
LETTERS[97:123] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks", "n_stutter", "n_distinct", "n_symbol_words")
BASE = COUNTS[:5]
#: rule: value, good up to, bad from (between them it abstains)
RULES = {
    "symbols": ("n_symbols / n_words", 0.05, 0.3),
    "symbol_words": ("n_symbol_words / n_words", 0.05, 0.3),
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", 0.02, 0.07),
    "upper": ("n_upper / greatest(n_letters, 1)", 0.25, 0.6),
    "marks": ("n_marks / n_words", 0.1, 0.5),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.1, 0.5),
    "repeats": ("n_repeat_words / n_words", 0.1, 0.25),
    "stutter": ("n_stutter / n_words", 0.03, 0.15),
    "word_length": ("abs(word_chars / n_words - 6)", 3.0, 6.0),
    "sameness": ("1 - n_distinct / pow(n_words, 0.8)", 0.3, 0.8),
    "shortness": ("1 / n_words", 0.02, 0.05),
}


def _count(keep: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "text" not in batch.schema.names:  # it comes inside the whole row
                batch = pa.RecordBatch.from_arrays([batch["row"], pc.struct_field(batch["row"], "text")], ["row", "text"])
            for own in slices(batch, "text"):
                give_back()
                yield pa.RecordBatch.from_arrays([*(own[c] for c in keep), *(pa.array(c, pa.int64()) for c in counts(own["text"]))], [*keep, *COUNTS])

    return run


def counts(column: pa.Array) -> list[np.ndarray]:
    """COUNTS of each text."""
    texts = Texts(column)
    words = texts.words(SPACE_WORDS)
    buf, n = texts.buf, texts.n
    total = lambda mask: np.diff(np.append(0, np.cumsum(mask))[texts.off])
    each = lambda mask: np.bincount(words.doc, mask, n).astype(np.int64)
    values = words.hashes()
    at, h = words.windows(values, REPEAT_WINDOW)
    order = np.lexsort((h, words.doc[at]))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (h[order][1:] == h[order][:-1]) & (words.doc[at[order]][1:] == words.doc[at[order]][:-1])
    repeated = covered(at[order[same[1:] | same[:-1]]], REPEAT_WINDOW, words.n)
    stutter = np.zeros(words.n, bool)
    stutter[1:] = (values[1:] == values[:-1]) & (words.doc[1:] == words.doc[:-1])
    order = np.lexsort((values, words.doc))
    new = np.ones(words.n, bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    so_far = np.append(0, np.cumsum(SYMBOLS[buf]))
    marked = so_far[words.end] > so_far[words.start]
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        own = [x for x in texts.bytes_of(i).split(b"\n") if x.strip(SPACE_BYTES)]
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    return [words.count, total(SPACE_WORDS[buf] & (buf & 0xC0 != 0x80)), total(SYMBOLS[buf]), dup, each(repeated), lines, total(LETTERS[buf]), total(UPPER[buf]), total(buf == ord("!")), each(stutter), np.bincount(words.doc[order], new, n).astype(np.int64), each(marked)]


def votes() -> dict:
    """A column for each rule: 1 good, 0 bad, null abstains."""
    out = {}
    for name, (value, good, bad) in RULES.items():
        x = F.expr(value)
        out[name] = F.when(F.col("n_words") == 0, F.lit(0)).when(x <= good, F.lit(1)).when(x >= bad, F.lit(0))
    return out


def fit(patterns: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of good for each vote pattern (-1 abstains), by expectation-maximisation.

    Starts from the share of good votes; pseudo-counts keep every probability
    inside (0, 1) and favour rules that are right more often than wrong.
    """
    said = np.stack([patterns == v for v in (0, 1, -1)], 2).astype(float)  # pattern, rule, vote
    cast = np.maximum((patterns >= 0).sum(1), 1)
    p = np.where((patterns >= 0).any(1), ((patterns == 1).sum(1) + 0.5) / (cast + 1), 0.5)
    p = np.where((patterns == 0).any(1), np.minimum(p, 0.5), p)
    total = weight.sum()
    for _ in range(rounds):
        before, good, bad = p, weight * p, weight * (1 - p)
        prior = (good.sum() + 1) / (total + 2)
        # pseudo-votes (bad, good, abstain) of a twentieth of a per cent of the texts
        scale = max(1.0, total / 2000)
        log = []
        for w, pseudo in ((good, (0.05, 0.9, 0.05)), (bad, (0.4, 0.5, 0.1))):
            c = np.einsum("i,irv->rv", w, said) + scale * np.array(pseudo)
            log.append(np.einsum("irv,rv->i", said, np.log(c / c.sum(1, keepdims=True))))
        odds = np.log(prior / (1 - prior)) + log[0] - log[1]
        p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(p - before).max() < 1e-9:
            break
    return p


def _judged(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with COUNTS, base_failed and the pattern of votes."""
    counted = docs.mapInArrow(_count(keep), T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in COUNTS]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    pattern = F.concat(*(F.coalesce(v.cast("string"), F.lit("-")) for v in votes().values()))
    return counted.withColumn("base_failed", failed).withColumn("pattern", pattern)


def _posteriors(judged: DataFrame, rounds: int) -> DataFrame:
    """(pattern, p_good), fitted to the patterns of all rows."""
    seen = sorted(judged.groupBy("pattern").count().collect())  # at most 3 ** rules rows
    value = {"0": 0, "1": 1, "-": -1}
    p = fit(np.array([[value[c] for c in r[0]] for r in seen]), np.array([float(r[1]) for r in seen]), rounds) if seen else []
    return F.broadcast(judged.sparkSession.createDataFrame([(r[0], float(x)) for r, x in zip(seen, p, strict=True)], "pattern string, p_good double"))


def _kept(keep: float) -> Column:
    return ~F.col("base_failed") & (F.col("p_good") >= keep)


def quality(docs: DataFrame, keep: float = KEEP, rounds: int = ROUNDS) -> DataFrame:
    """Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and p_good."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    judged = saved(_judged(texts, "doc_id").select("doc_id", *BASE, "base_failed", "pattern"))
    out = judged.join(_posteriors(judged, rounds), "pattern")
    return out.select("doc_id", *BASE, "base_failed", _kept(keep).alias("kept"), "p_good")


def good_documents(docs: DataFrame, keep: float = KEEP, rounds: int = ROUNDS) -> DataFrame:
    """The rows that the base rules and the posterior keep, with all columns; texts are read twice, none is shuffled."""
    fitted = _posteriors(_judged(docs.select("text")), rounds)
    rows = docs.select(F.struct("*").alias("row"))
    return _judged(rows, "row").join(fitted, "pattern").where(_kept(keep)).select("row.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
