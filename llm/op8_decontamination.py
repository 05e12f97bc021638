"""Benchmark decontamination with one Aho-Corasick automaton.

Items and texts are normalised to lower-case words joined by spaces.  Every
window of ``width`` words of an item (an item of fewer words is one window) is a
pattern; each text is scanned once, and the ends of hits are mapped back through
word numbers to character offsets of the original text.

The automaton is built in each task from item windows that the driver sends, so
the items are measured first: they go in blocks of at most ``BLOCK_CHARS``
characters (an item larger than that is its own block) and each block scans all
texts once.  With more than one block the rows are numbered in a table of the
shared folder, each block's hits are written there without the texts, and Spark
adds them up by row; so the driver holds one block at a time, however many items
there are, a task one automaton, and no text is copied more than once.

Defined results: null and empty texts or items have no words; an item without
words never hits; items with equal text all count; a null item_id is left out of
the list of ids, but its words are hit; a null doc_id stays null and rows that
share a doc_id are judged each on its own; other columns are ignored; empty
tables give no hits or an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.rolling import ALNUM_WORDS, LOWER, Texts, covered
from llm.storage import saved

WIDTH = 10
BLOCK_CHARS = 8 << 20
# bytes of a text to those of its words: A-Z to a-z, separators to spaces; all bytes of other characters stay
NORMAL = bytes(int(LOWER[b]) if ALNUM_WORDS[LOWER[b]] else 0x20 for b in range(256))
ROW = "_row"
# runs of hit words: their numbers from ``first`` to before ``last``, and their characters
FOUND = "n_words long, item_ids array<string>, runs array<struct<first:long,last:long,start:long,end:long>>"
RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def automaton(items: list[tuple], width: int) -> ahocorasick.Automaton:
    """Patterns " w1 ... wn " with their length in words and the ids of the items that have them."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            own = words[i : i + width]
            _, ids = found.setdefault((b" " + b" ".join(own) + b" ").decode(), (len(own), set()))
            if item_id is not None:
                ids.add(str(item_id))
    a = ahocorasick.Automaton()
    for pattern, value in found.items():
        a.add_word(pattern, value)
    if found:
        a.make_automaton()
    return a


def char_offsets(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in characters of the original text."""
    words = Texts(pa.array([text])).lower().words(ALNUM_WORDS)
    chars = np.append(0, np.cumsum(words.texts.buf & 0xC0 != 0x80))
    return chars[words.start], chars[words.end]


def runs(gone: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
    ends = zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True)
    return [{"first": a, "last": b, "start": int(start[a]), "end": int(end[b - 1])} for a, b in ends]


def _rows(keep: list, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.list_(pa.string()), RUNS)
    return pa.RecordBatch.from_arrays([*keep, *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], [*names, "n_words", "item_ids", "runs"])


def _scan(items: list[tuple], width: int, keep: list[str], every: bool):
    """Hits of one block of items in all texts; ``every``: also a row for each text without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(items, width)
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for k, value in enumerate(batch["text"]):
                text = value.as_py()
                words = words_of(text)
                n = len(words)
                hits = list(a.iter((b" " + b" ".join(words) + b" ").decode())) if len(a) and n else []
                if not hits:
                    if every:
                        rows.append((n, [], []))
                        at.append(k)
                    continue
                stop = np.cumsum([len(w.decode()) + 1 for w in words])  # the space after each word, in the normalised text
                last = np.searchsorted(stop, [i for i, _ in hits])
                size = np.array([w for _, (w, _) in hits])
                rows.append((n, sorted(set().union(*(i for _, (_, i) in hits))), runs(covered(last - size + 1, size, n), *char_offsets(text))))
                at.append(k)
            yield _rows([batch[c].take(pa.array(at, pa.int64())) for c in keep], rows, keep)

    return run


def merged(found: list[dict]) -> list[dict]:
    """Runs of several blocks as maximal runs: those that overlap or follow each other without a word between are one."""
    out: list[dict] = []
    for r in sorted(found, key=lambda r: (r["first"], r["last"])):
        if out and r["first"] <= out[-1]["last"]:
            if r["last"] > out[-1]["last"]:
                out[-1].update(last=r["last"], end=r["end"])
        else:
            out.append(dict(r))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = zip(*(batch[c].to_pylist() for c in ("n_words", "item_ids", "runs")), strict=True)
        yield _rows([batch[ROW]], [(n, sorted(set(ids)), merged(own)) for n, ids, own in found], [ROW])


def item_blocks(items: DataFrame, most: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``most`` characters, one block at a time on the driver."""
    block: list[tuple] = []
    size = 0
    for row in items.select("item_id", "text").toLocalIterator():
        n = len(row[1] or "")
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    yield block


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Words of each text inside an occurrence of a benchmark window.

    Returns doc_id, n_words, n_hit, item_ids (sorted strings), spans (character
    offsets of maximal hit runs in the original text), contaminated.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    spans = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    found = _scanned(texts, items, width).select("doc_id", "n_words", n_hit.alias("n_hit"), "item_ids", spans.alias("spans"))
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _table(rows: DataFrame, keep: list[str]) -> T.StructType:
    return T.StructType([*(rows.schema[c] for c in keep), *T.StructType.fromDDL(FOUND).fields])


def _hits(keyed: DataFrame, blocks: Iterator[list[tuple]], width: int, every: bool) -> DataFrame:
    """Hits of each block in numbered rows, one written table a block; ``every``: the first one tells of all rows."""
    schema = _table(keyed, [ROW])
    return reduce(DataFrame.unionByName, [saved(keyed.select(ROW, "text").mapInArrow(_scan(block, width, [ROW], every and k == 0), schema)) for k, block in enumerate(blocks)])


def _split(rows: DataFrame, items: DataFrame) -> tuple[list[tuple] | None, DataFrame | None]:
    """The block of items, if one holds them all; else the rows, numbered in a table."""
    blocks = item_blocks(items)
    only = next(blocks)
    if next(blocks, None) is None:
        return only, None
    return None, saved(rows.withColumn(ROW, F.monotonically_increasing_id()))


def _scanned(rows: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """All columns of rows but the text, with those of FOUND."""
    keep = [c for c in rows.columns if c != "text"]
    only, keyed = _split(rows, items)
    if keyed is None:
        return rows.mapInArrow(_scan(only, width, keep, True), _table(rows, keep))
    hits = _hits(keyed, item_blocks(items), width, True)
    one = hits.groupBy(ROW).agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("item_ids")).alias("item_ids"), F.flatten(F.collect_list("runs")).alias("runs"))
    return keyed.drop("text").join(one.mapInArrow(_merge, _table(keyed, [ROW])), ROW).drop(ROW)


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows without any benchmark window, with all columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    only, keyed = _split(rows, items)
    if keyed is None:
        return rows.mapInArrow(_scan(only, width, ["row"], True), _table(rows, ["row"])).where(F.size("runs") == 0).select("row.*")
    return keyed.join(_hits(keyed, item_blocks(items), width, False).select(ROW), ROW, "left_anti").select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = decontaminate(docs, items)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
