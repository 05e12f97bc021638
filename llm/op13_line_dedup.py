"""Line dedup with two Bloom filters, for line keys seen once and seen twice.

Each portion of documents sends the filter positions of its line keys, packed by
*block* of the filter; a block merges them in a stream, so a position that two
documents set passes from the once-seen to the twice-seen filter.  Only the
twice-seen filter comes back, as a broadcast of at most ``MOST_BITS`` bits: it is
sized by the number of lines up to that bound, and beyond it more keys are
suspected, which costs shuffle but no result.  Keys that it has not seen twice
never leave their task.  The suspected ones are shuffled as exact 128-bit digests,
one row for each key and document, counted by document, and their first document
is chosen; the lists of confirmed keys then join the documents.

A key that occurs in a third of all documents costs one filter position a
portion, one row a document (dealt by key and document), and partial counts.
Documents meet their lists in a sort-merge join at every size of the table, since
no list of confirmed keys has a bound that would allow a broadcast.

Defined results: a null or empty text is one empty line; rows that share a doc_id
are one document in the count, as are rows without a doc_id that share a text,
and each row is returned; a null doc_id stays null; a key below ``least_chars``
code points (the empty one, for 1) is never dropped; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.rolling import give_back, pack, unpack
from llm.storage import saved

LEAST_CHARS = 1
LEAST_DOCUMENTS = 10
STRIPPED = b" \t\n\x0b\x0c\r"
BITS_A_LINE = 16
LEAST_BITS = 1 << 20
MOST_BITS = 1 << 29  # 64 MB: the bound of what is broadcast
BLOCK_BITS = 18  # positions of a block: 2 ** 18
PORTION_KEYS = 400_000

RESULT = "doc_id long, n_lines long, n_dropped long, kept string"


def split(text: bytes | None) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and their keys."""
    lines = (text or b"").split(b"\n")
    return lines, [x.strip(STRIPPED).lower() for x in lines]  # bytes.lower() changes A-Z alone


def wanted(keys: list[bytes], least_chars: int) -> set[bytes]:
    """The distinct keys that are long enough."""
    return {k for k in keys if len(k) >= least_chars and (len(k) >= 4 * least_chars or len(k.decode()) >= least_chars)}


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def positions(digests: list[bytes], bits: int) -> np.ndarray:
    """The two filter positions of each digest, one row each."""
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2) & np.uint64(bits - 1)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch["text"].cast(pa.large_binary()).to_pylist()


def _mark(bits: int, least_chars: int):
    """Of each portion, a row for each block: the positions set, and whether twice."""

    def told(digests: list[bytes]) -> Iterator[pa.RecordBatch]:
        at, count = np.unique(positions(digests, bits), return_counts=True)
        block = at >> np.uint64(BLOCK_BITS)
        cut = np.flatnonzero(np.diff(block, prepend=np.uint64(2**63)))
        ends = np.append(cut[1:], len(at))
        inside = (at & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32)
        blobs = [pack(inside[i:j], count[i:j] > 1) for i, j in zip(cut, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(block[cut].astype(np.int32)), pa.array(blobs, pa.binary())], ["block", "payload"])
        give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[bytes] = []
        for batch in batches:
            for text in _texts(batch):
                own += map(digest, wanted(split(text)[1], least_chars))
                if len(own) >= PORTION_KEYS:
                    yield from told(own)
                    own = []
        if own:
            yield from told(own)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The twice-seen filter of one block, from all portions; the once-seen one stays here."""
    once, twice = np.zeros((2, 1 << BLOCK_BITS), bool)
    block = None
    for batch in batches:
        for payload in batch["payload"]:
            at, again = unpack(payload.as_py())
            twice[at[again | once[at]]] = True
            once[at] = True
        block = batch["block"][0].as_py() if batch.num_rows else block
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], ["block", "bits"])


def seen_twice(docs: DataFrame, least_chars: int = LEAST_CHARS, most_bits: int = MOST_BITS) -> np.ndarray:
    """The packed twice-seen filter over the keys of all lines; ``most_bits``: the most bits of it, a power of two."""
    lines = docs.agg(F.sum(F.expr(r"octet_length(text) - octet_length(replace(text, '\n', '')) + 1"))).first()[0] or 0
    bits = min(most_bits, max(LEAST_BITS, 1 << int(lines * BITS_A_LINE).bit_length()))
    out = np.zeros(bits >> 3, np.uint8)
    merged = docs.select("text").mapInArrow(_mark(bits, least_chars), "block int, payload binary").groupBy("block").applyInArrow(_merge, "block int, bits binary")
    for row in merged.toLocalIterator():
        begin = row["block"] << (BLOCK_BITS - 3)
        out[begin : begin + (1 << (BLOCK_BITS - 3))] = np.frombuffer(row["bits"], np.uint8)
    return out


def _suspect(sent, least_chars: int):
    """(doc, nameless, key) of each distinct key of a document whose positions were all seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filtered = sent.value
        bits = len(filtered) << 3
        for batch in batches:
            rows, digests = [], []
            for k, text in enumerate(_texts(batch)):
                new = [*map(digest, wanted(split(text)[1], least_chars))]
                rows += [k] * len(new)
                digests += new
            if not rows:
                continue
            at = positions(digests, bits)
            hit = np.flatnonzero(((filtered[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(1))
            rows = pa.array(np.array(rows)[hit])
            yield pa.RecordBatch.from_arrays([batch["doc"].take(rows), batch["nameless"].take(rows), pa.array([digests[i] for i in hit], pa.binary())], ["doc", "nameless", "key"])

    return run


def _drop(keep_first: bool):
    """Rows without the lines whose keys are listed; a listed key that is marked keeps its first line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, listed in zip(_texts(batch), batch["listed"].to_pylist(), strict=True):
                if not listed:
                    lines = (text or b"").count(b"\n") + 1
                    out.append((lines, 0, text or b""))
                    continue
                gone = {x["key"]: x["first"] and keep_first for x in listed}
                lines, keys = split(text)
                kept, known = [], {}
                for line, key in zip(lines, keys, strict=True):
                    if (name := known.get(key)) is None:
                        name = known[key] = digest(key)
                    if name not in gone:
                        kept.append(line)
                    elif gone[name]:
                        gone[name] = False
                        kept.append(line)
                out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
            n, dropped, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return run


def without_repeated_lines(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = LEAST_CHARS,
    keep_first: bool = False,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """Documents without the lines whose key occurs in ``least_documents`` (2 or more) documents.

    Returns doc_id, n_lines, n_dropped and kept (the other lines, joined by \\n).
    ``keep_first``: the first line with the key in the document of the smallest
    doc_id (those without one come last, by the hash of their text) stays.
    """
    if least_documents < 2 or least_chars < 1 or most_bits < 1 << BLOCK_BITS:
        raise ValueError(f"least_documents must be 2 or more, least_chars 1 or more, most_bits {1 << BLOCK_BITS} or more")
    spark = docs.sparkSession
    id_ = F.col("doc_id").cast("long")
    named = docs.select(id_.alias("doc_id"), "text", F.coalesce(id_, F.xxhash64("text")).alias("doc"), id_.isNull().alias("nameless"))
    sent = spark.sparkContext.broadcast(seen_twice(docs, least_chars, most_bits))
    found = saved(named.select("doc", "nameless", "text").mapInArrow(_suspect(sent, least_chars), "doc long, nameless boolean, key binary").distinct())
    first = F.min(F.struct("nameless", "doc"))
    confirmed = saved(found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first.alias("least")).where(F.col("n") >= least_documents))  # else a hot key's rows could not be split
    listed = F.struct("key", (F.struct("nameless", "doc") == F.col("least")).alias("first"))
    gone = saved(found.join(confirmed.select("key", "least"), "key").groupBy("doc", "nameless").agg(F.collect_list(listed).alias("listed")))
    return named.join(gone.hint("merge"), ["doc", "nameless"], "left").select("doc_id", "text", "listed").mapInArrow(_drop(keep_first), RESULT)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
