"""Shard/bucket exchange: how a document asks the whole corpus about its n-grams.

Texts are dealt once into *shards* of a few megabytes (one shuffle, reused by
every later step of the same plan).  A shard sends, for each *bucket* (a range
of the hash space), one row with all its distinct hashes in packed form; the
bucket merges the rows of all shards and answers each shard with one packed
row.  A hash that occurs in a third of all documents costs one entry per shard,
so no key can be hot; a bucket's size follows its share of the hash space.
Nothing passes through the driver but two numbers, the row count and the bytes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.rolling import give_back, pack, unpack

SHARD_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKET_BYTES = 1 << 20  # smaller buckets than BUCKET_BYTES where the cluster has the partitions for them
PARTITION_BYTES = 16 << 20
MOST_PARTITIONS = 20_000

REQUEST = "bucket int, shard int, payload binary"
REPLY = "shard int, bucket int, kind int, payload binary"
NULL_ID = np.iinfo(np.int64).max  # a null doc_id comes after all others


@dataclass(frozen=True)
class Shards:
    """The dealt texts: columns doc_id, text, shard; and how many shards and buckets there are."""

    frame: DataFrame
    shards: int
    buckets: int


def shard_of(shards: int) -> Column:
    """The shard of a row, by its doc_id; without one by its text."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))
    return F.pmod(key, F.lit(shards)).cast("int")


def deal(docs: DataFrame, shard_bytes: int | None = None, carry: bool = False) -> Shards:
    """Deal the texts into shards of about ``shard_bytes``; ``carry``: with the whole row, but for its text, as a struct."""
    shard_bytes = shard_bytes or SHARD_BYTES
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # with fewer, a cogroup would deal the texts again
    parts = max(least, min(MOST_PARTITIONS, math.ceil(total / PARTITION_BYTES)))
    carried = [F.struct(*(F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in docs.columns)).alias("row")] if carry else []
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", shard_of(shards).alias("shard"), *carried)
    buckets = max(1, math.ceil(total / BUCKET_BYTES), min(least, math.ceil(total / LEAST_BUCKET_BYTES)))
    return Shards(frame.repartition(parts, "shard"), shards, buckets)


def ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64) if table.num_rows else np.zeros(0, np.int64)


def in_order(table: pa.Table) -> pa.Table:
    """Rows by doc_id, then text; nulls last."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def bounds(buckets: int, bits: int) -> np.ndarray:
    """First value of each bucket of a hash space of ``bits`` bits."""
    return np.array([(b << bits) // buckets for b in range(buckets)], np.uint64)


def cuts(ascending: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where an ascending array of hashes passes from bucket to bucket."""
    return np.append(np.searchsorted(ascending, bounds(buckets, bits)), len(ascending))


def requests(shard: int, buckets: int, bits: int, *columns: np.ndarray) -> pa.Table:
    """One row for each bucket; the first column holds the ascending hashes."""
    at = cuts(columns[0], buckets, bits)
    own = [b for b in range(buckets) if at[b] < at[b + 1]]
    return pa.table({"bucket": pa.array(own, pa.int32()), "shard": pa.array([shard] * len(own), pa.int32()), "payload": pa.array([pack(*(c[at[b] : at[b + 1]] for c in columns)) for b in own], pa.binary())})


def replies(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip((("shard", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())), cols, strict=True)})


def gathered(table: pa.Table) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Of a bucket: its shards, the rows' sizes, and the columns of all requests end to end."""
    give_back()
    blobs = [unpack(x) for x in table["payload"].to_pylist()]
    return table["shard"].to_pylist(), np.array([len(b[0]) for b in blobs]), [np.concatenate(c) for c in zip(*blobs, strict=True)]


def answers(table: pa.Table, kind: int) -> list[list[np.ndarray]]:
    """Of a shard: the unpacked replies of one kind in the order of their buckets."""
    rows = [(b, p) for b, k, p in zip(*(table[c].to_pylist() for c in ("bucket", "kind", "payload")), strict=True) if k == kind]
    return [unpack(p) for _, p in sorted(rows, key=lambda r: r[0])]


def joined(parts: list[list[np.ndarray]], *empty) -> list[np.ndarray]:
    """Columns of all answers end to end; ``empty``: types if there are none."""
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in empty]


def pack_flags(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def flags(table: pa.Table, kind: int, n: int) -> np.ndarray:
    """Of a shard: the flags of one kind, in the order of the n hashes that it asked about."""
    rows = [(b, p) for b, k, p in zip(*(table[c].to_pylist() for c in ("bucket", "kind", "payload")), strict=True) if k == kind]
    parts = [np.unpackbits(np.frombuffer(p, np.uint8, offset=8), count=int.from_bytes(p[:8], "little")) for _, p in sorted(rows)]
    out = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(out) != n:
        raise RuntimeError(f"{len(out)} answers to {n} questions")
    return out


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def one_shard(table: pa.Table) -> int:
    return table["shard"][0].as_py()


def contains(ascending: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values occur in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def tied(tie: np.ndarray) -> tuple[np.ndarray, ...]:
    """The key that orders equal doc_ids, for lexsort; none if all have a doc_id."""
    return (tie,) if tie.any() else ()


def after_first(new: np.ndarray, count: np.ndarray, least: np.ndarray, tie: np.ndarray | None = None) -> np.ndarray:
    """Of entries grouped by name and in order: which come after the first of their name, by doc_id and tie."""
    first = np.repeat(least[new], count)
    later = first < least
    if tie is not None and tie.any():
        later |= (first == least) & (np.repeat(tie[new], count) < tie)
    return later


def answer_earlier(kind: int):
    """Of a bucket with columns (name, more bits, least doc_id[, tie]): does a smaller doc_id have the name in another shard?"""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        shards, sizes, (h, h2, least, *tie) = gathered(table)
        order = np.lexsort((*(k for t in tie for k in tied(t)), least, h2, h))
        a, b = h[order], h2[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        count = np.diff(np.append(np.flatnonzero(new), len(a)))
        earlier = np.zeros(len(a), bool)
        earlier[order] = after_first(new, count, least[order], *(t[order] for t in tie))
        ends = np.cumsum(sizes)
        return replies([(s, bucket, kind, pack_flags(earlier[i:j])) for s, i, j in zip(shards, ends - sizes, ends, strict=True)])

    return run
