"""Hard-negative mining by coordinate pruning in length buckets.

Vectors are dealt into *blocks*: rows of nearly the same length (a block is a run
of neighbouring length classes, or a share of one large class) of at most
``BLOCK_BYTES``.  Anchors, the stated query set, meet every block in chunks.  In a
block the normalised vectors have one sorted list for each coordinate; an anchor
with a least score has, for each of its ``FOCUS`` largest coordinates, a feasible
range of values, and only the rows inside all of these ranges are verified by
exact integer products.

Least scores come from a first search over one row in ``SEED`` (any k-th best
score among some rows is a bound for all rows, so this changes the work and never
a result), then all blocks are searched: once for the positives, and once for
the negatives, whose bands follow from the positives' scores.  A block returns
the best k of each anchor and band, and a ranked window over them gives the result.

Defined results: rows with a null vec_id, label or vector, or a null or
non-finite component, take no part; of rows that share a vec_id the least by
(label, vector) takes part; vectors of unlike length are compared as if filled up
with zeros; ties go to the smaller vec_id; an anchor without positives, and a
positive without negatives in its band, give no rows; a score beyond 64 bits counts
as the nearest 64-bit number; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.storage import saved

POSITIVES = 5
NEGATIVES = 10
BAND = (30, 90)  # percent of the positive's score
SCALE = 256.0
ANCHOR_EVERY = 100
MOVED_EVERY = 7
LABELS = 10
FOCUS = 4
SEED = 16
BLOCK_BYTES = 32 << 20  # of a block's components, as doubles
LEAST_ROWS = 1024  # smaller blocks than BLOCK_BYTES where the cluster has the partitions for them
CHUNK_ROWS = 50_000  # anchors that meet a block in one group
EXACT = 2.0**53  # below, sums of products of whole doubles are exact
LOWEST, HIGHEST = -(2**63), 2**63 - 1

FOUND = "anchor_id long, band int, vec_id long, score long"


def taken(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, size class) of the rows that take part, with moved labels."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(id_ % MOVED_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.where(id_.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).where(finite)
    rows = rows.select(id_.alias("vec_id"), F.struct(moved.alias("label"), F.col("embedding").alias("vector")).alias("row"))
    one = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")
    size = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return one.withColumn("size", F.when(size > 0, F.floor(4 * F.log2(F.least(size, F.lit(1e308))))).otherwise(F.lit(-(10**6))).cast("int"))


def blocks_of(counts: list[tuple[int, int]], rows: int) -> list[tuple[int, int, int, int]]:
    """(first class, last class, first block, blocks) of each run of size classes with about ``rows`` rows a block."""
    out: list[tuple[int, int, int, int]] = []
    begin, held, block = None, 0, 0
    for k, (cls, n) in enumerate(counts):
        begin, held = cls if begin is None else begin, held + n
        if held >= rows or k == len(counts) - 1:
            share = max(1, round(held / rows))
            out.append((begin, cls, block, share))
            begin, held, block = None, 0, block + share
    return out


def _block(runs: list[tuple[int, int, int, int]], salt: str) -> Column:
    """The block of a row, by its size class and a hash of its id."""
    out = F.lit(None).cast("int")
    for first, last, block, share in reversed(runs):
        own = F.lit(block) + F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(share)).cast("int")
        out = F.when(F.col("size").between(first, last), own).otherwise(out)
    return out


def dealt(rows: DataFrame, salt: str = "") -> tuple[DataFrame, int]:
    """Rows with their block, and the number of blocks; only the row counts of size classes reach the driver (8,600 at most)."""
    told = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vector")).alias("parts")).sort("size").collect()
    total, parts = sum(r["n"] for r in told), sum(r["parts"] for r in told)
    if not total:
        return rows.withColumn("block", F.lit(0)), 1
    most = max(1, BLOCK_BYTES // (8 * max(1, parts // total)))
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(most, max(LEAST_ROWS, math.ceil(total / least)))
    runs = blocks_of([(r["size"], r["n"]) for r in told], size)
    return rows.withColumn("block", _block(runs, salt)), runs[-1][2] + runs[-1][3]


class Vectors:
    """Whole-number vectors: exact as doubles, as Python numbers where doubles can't hold them."""

    def __init__(self, column: pa.ChunkedArray):
        arr = column.combine_chunks()
        arr = pa.concat_arrays(arr.chunks) if isinstance(arr, pa.ChunkedArray) else arr
        size = np.diff(arr.offsets.to_numpy()) if len(arr) else np.zeros(0, np.int64)
        flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out = np.zeros((len(size), max(1, size.max(initial=0))))
        out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        with np.errstate(over="ignore"):
            self.codes = np.floor(out * SCALE)
            self.long = np.sqrt((self.codes**2).sum(1))
        self.wide = not np.isfinite(self.long).all()
        self.raw = out if self.wide else None

    def widened(self, dims: int) -> np.ndarray:
        return np.pad(self.codes, ((0, 0), (0, dims - self.codes.shape[1])))

    def whole(self, i: int) -> list[int]:
        """Row i as Python numbers: floor(256 x) of doubles beyond 2**53 is 256 times a whole number."""
        if self.raw is None:
            return [int(x) for x in self.codes[i]]
        return [int(x) * int(SCALE) if abs(x) >= EXACT else math.floor(x * SCALE) for x in self.raw[i]]


class Lists:
    """A block with a sorted list of the normalised values of each coordinate."""

    def __init__(self, table: pa.Table, dims: int):
        vectors = Vectors(table["vector"])
        self.vectors = vectors
        self.codes = vectors.widened(max(dims, vectors.codes.shape[1]))
        self.id, self.label = table["vec_id"].to_numpy(), table["label"].to_numpy()
        self.unit = self.codes / np.where(vectors.long > 0, vectors.long, 1)[:, None]
        self.order = np.argsort(self.unit, 0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.unit, self.order, 0)
        self.longest, self.shortest = vectors.long.max(), vectors.long.min()

    def feasible(self, query: np.ndarray, long: float, least: int) -> np.ndarray | None:
        """Rows whose product with the query can be ``least`` or more, by the ranges of the focus coordinates; None: all."""
        if long == 0 or self.longest == 0:
            return None if least <= 0 else np.zeros(0, np.int64)
        reach = least / long / (self.longest if least > 0 else self.shortest) if least > 0 or self.shortest > 0 else -1.0
        reach -= 1e-9
        if reach > 1:
            return np.zeros(0, np.int64)
        if reach <= -1:
            return None
        unit = query / long
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        own, wide = np.arccos(np.clip(unit[focus], -1, 1)), math.acos(reach)
        low = np.cos(np.minimum(math.pi, own + wide)) - 1e-9
        high = np.cos(np.maximum(0, own - wide)) + 1e-9
        span = [(np.searchsorted(self.sorted[:, f], a), np.searchsorted(self.sorted[:, f], b, side="right"), f) for f, a, b in zip(focus, low, high, strict=True)]
        shortest = min(range(len(span)), key=lambda i: span[i][1] - span[i][0])
        begin, end, f = span[shortest]
        rows = self.order[begin:end, f]
        for i in range(len(span)):
            if i != shortest:
                at = self.unit[rows, focus[i]]
                rows = rows[(at >= low[i]) & (at <= high[i])]
        return rows

    def scores(self, rows: np.ndarray | None, query: Vectors, i: int, code: np.ndarray) -> np.ndarray:
        """Exact products of the rows with query i; the nearest 64-bit numbers of those beyond."""
        if not (query.wide or self.vectors.wide) and query.long[i] * self.longest < EXACT:
            return ((self.codes if rows is None else self.codes[rows]) @ code).astype(np.int64)
        own = query.whole(i)
        whole = (sum(a * b for a, b in zip(self.vectors.whole(r), own, strict=False)) for r in (range(len(self.id)) if rows is None else rows))
        return np.array([max(LOWEST, min(HIGHEST, x)) for x in whole], np.int64)


def _search(k: int, same: bool):
    """Of one block and one chunk of anchors: each band's best k rows of the same or of another label."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if anchors.num_rows and rows.num_rows:
            query = Vectors(anchors["query"])
            lists = Lists(rows, query.codes.shape[1])
            codes = query.widened(lists.codes.shape[1])
            ids, labels = anchors["anchor_id"].to_numpy(), anchors["anchor_label"].to_numpy()
            for i, bands in enumerate(anchors["bands"].to_pylist()):
                at = None if query.wide or lists.vectors.wide else lists.feasible(codes[i], float(query.long[i]), min(b["low"] for b in bands))
                score = lists.scores(at, query, i, codes[i])
                at = np.arange(len(lists.id)) if at is None else at
                ok = (lists.label[at] == labels[i]) & (lists.id[at] != ids[i]) if same else lists.label[at] != labels[i]
                at, score = at[ok], score[ok]
                for b in bands:
                    own = np.flatnonzero((score >= b["low"]) & (score <= b["high"]))
                    if len(own) > 4 * k:  # all that tie with the k-th best
                        own = own[score[own] >= np.partition(score[own], -k)[-k]]
                    best = own[np.lexsort((lists.id[at[own]], ~score[own]))[:k]]
                    found += [(int(ids[i]), b["band"], int(lists.id[at[j]]), int(score[j])) for j in best]
        columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("anchor_id", "band", "vec_id", "score"), columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k of each anchor and band, with their rank."""
    order = Window.partitionBy("anchor_id", "band").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(anchors: DataFrame, rows: DataFrame, blocks: int, chunks: int, k: int, same: bool) -> DataFrame:
    """anchors (anchor_id, anchor_label, query, bands array of (band, low, high)) against rows with their block: the best k of each band."""
    keyed = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor_id", F.lit("chunk")), F.lit(chunks)).cast("int"))
    keyed = keyed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    found = keyed.groupBy("block", "chunk").cogroup(met.groupBy("block", "chunk")).applyInArrow(_search(k, same), FOUND)
    return _best(found, k)


def _raised(anchors: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """The anchors with the k-th best score among the seeds as the least score of each band that has so many."""
    least = seeds.where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("known"))
    raised = F.transform("bands", lambda b: F.struct(b["band"].alias("band"), F.greatest(b["low"], F.coalesce(F.try_element_at("known", b["band"]), b["low"])).alias("low"), b["high"].alias("high")))
    return anchors.join(least, "anchor_id", "left").withColumn("bands", raised).drop("known")


def _searched(anchors: DataFrame, rows: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The best k of each band: a search of the seeds for bounds, then of all rows."""
    chunks = max(1, math.ceil(anchors.count() / CHUNK_ROWS))
    seeds = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("seed")), F.lit(SEED)) == 0).withColumn("block", F.floor(F.col("block") / SEED).cast("int"))
    known = search(anchors, seeds, -(-blocks // SEED), chunks, k, same)
    return search(_raised(anchors, known, k), rows, blocks, chunks, k, same)


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND, anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """For each anchor and each of its nearest rows of the same label, the nearest rows of other labels within a band of that score.

    Returns anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    """
    rows, blocks = dealt(saved(taken(vectors)))
    rows = saved(rows.drop("size"))
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("vector").alias("query"))
    whole = F.array(F.struct(F.lit(0).alias("band"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high")))
    near = saved(_searched(anchors.withColumn("bands", whole), rows, blocks, positives, True).select("anchor_id", F.col("rank").alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    score = F.col("positive_score").cast("decimal(20,0)")
    low = F.ceil(score * band[0] / 100).cast("long")
    high = F.floor(score * band[1] / 100).cast("long")
    bands = near.withColumns({"low": low, "high": high}).where("low <= high").groupBy("anchor_id").agg(F.collect_list(F.struct("band", "low", "high")).alias("bands"))
    far = _searched(anchors.join(bands, "anchor_id"), rows, blocks, negatives, False)
    return far.join(near, ["anchor_id", "band"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
