"""N-gram Jaccard join with prefix trees.

1. Equal shingle sets collapse into one class.
2. The shard/bucket exchange counts in how many classes each shingle occurs.
   That fixes one global order, rarest first.  A set whose part before the last
   ``ceil(t n)`` shingles (its *prefix*) holds only shingles of its own has no
   partner; the others are candidates.  Two sets can only link if a shingle of
   both prefixes is among the first ``early_length`` of the smaller set.
3. Candidates connected through prefixes form blocks.  In a block the sets,
   most frequent shingles first, become paths of a compressed trie.  Each set
   traverses the trie of those before it: sets with a common path share its
   overlap, and a subtree is left as soon as the overlap so far and the lengths
   that remain can't reach the threshold, or when all its sets are already
   connected with the traversing one.
4. A candidate group beyond ``block_sets`` classes is split over several tries:
   each joins its own part, then one set of every component found meets the
   others', then each set outside the largest component traverses those tries
   of its group that hold a set which it can link with by 2.  Every pair is
   compared, already connected or can't link, so no component is missed, and no
   task holds more than ``block_sets`` sets and its probes.

``jaccard_links`` counts links instead: without the cut at connected subtrees
each set meets the tries that hold a set which it can link with by 2, each pair
once, in tasks of one trie and the sets of at most ``PROBING`` other blocks, and
a link counts with the number of rows of the class at its other end.  No pair
leaves a task.

Defined results: texts without words have an empty set and are linked with
nothing; with fewer words than a shingle has, the whole sequence is the one
shingle; a null doc_id never is a component's id (null if it has no other);
rows that share a doc_id are members each by its own text; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm import exchange as X
from llm.components import components
from llm.rolling import SPACE_WORDS, Texts, give_back, mix, pack, rolling, slices, unpack
from llm.storage import saved

WORDS = 4
PERCENT = 85
BLOCK_SETS = 250
PROBING = 8
BITS = 48
LEVELS, CLASSES = 1, 2
SETS = "shard int, nameless boolean, id long, said long, n long, h1 long, h2 long"
CANDIDATES = "cls long, n long, tokens binary, prefix array<long>, early int"


class Shingles:
    """Distinct shingles of each text of a shard, ascending, end to end; ``first`` where each text's begin."""

    def __init__(self, table: pa.Table, width: int):
        give_back()
        words = Texts(table["text"]).lower().words(SPACE_WORDS)
        values = words.hashes()
        at, h = words.windows(values, width)
        doc = words.doc[at]
        short = np.flatnonzero((words.count > 0) & (words.count < width))
        whole = [mix(rolling(values[words.first[i] : words.first[i + 1]], int(words.count[i])) ^ np.uint64(words.count[i])) for i in short]
        h, doc = np.concatenate([h, *whole]), np.append(doc, short)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.zeros(0, bool)
        self.hash, self.doc = h[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(table.num_rows + 1))
        self.n = np.diff(self.first)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name the set of each text, as two columns."""
        sums = [np.append(np.uint64(0), np.cumsum(mix(self.hash ^ np.uint64(k)))) for k in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]
        h1, h2 = (np.diff(c[self.first]).view(np.int64) for c in sums)
        return h1, h2

    def chosen(self, told: pa.Table) -> np.ndarray:
        """Of a shard: the class for which each text stands; -1: another text does."""
        want = {}
        for kind, p in zip(told["kind"].to_pylist(), told["payload"].to_pylist(), strict=True):
            if kind == CLASSES:
                h1, h2, cls = (int.from_bytes(p[i : i + 8], "big", signed=True) for i in (0, 8, 16))
                want[h1, h2] = cls
        return np.array([want.pop((int(x), int(y)), -1) if n else -1 for x, y, n in zip(*self.keys(), self.n, strict=True)], np.int64)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in slices(batch, "text"):
                s = Shingles(pa.table(own.columns, names=own.schema.names), width)
                h1, h2 = s.keys()
                yield pa.RecordBatch.from_arrays([own["shard"], own["nameless"], own["id"], own["said"], pa.array(s.n, pa.int64()), pa.array(h1), pa.array(h2)], [c.split()[0] for c in SETS.split(", ")])

    return run


def _ask_counts(width: int, buckets: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        s = Shingles(table, width)
        own = s.chosen(told)[s.doc] >= 0
        name, count = np.unique(s.hash[own] >> np.uint64(64 - BITS), return_counts=True)
        return X.requests(X.one_shard(table), buckets, BITS, name, count.astype(np.uint32))

    return run


def _answer_levels(table: pa.Table) -> pa.Table:
    """How often each shingle occurs, as a power of two; 0 if in one class only."""
    bucket = table["bucket"][0].as_py()
    shards, sizes, (name, count) = X.gathered(table)
    _, member = np.unique(name, return_inverse=True)
    level = np.floor(np.log2(np.bincount(member, count))).astype(np.uint8)[member]
    ends = np.cumsum(sizes)
    return X.replies([(s, bucket, LEVELS, pack(np.arange(b - a), level[a:b])) for s, a, b in zip(shards, ends - sizes, ends, strict=True)])


def prefix_length(n: int, percent: int) -> int:
    """So many of a set's rarest shingles must meet those of any partner."""
    return n - -(-percent * n // 100) + 1


def early_length(n: int, percent: int) -> int:
    """So many of a set's rarest shingles must meet the prefix of any partner that is not smaller."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _candidates(width: int, percent: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        s = Shingles(table, width)
        cls = s.chosen(told)
        own = cls[s.doc] >= 0
        h, doc = s.hash[own], s.doc[own]
        names, member = np.unique(h >> np.uint64(64 - BITS), return_inverse=True)
        _, level = X.joined(X.answers(told, LEVELS), np.int64, np.uint8)
        if len(level) != len(names):
            raise RuntimeError(f"{len(level)} answers to {len(names)} questions")
        level = level[member]
        order = np.lexsort((h, level, doc))  # rarest first
        level, h = level[order], h[order]
        first = np.searchsorted(doc, np.arange(table.num_rows + 1))
        rows = []
        for i in np.flatnonzero(cls >= 0):
            a, b = first[i], first[i + 1]
            alone, m = int((level[a:b] == 0).sum()), prefix_length(int(b - a), percent)
            if alone < m:
                rows.append((int(cls[i]), int(b - a), pack(np.arange(b - a - alone), h[a + alone : b], level[a + alone : b]), h[a + alone : a + m].view(np.int64), max(0, early_length(int(b - a), percent) - alone)))
        cols = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
        return pa.table({"cls": pa.array(cols[0], pa.int64()), "n": pa.array(cols[1], pa.int64()), "tokens": pa.array(cols[2], pa.binary()), "prefix": pa.array(cols[3], pa.list_(pa.int64())), "early": pa.array(cols[4], pa.int32())})

    return run


# --- the trie of one block ----------------------------------------------------


class Node:
    """A compressed path: its tokens, the sets that end here, and the sizes of those below."""

    __slots__ = ("tokens", "children", "ends", "least", "most", "some", "one")

    def __init__(self, tokens: np.ndarray, some: int, size: int):
        self.tokens, self.children, self.ends = tokens, {}, []
        self.least = self.most = size
        self.some, self.one = some, True  # a set below; whether all below were seen connected


class Trie:
    def __init__(self, sizes: np.ndarray):
        self.root = Node(np.zeros(0, np.int64), -1, 0)
        self.root.least, self.sizes = 1 << 60, sizes

    def insert(self, k: int, tokens: np.ndarray, find) -> None:
        node, size = self.root, int(self.sizes[k])
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if node.some < 0:
                node.some = k
            elif node.one and find(node.some) != find(k):
                node.one = False
            if not len(tokens):
                node.ends.append(k)
                return
            child = node.children.get(int(tokens[0]))
            if child is None:
                child = node.children[int(tokens[0])] = Node(tokens, k, size)
                child.ends.append(k)
                return
            m = min(len(child.tokens), len(tokens))
            differ = child.tokens[:m] != tokens[:m]
            m = int(differ.argmax()) if differ.any() else m
            if m < len(child.tokens):  # split the path
                upper = Node(child.tokens[:m], child.some, child.most)
                upper.least, upper.one = child.least, child.one
                upper.children[int(child.tokens[m])] = child
                child.tokens = child.tokens[m:]
                node.children[int(tokens[0])] = child = upper
            node, tokens = child, tokens[m:]

    def probe(self, k: int, tokens: np.ndarray, mark: np.ndarray, percent: int, find, union) -> None:
        """Connect set k with one set at least of every component in the trie that it links to."""
        n, own = int(self.sizes[k]), len(tokens)
        mark[tokens] = True

        def visit(node: Node, overlap: int, depth: int) -> None:
            if node.one and node.some >= 0 and find(node.some) == find(k):
                return
            if len(node.tokens):
                overlap += int(np.count_nonzero(mark[node.tokens]))
                depth += len(node.tokens)
                left = own - int(np.searchsorted(tokens, node.tokens[-1], side="right"))
                if 100 * node.most < (100 + percent) * (depth - overlap) + percent * n or (100 + percent) * (overlap + left) < percent * (n + node.least):
                    return
            for s in node.ends:
                if (100 + percent) * overlap >= percent * (n + int(self.sizes[s])):
                    union(k, s)
            for child in node.children.values():
                visit(child, overlap, depth)
            if not node.one and node.some >= 0:
                home = find(node.some)
                node.one = all(find(s) == home for s in node.ends) and all(c.one and find(c.some) == home for c in node.children.values())

        visit(self.root, 0, 0)
        mark[tokens] = False

    def linked(self, k: int, tokens: np.ndarray, mark: np.ndarray, percent: int) -> list[int]:
        """All sets in the trie that set k links to."""
        n, own, out = int(self.sizes[k]), len(tokens), []
        mark[tokens] = True
        todo = [(self.root, 0, 0)]
        while todo:
            node, overlap, depth = todo.pop()
            if len(node.tokens):
                overlap += int(np.count_nonzero(mark[node.tokens]))
                depth += len(node.tokens)
                left = own - int(np.searchsorted(tokens, node.tokens[-1], side="right"))
                if 100 * node.most < (100 + percent) * (depth - overlap) + percent * n or (100 + percent) * (overlap + left) < percent * (n + node.least):
                    continue
            out += [s for s in node.ends if (100 + percent) * overlap >= percent * (n + int(self.sizes[s]))]
            todo += [(child, overlap, depth) for child in node.children.values()]
        mark[tokens] = False
        return out


def _paths(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of a block: the sets' sizes, their tokens as ascending ranks, the most frequent first, and room for marks."""
    blobs = [unpack(x) for x in table["tokens"].to_pylist()]
    h, level = (np.concatenate([b[i] for b in blobs]) for i in (1, 2))
    order = np.lexsort((h, -level.astype(np.int16)))  # most frequent first
    new = np.append(True, h[order][1:] != h[order][:-1])
    rank = np.empty(len(h), np.int64)
    rank[order] = np.cumsum(new) - 1
    ends = np.cumsum([len(b[0]) for b in blobs])
    return table["n"].to_numpy(), [np.sort(x) for x in np.split(rank, ends[:-1])], np.zeros(len(h) + 1, bool)


def _join_block(percent: int):
    """Rows (cls, label, n, tokens, probe) of a block: labels that links connect, as pairs."""

    def run(table: pa.Table) -> pa.Table:
        give_back()
        table = table.sort_by([("probe", "ascending"), ("n", "ascending"), ("cls", "ascending")])
        size, sets, mark = _paths(table)
        labels, member = np.unique(table["label"].to_numpy(), return_inverse=True)
        parent = np.arange(len(labels)).tolist()
        member = member.tolist()

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        def find(k: int) -> int:
            return root(member[k])

        def union(k: int, s: int) -> None:
            a, b = sorted((find(k), find(s)))
            parent[b] = a

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * len(sets) + 1000))  # a path has a node a set at most
        trie = Trie(size)
        for k, probe in enumerate(table["probe"].to_pylist()):
            trie.probe(k, sets[k], mark, percent, find, union)
            if not probe:
                trie.insert(k, sets[k], find)
        home = labels[[root(x) for x in range(len(labels))]]
        moved = home != labels
        return pa.table({"a": pa.array(labels[moved], pa.int64()), "b": pa.array(home[moved], pa.int64())})

    return run


def _count_block(percent: int):
    """(cls, links) of a trie and the sets that probe it: with how many rows of the other classes each set links."""

    def run(table: pa.Table) -> pa.Table:
        give_back()
        table = table.sort_by([("probe", "ascending"), ("n", "ascending"), ("cls", "ascending")])
        size, sets, mark = _paths(table)
        weight, links = table["rows"].to_numpy(), np.zeros(table.num_rows, np.int64)
        trie = Trie(size)
        for k, (probe, home) in enumerate(zip(table["probe"].to_pylist(), table["home"].to_pylist(), strict=True)):
            if probe or home:
                met = trie.linked(k, sets[k], mark, percent)
                links[k] += weight[met].sum()
                links[met] += weight[k]
            if not probe:
                trie.insert(k, sets[k], lambda _: 0)
        some = links > 0
        return pa.table({"cls": pa.array(table["cls"].to_numpy()[some], pa.int64()), "links": pa.array(links[some], pa.int64())})

    return run


# --- the join -------------------------------------------------------------------


def _linked(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that connect the labels of all blocks; sets: comp, block, cls, label, n, tokens, probe."""
    return sets.groupBy("comp", "block").applyInArrow(_join_block(percent), "a long, b long")


def _labelled(sets: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return sets.join(found, "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")


def meetings(candidates: DataFrame) -> DataFrame:
    """(cls, n, token, first): the shingles of each prefix; ``first``: among the early ones."""
    return candidates.select("cls", "n", "early", F.posexplode("prefix").alias("at", "token")).select("cls", "n", "token", (F.col("at") < F.col("early")).alias("first"))


def grouped(candidates: DataFrame, block_sets: int) -> DataFrame:
    """The candidates connected through prefixes, with their group ``comp``, its number of ``blocks`` and their ``block``.

    Of the sets that hold a shingle early the smallest is connected with all that are not smaller.
    """
    meet = meetings(candidates)
    least = meet.groupBy("token").agg(F.min(F.when(F.col("first"), F.struct("n", "cls"))).alias("least"), F.count("*").alias("sets")).where("sets > 1 AND least IS NOT NULL")
    edges = meet.join(least.select("token", F.col("least.n").alias("from"), F.col("least.cls").alias("b")), "token").where("n >= from AND cls != b")
    groups = components(edges.select(F.col("cls").alias("a"), "b").distinct()).select(F.col("node").alias("cls"), F.col("label").alias("comp"))
    sizes = groups.groupBy("comp").agg(F.ceil(F.count("*") / F.lit(block_sets)).cast("int").alias("blocks"))
    sets = candidates.join(groups.join(sizes, "comp"), "cls")
    return saved(sets.withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int")).withColumn("label", F.col("cls")).withColumn("probe", F.lit(False)))


def visits(sets: DataFrame, own: DataFrame) -> DataFrame:
    """(cls, other): the other blocks of its group that hold a set with which one of ``own`` can link; sets: see grouped."""
    held = meetings(sets).join(sets.select("cls", "comp", "block"), "cls")
    there = held.groupBy("comp", "token", F.col("block").alias("other")).agg(F.max("n").alias("most"), F.min(F.when(F.col("first"), F.col("n"))).alias("least"))
    mine = held.join(own.select("cls"), "cls", "left_semi")
    meet = (F.col("first") & (F.col("n") <= F.col("most"))) | (F.col("least") <= F.col("n"))
    return mine.join(there, ["comp", "token"]).where((F.col("block") != F.col("other")) & meet).select("cls", "other").distinct()


def count_links(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(cls, links): with how many rows of other classes the classes link; each pair is met in the trie of its lower block."""
    plain = sets.drop("label", "prefix", "early").join(classes.select("cls", "rows"), "cls")
    run = lambda c: F.floor(F.col(c) / PROBING).cast("int")
    hot = sets.where("blocks > 1")
    lower = saved(visits(hot, hot).join(hot.select("cls", "comp", "block"), "cls").where("other < block"))
    probes = plain.join(lower.select("cls", "other", run("block").alias("run")), "cls").withColumn("block", F.col("other")).drop("other").withColumn("probe", F.lit(True)).withColumn("home", F.lit(False))
    away = lower.select("comp", F.col("other").alias("block"), run("block").alias("run")).where(F.col("run") != run("other")).distinct()
    own = plain.withColumn("run", run("block")).withColumn("home", F.lit(True))
    tries = own.unionByName(plain.join(away, ["comp", "block"]).withColumn("home", F.lit(False)))
    met = tries.unionByName(probes).groupBy("comp", "block", "run").applyInArrow(_count_block(percent), "cls long, links long")
    return met.groupBy("cls").agg(F.sum("links").alias("links"))


def connect(sets: DataFrame, percent: int, block_sets: int) -> DataFrame:
    """(cls, label) of the candidates that link: components by trie joins, hot groups in several blocks; sets: see grouped."""
    plain = sets.drop("prefix", "early")
    links = saved(_linked(plain, percent))
    held = sets.where("blocks > 1")
    if held.isEmpty():
        return links.select(F.col("a").alias("cls"), F.col("b").alias("label"))
    hot = saved(_labelled(plain.where("blocks > 1"), links))
    # one set of each component meets those of the others
    few = hot.where("cls = label")
    size = few.groupBy("comp").agg(F.ceil(F.count("*") / F.lit(block_sets)).cast("int").alias("tries"))
    few = few.join(size, "comp").withColumn("block", F.pmod(F.xxhash64("cls", F.lit(1)), "tries").cast("int")).drop("tries")
    links = saved(links.unionByName(_linked(few, percent)))
    hot = saved(_labelled(hot, links))
    # the sets outside the largest component of their group traverse those of its tries that hold sets they can link with
    most = hot.groupBy("comp", "label").count().groupBy("comp").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
    outside = hot.join(most, "comp").where("label != largest").drop("largest")
    probes = outside.join(visits(held, outside), "cls").withColumn("block", F.col("other")).withColumn("probe", F.lit(True)).drop("other")
    links = saved(links.unionByName(_linked(hot.unionByName(probes), percent)))
    return components(links).select(F.col("node").alias("cls"), "label")


def with_id(docs: DataFrame) -> DataFrame:
    """``nameless``, ``id``: false and the doc_id, or for null, after all doc_ids, true and a number from the text."""
    id_ = F.col("doc_id").cast("long")
    return docs.withColumns({"nameless": id_.isNull(), "id": F.coalesce(id_, F.xxhash64("text"))})


def labelled_classes(docs: DataFrame, words: int, percent: int, block_sets: int, links: bool = False) -> tuple[DataFrame, DataFrame]:
    """(SETS of each row; h1, h2, n, rows, nameless, id and said of the first row, cls, label and, if asked for, links of each class); see with_id."""
    dealt = X.deal(docs)
    shards, buckets = dealt.frame.groupBy("shard"), dealt.buckets
    rows = with_id(docs.select("doc_id", "text")).withColumn("shard", X.shard_of(dealt.shards)).withColumn("said", F.xxhash64("text")).drop("doc_id")
    sets = saved(rows.mapInArrow(_sets(words), SETS))
    classes = sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("nameless", "id", "said", "shard")).alias("first"), F.count("*").alias("rows"))
    classes = saved(classes.select("h1", "h2", "n", "rows", "first.*", F.monotonically_increasing_id().alias("cls")))
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    chosen = classes.select("shard", F.lit(0).alias("bucket"), F.lit(CLASSES).alias("kind"), F.concat(*map(number, ("h1", "h2", "cls"))).alias("payload"))
    asked = shards.cogroup(chosen.groupBy("shard")).applyInArrow(_ask_counts(words, buckets), X.REQUEST)
    levels = asked.groupBy("bucket").applyInArrow(_answer_levels, X.REPLY)
    told = X.union([chosen, levels])
    candidates = saved(shards.cogroup(told.groupBy("shard")).applyInArrow(_candidates(words, percent), CANDIDATES))
    groups = grouped(candidates, block_sets)
    linked = classes.join(connect(groups, percent, block_sets), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    return sets, linked.join(saved(count_links(groups, classes, percent)), "cls", "left") if links else linked


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """Components of documents whose ``words``-word shingle sets have a Jaccard similarity of ``percent`` or more.

    Returns doc_id, n_shingles, component_id (the smallest doc_id that links
    reach, the document's own included).
    """
    sets, linked = labelled_classes(docs, words, percent, block_sets)
    least = linked.groupBy("label").agg(F.min(F.struct("nameless", "id")).alias("component"))
    named = linked.join(least, "label").select("h1", "h2", "n", "component")
    out = sets.join(named, ["h1", "h2", "n"], "left").withColumn("component", F.coalesce("component", F.struct("nameless", "id")))
    return out.select(_doc_id(), F.col("n").alias("n_shingles"), F.when(~F.col("component.nameless"), F.col("component.id")).alias("component_id"))


def _doc_id() -> Column:
    return F.when(~F.col("nameless"), F.col("id")).alias("doc_id")


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """doc_id, n_shingles and n_links of each row: how many other rows it links with, copies included."""
    sets, linked = labelled_classes(docs, words, percent, block_sets, links=True)
    counted = linked.select("h1", "h2", "n", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = sets.join(counted, ["h1", "h2", "n"], "left")
    return out.select(_doc_id(), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def distinct_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row of each component, with all columns: of the least doc_id and among its rows that of the least text hash; of rows with equal doc_id and text one.

    Texts without words are in no component; each stays.
    """
    sets, linked = labelled_classes(docs, words, percent, block_sets)
    least = linked.groupBy("label").agg(F.min(F.struct("nameless", "id", "said")).alias("first")).select("first.*")
    kept = least.unionByName(sets.where("n = 0").select("nameless", "id", "said")).distinct()
    rows = with_id(docs.select(F.struct("*").alias("row"), "doc_id", "text")).select("row", "nameless", "id", F.xxhash64("text").alias("said"))
    once = rows.join(kept, ["nameless", "id", "said"], "left_semi").withColumn("nth", F.row_number().over(Window.partitionBy("nameless", "id", "said").orderBy("id")))
    return once.where("nth = 1").select("row.*")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(spark.read.parquet(f"{sf_dir}/documents.parquet"))
