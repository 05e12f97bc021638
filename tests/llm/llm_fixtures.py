"""A small table with every awkward row, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, n_words long, shard string, row string, label string"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(text or "")


def alnum(text: str | None) -> list[str]:
    return ALNUM_WORD.findall(lower(text or ""))


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def awkward_texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, periodic, empty, null, long and non-ASCII texts; null ids and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "é", "über", "naïve", "東方", "a", "Stone", "STONE", "run;", "x" * 30, "fin.", "—"]
    vocabulary += ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(60)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passages = [make(60), make(25), make(14)]
    base = make(90)
    texts: list[str | None] = [make(rng.randint(1, 120)) for _ in range(14)]
    texts += [base] * 5
    for _ in range(12):
        w = base.split(" ")
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    for _ in range(8):
        texts.append(f"{make(rng.randint(0, 20))}\n{rng.choice(passages)}\t{make(rng.randint(0, 20))} {rng.choice(passages)}")
    texts += ["", "   \n\t ", None, "one", "one two three", "One two  three", "again " * 150, "ab" * 400, "ab" * 400, "é" * 130, make(3000), "a\x00b c", "  lead and trail  "]
    ids: list[int | None] = rng.sample(range(-3, 500), len(texts))
    rows = list(zip(ids, texts, strict=True))
    rows += [rows[3], rows[20], (None, None), (None, base), (None, make(40))]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """Rows with columns whose names clash with those that the operators use."""
    return spark.createDataFrame([(i, t, "en", 7, "s", "r", "l") for i, t in rows], SCHEMA)


NULL_LAST = 1 << 63


def brute_substring(rows, width: int = 13):
    first: dict[tuple, int] = {}
    key = lambda i: NULL_LAST if i is None else i
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            first[g] = min(first.get(g, NULL_LAST + 1), key(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < key(i):
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def brute_suffix(rows, length: int = 100):
    """Rows of a doc_id are one document in the order of their texts."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0], rows[r][1] or ""))
    seen: set[bytes] = set()
    out = {}
    for r in order:
        b = (rows[r][1] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if s in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[r] = (rows[r][0], len(b), sum(gone), spans, sha(kept))
    return [out[r] for r in range(len(rows))]


def shingles(text: str | None, width: int = 4) -> frozenset:
    w = words(lower(text or ""))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def brute_components(rows, percent: int = 85, width: int = 4):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for r, (i, _) in enumerate(rows):
        if i is not None:
            least[find(r)] = min(least.get(find(r), i), i)
    return [(i, len(sets[r]), least.get(find(r))) for r, (i, _) in enumerate(rows)]
