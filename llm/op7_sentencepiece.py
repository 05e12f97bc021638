"""SentencePiece encoding and decoding through a table of distinct chunks.

In the model no piece holds a whitespace marker after another character (this is
checked when it is loaded), so no merge crosses from a word into the next marker.  A text is therefore cut before each run of markers into *marked words*,
each distinct one is segmented once, and the ids are joined back by position.
The table of distinct chunks belongs to a task and is bounded: beyond
``TABLE_CHUNKS`` entries it starts anew with those of the texts at hand, a
portion of ``PORTION_CHARS`` characters or one longer text.  (One table over the
whole corpus would need each word's position in a shuffle, several times the
input.)

Defined results: a null or empty text gives the end id alone and decodes to the
empty text; repeated rows are encoded each; a null doc_id stays null; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.rolling import give_back, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
TABLE_CHUNKS = 300_000
PORTION_CHARS = 1 << 20
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")
RESULT = "doc_id long, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTable:
    """Segments marked words, each distinct one once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        self.mark = [self.model.piece_to_id(MARK)]
        self.end = self.model.eos_id()
        self.table: dict[str, str] = {}  # marked word: its ids, in decimal

    def fill(self, chunks: set[str]) -> None:
        """Segment the chunks that the table lacks; the model itself puts a marker before its input."""
        new = [c for c in chunks if c not in self.table]
        if len(self.table) + len(new) > TABLE_CHUNKS:
            self.table.clear()
            new = list(chunks)
        for chunk, ids in zip(new, self.model.encode([c[1:] for c in new], num_threads=1), strict=True):
            self.table[chunk] = " ".join(map(str, ids if len(chunk) > 1 else self.mark))

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """Ids of each text with the end id, and the same as text."""
        cut = [marked_words(t) for t in texts]
        self.fill(set(chain.from_iterable(cut)))
        for chunks in cut:
            said = " ".join([*map(self.table.__getitem__, chunks), str(self.end)])
            yield list(map(int, said.split())), said


def marked_words(text: str) -> list[str]:
    """The text, with a marker before it and one for each space, cut before each run of markers."""
    if not text:
        return []
    text = MARK + text.replace(" ", MARK)
    if MARK + MARK in text or text[-1] == MARK:
        return CHUNKS.findall(text)
    return [MARK + word for word in text[1:].split(MARK)]


def portions(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of PORTION_CHARS characters together, or one longer text."""
    own: list[str] = []
    size = 0
    for text in texts:
        if own and size + len(text) > PORTION_CHARS:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    yield own


def _encode(path: str | None, keep_ids: bool, keep_texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(path or model_path())
        for batch in batches:
            for rows in slices(batch, "text", PORTION_CHARS):
                n, ids, texts, digests = [], [], [], ([], [])
                for own in portions([t or "" for t in rows["text"].to_pylist()]):
                    for own_ids, said in table.encode(own):
                        text = table.model.decode(own_ids)
                        n.append(len(own_ids))
                        ids.append(np.array(own_ids, np.int32) if keep_ids else None)
                        texts.append(text if keep_texts else None)
                        for x, data in zip(digests, (said, text), strict=True):
                            x.append(hashlib.sha256(data.encode()).hexdigest())
                if keep_ids:
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(np.concatenate(ids)))
                else:
                    lists = pa.nulls(len(n), pa.list_(pa.int32()))
                columns = [rows["doc_id"], pa.array(n, pa.int64()), lists, pa.array(texts, pa.string()), *(pa.array(x, pa.string()) for x in digests)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"])
                give_back()

    return run


def encode_texts(docs: DataFrame, path: str | None = None, keep: bool = True, keep_texts: bool | None = None) -> DataFrame:
    """Encode and decode every whole text.

    Returns doc_id, n_tokens, ids (null unless ``keep``), decoded (null unless
    ``keep_texts``, which follows ``keep`` if not given), ids_sha256 (of the decimal
    ids joined by one space) and decoded_sha256.  ``path``: the model's file, that
    of the installed vocabulary files if null.  Rows come out a portion at a time,
    with ids as 32-bit arrays, so a task holds the ids of one portion.
    """
    kept = keep if keep_texts is None else keep_texts
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(path, keep, kept), RESULT)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_texts(docs, keep=False).drop("ids", "decoded")
