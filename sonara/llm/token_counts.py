"""Token counts by rank-synchronous array merging.

A text is normalised (NFC, white space, lower case) and split as its vocabulary file says;
the batch's distinct pre-tokens that no earlier batch had are held as ragged numpy arrays and
merged together (``rank_merge``); a document's count is the sum over its pre-tokens. Special
token strings in a text are one token each, as in the library's default.

Defined results: null or empty text has 0 tokens; repeated rows are counted each; an empty table gives
no rows; every other column is ignored; texts of any length are taken whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bpe_files
from .common import per_worker
from .rank_merge import RankMerger

MEMO_WORDS = 500_000


class WordBpeCounter:
    """Counts the tokens of texts; keeps counts of at most ``MEMO_WORDS`` distinct pre-tokens."""

    def __init__(self, path: str, pattern: tuple):
        spec = bpe_files.load(path)
        vocab, self.special, suffix = spec["vocab"], spec["special"], spec["suffix"]
        chars = bpe_files.byte_chars()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[chars[b] + suffix] for b in range(256)], dtype=np.int64)
        self.merger = RankMerger(spec["merges"], max(vocab.values()) + 1)
        self.find = bpe_files.finder(pattern)
        self.space = re.compile(f"[{bpe_files.WHITE_SPACE}]+")
        self.memo: dict[str, int] = {}

    def pre_tokens(self, piece: str) -> list[str]:
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")  # one final form, as char by char
        return self.find(self.space.sub(" ", piece).lower())

    def learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8") for w in new]
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[flat[ends]]
        _, left = self.merger.merge(sym, lengths)
        self.memo.update(zip(new, left.tolist()))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        split, extra, new, known = [], [], set(), self.memo.__contains__
        for t in texts:
            pieces = bpe_files.split_specials(t, self.special)
            ws: list[str] = []
            for p in pieces[::2]:
                ws += self.pre_tokens(p)
            split.append(ws)
            extra.append(len(pieces) // 2)
            new.update(filterfalse(known, ws))
        if new:
            self.learn(list(new))
        get = self.memo.__getitem__
        return [sum(map(get, ws)) + x for ws, x in zip(split, extra)]


def slices(texts: list, limit: int = 4 << 20) -> Iterator[slice]:
    """Runs of rows of about ``limit`` characters: what is held at once does not follow the batch."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += 0 if t is None else len(t)
        if size >= limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    path = path or bpe_files.public_path("word_bpe_49k.json")
    pattern = bpe_files.split_patterns()["bare"]

    def run(batches):
        counter = per_worker(("word_bpe", path), lambda: WordBpeCounter(path, pattern))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            counts: list[int] = []
            for s in slices(texts):
                counts += counter.count(texts[s])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
