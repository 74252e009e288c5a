"""Packing by concatenate and cut.

Pass 1 encodes every document, appends the end id and stages the ids with each document's
start inside its partition. The partitions' token totals (one row per task) get exclusive
prefix sums, which make the starts global. Pass 2 cuts the one long concatenation into fixed
windows; a document that crosses a boundary gets one record per window it touches.

All sequences but the last are full, so the padding is below one window in all.

Defined results: null text counts as empty (its only id is the end id); very long texts are
encoded whole and lie in as many windows as they need; repeated rows are packed again; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import bpe_files
from .common import per_worker, staged
from .rank_merge import Memo, RankMerger
from .token_counts import slices

WINDOW, END_ID = 1024, 0
BROADCAST_TASKS = 1_000_000  # totals are sent to all tasks up to so many rows (12 bytes each), else joined
MEMO_WORDS = 500_000


class Encoder:
    """Token ids of texts as byte arrays (little-endian unsigned 32-bit), new words merged in one go."""

    def __init__(self, path: str, pattern: tuple):
        spec = bpe_files.load(path)
        chars = bpe_files.byte_chars()
        self.special = spec["special"]
        self.start = np.array([spec["vocab"][chars[b]] for b in range(256)], dtype=np.int64)
        self.merger = RankMerger(spec["merges"], max(spec["vocab"].values()) + 1)
        self.find = bpe_files.finder(pattern)
        self.memo = Memo()

    def learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8") for w in new]
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        sym, left = self.merger.merge(self.start[np.frombuffer(b"".join(raw), dtype=np.uint8)], lengths)
        block, ends = sym.astype("<u4").tobytes(), (np.cumsum(left) * 4).tolist()
        at = 0
        for w, e in zip(new, ends):
            self.memo[w] = block[at:e]
            at = e

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_WORDS or self.memo.new:  # new: left behind by a run that broke off
            self.memo.clear()
            self.memo.new.clear()
        memo, held, open_ = self.memo, [], []
        get, new = memo.__getitem__, memo.new
        for i, t in enumerate(texts):
            parts, before = [], len(new)
            for piece in bpe_files.split_specials(t, self.special):
                if isinstance(piece, str):
                    parts += map(get, self.find(piece))
                else:
                    parts.append(piece.to_bytes(4, "little"))
            if len(new) == before and not open_:
                held.append(b"".join(parts))
            else:  # stand-ins, perhaps: once one text of the batch has a new word, later ones may repeat it
                held.append(parts)
                open_.append(i)
        if new:
            self.learn(new)
            new.clear()
        for i in open_:
            held[i] = b"".join([p if p.__class__ is bytes else memo[p] for p in held[i]])
        return held


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset: one row a piece."""
    path = path or bpe_files.public_path("byte_bpe_50k.json")
    pattern = bpe_files.split_patterns()["spaced"]
    end = int(end_id).to_bytes(4, "little")

    def encode(batches):
        encoder = per_worker(("byte_bpe", path), lambda: Encoder(path, pattern))
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s in slices(texts):
                ids = [x + end for x in encoder.encode(texts[s])]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                small = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids] if narrow else ids
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.start, s.stop - s.start), pa.array(np.full(len(n), part, np.int32)),
                     pa.array(starts), pa.array(n), pa.array(small, pa.binary())],
                    names=["doc_id", "part", "start_in_part", "n", "ids"])

    spec = bpe_files.load(path)
    narrow = max([*spec["vocab"].values(), *spec["special"].values(), end_id]) < 1 << 16  # staged ids in two bytes
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = staged(rows.mapInArrow(encode, f"doc_id {kind}, part int, start_in_part long, n long, ids binary"), "packing")

    # one row per task: the exclusive prefix sums make partition starts global
    totals = staged(ids.groupBy("part").agg(F.sum("n").alias("total")), "totals")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_TASKS:
        bases = F.broadcast(bases)
    placed = ids.join(bases, "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("at"), "n", "ids")

    def cut(batches):
        for b in batches:
            docs_in, ats, ns, blocks = (b.column(i) for i in range(4))
            row, start, length, seq, out = [], [], [], [], []
            for i, (at, n, block) in enumerate(zip(ats.to_pylist(), ns.to_pylist(), blocks)):
                wide = block.as_buffer()
                if narrow:
                    wide = np.frombuffer(wide, "<u2").astype("<u4").tobytes()
                done = 0
                while done < n:
                    take = min(n - done, window - (at + done) % window)
                    row.append(i)
                    start.append(done)
                    length.append(take)
                    seq.append(at + done)
                    out.append(bytes(wide[4 * done:4 * (done + take)]))
                    done += take
            r = pa.array(row, pa.int32())
            where = np.array(seq, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [docs_in.take(r), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(out, pa.binary()),
                 ns.take(r), pa.array(where // window), pa.array(where % window)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long")
