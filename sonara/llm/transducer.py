"""BPE encoding and decoding with a lexicon compiled into a minimal acyclic transducer.

1. All pre-tokens of the corpus are counted by a Spark job; the most frequent ones become
   the lexicon (``LEXICON_WORDS``, a documented bound on what is sent to the executors).
2. The lexicon is compiled into an automaton with shared suffixes (states with equal futures
   are one state). Its transitions carry the number of words they skip, so the sum along a
   path is the word's ordinal, which points to the word's token ids.
3. Tasks write the automaton to an unnamed file and memory-map it. A batch's new pre-tokens
   walk it together, one byte per step; words outside it are merged exactly.

Decoding maps ids to bytes and reads them as UTF-8 (undecodable bytes become U+FFFD).

Defined results: null text encodes as the empty text; special token strings in a text become
their ids, as in the library's default; repeated rows count again for the lexicon and give a row each;
other columns are ignored; an empty corpus gives an empty lexicon, and texts are never cut.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bpe_files
from .common import per_worker, staged
from .rank_merge import Memo, RankMerger
from .token_counts import slices

LEXICON_WORDS = 50_000
MEMO_WORDS = 300_000


class ExactMerger:
    """Token ids of one lexicon word: the lowest-rank adjacent pair is merged until none is left."""

    def __init__(self, spec: dict):
        chars = bpe_files.byte_chars()
        self.start = [spec["vocab"][chars[b]] for b in range(256)]
        self.merges = spec["merges"]

    def __call__(self, word: bytes) -> list[int]:
        ids = [self.start[b] for b in word]
        find = self.merges.get
        while len(ids) > 1:
            best, at = None, -1
            for i, pair in enumerate(zip(ids, ids[1:])):
                m = find(pair)
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids


def compile_lexicon(words: list[bytes], ids: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of ``words`` and their ids as one block of arrays.

    Words are added in sorted order; as soon as a state can get no more transitions it is
    replaced by an equal one where the register holds one (equal: final, same transitions).
    """
    words = sorted(set(words))
    register: dict[tuple, int] = {}
    final: list[bool] = []
    count: list[int] = []  # words from a state on
    edges: list[tuple[tuple[int, int], ...]] = []

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(final)
            final.append(node[0])
            edges.append(key[1])
            count.append(int(node[0]) + sum(count[t] for _, t in key[1]))
        return register[key]

    path: list[list] = [[False, []]]  # open states of the last word: [final, settled transitions]
    last = b""
    for w in words:
        same = 0
        while same < min(len(w), len(last)) and w[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))
        path += [[False, []] for _ in w[same:]]
        path[-1][0] = True
        last = w
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(node)))
    root = settle(path[0])

    key, target, skip = [], [], []
    for s, out in enumerate(edges):
        before = int(final[s])
        for label, t in out:
            key.append(s * 256 + label)
            target.append(t)
            skip.append(before)
            before += count[t]
    flat = list(chain.from_iterable(ids[w] for w in words))
    bounds = np.cumsum([0, *(len(ids[w]) for w in words)])
    parts = [np.array(x, dtype=np.int64) for x in (key, target, skip, final, bounds, flat)]
    head = np.array([root, *map(len, parts)], dtype=np.int64)
    return b"".join(x.tobytes() for x in (head, *parts))


class Lexicon:
    """The compiled automaton, memory-mapped from an unnamed temporary file."""

    def __init__(self, block: bytes):
        self.file = tempfile.TemporaryFile()
        self.file.write(block)
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        whole = np.frombuffer(self.map, dtype=np.int64)
        self.root, ends = int(whole[0]), 7 + np.cumsum([0, *whole[1:7]])
        self.key, self.target, self.skip, self.final, self.bounds, self.flat = (
            whole[a:b] for a, b in zip(ends, ends[1:]))
        self.ids = self.flat.astype("<i4").tobytes()

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Each word's ordinal in the lexicon, -1 outside: all words take one byte a step."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        state = np.full(len(words), self.root, dtype=np.int64)
        total = np.zeros(len(words), dtype=np.int64)
        live = np.arange(len(words))
        step = 0
        out = np.full(len(words), -1, dtype=np.int64)
        while len(live) and len(self.key):
            at_end = lengths[live] == step
            ended = live[at_end]
            ended = ended[self.final[state[ended]] == 1]
            out[ended] = total[ended]
            live = live[~at_end]
            want = state[live] * 256 + flat[starts[live] + step]
            e = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[e] == want
            live, e = live[ok], e[ok]
            total[live] += self.skip[e]
            state[live] = self.target[e]
            step += 1
        return out


class Codec:
    """Encodes through the lexicon; keeps the ids of at most about ``MEMO_WORDS`` words seen."""

    def __init__(self, path: str, pattern: tuple, block: bytes):
        spec = bpe_files.load(path)
        chars = bpe_files.byte_chars()
        self.special = spec["special"]
        self.start = np.array([spec["vocab"][chars[b]] for b in range(256)], dtype=np.int64)
        self.merger = RankMerger(spec["merges"], max(spec["vocab"].values()) + 1)
        self.lexicon = Lexicon(block)
        self.find = bpe_files.finder(pattern)
        self.memo = Memo()
        back = {c: b for b, c in chars.items()}
        self.bytes_of = [b""] * (max([*spec["vocab"].values(), *self.special.values()]) + 1)
        for token, i in spec["vocab"].items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode("utf-8")

    def learn(self, new: list[str]) -> None:
        """Ids of new words: from the lexicon where it has them, else by merging, all of them at once."""
        raw = [w.encode("utf-8") for w in new]
        at = self.lexicon.ordinals(raw)
        block, bounds = self.lexicon.ids, self.lexicon.bounds
        for i in np.flatnonzero(at >= 0).tolist():
            self.memo[new[i]] = block[4 * bounds[at[i]]:4 * bounds[at[i] + 1]]
        unseen = np.flatnonzero(at < 0).tolist()
        if unseen:
            words = [raw[i] for i in unseen]
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            sym, left = self.merger.merge(self.start[np.frombuffer(b"".join(words), dtype=np.uint8)], lengths)
            block, ends, a = sym.astype("<i4").tobytes(), (4 * np.cumsum(left)).tolist(), 0
            for i, e in zip(unseen, ends):
                self.memo[new[i]] = block[a:e]
                a = e

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Arrays of token ids."""
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
            else:
                held.append(parts)
                open_.append(i)
        if new:
            self.learn(new)
            new.clear()
        for i in open_:
            held[i] = b"".join([p if p.__class__ is bytes else memo[p] for p in held[i]])
        return [np.frombuffer(b, dtype="<i4") for b in held]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, path: str, pattern: tuple, top: int) -> list[bytes]:
    """The most frequent pre-tokens of all texts, at most ``top``: all above a count are taken."""
    special = bpe_files.load(path)["special"]

    def run(batches):
        find, seen = bpe_files.finder(pattern), Counter()

        def flush():
            done = pa.RecordBatch.from_pydict({"word": pa.array([w.encode("utf-8") for w in seen], pa.binary()),
                                               "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return done

        for b in batches:
            for t in b.column(0).to_pylist():
                for p in bpe_files.split_specials(t or "", special)[::2]:
                    seen.update(find(p))
                if len(seen) > 300_000:
                    yield flush()
        yield flush()

    counts = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long")
              .groupBy("word").agg(F.sum("n").alias("n")))
    # the cut: counts in buckets an eighth of an octave wide, from the top as long as they fit
    counts = staged(counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "words")
    levels = {r["level"]: r["words"] for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect()}
    cut, room = max(levels, default=0) + 1, top
    for level in sorted(levels, reverse=True):
        room -= levels[level]
        if room < 0:
            break
        cut = level
    return [bytes(r["word"]) for r in counts.where(F.col("level") >= cut).select("word").collect()]


def encode_decode(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids (array of int), decoded text."""
    path = path or bpe_files.public_path("byte_bpe_50k.json")
    pattern = bpe_files.split_patterns()["spaced"]
    exact = ExactMerger(bpe_files.load(path))
    lexicon = frequent_words(docs, path, pattern, lexicon_words)
    block = docs.sparkSession.sparkContext.broadcast(compile_lexicon(lexicon, {w: exact(w) for w in lexicon}))

    block_id = uuid.uuid4().hex

    def run(batches):
        codec = per_worker(("codec", path, block_id), lambda: Codec(path, pattern, block.value))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s in slices(texts):
                ids = codec.encode(texts[s])
                sizes = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.start, s.stop - s.start),
                     pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat),
                     pa.array([codec.decode(x.tolist()) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
