"""Spelling variant grouping by dense prefix-suffix tiling.

Words are counted over whole texts. Two words that are one inserted, deleted or replaced code
point apart share a common prefix and a common suffix that together reach the longer length
minus one. So with the longer length ``m`` cut into gaps of ``gap(m)`` positions, the pair agrees
on all that lies before and behind the gap its first difference falls in: (m, gap, what lies
around it) is a key the two share. Up to 32 letters a gap has two positions, so a key holds at
most 90^2 + 90 words; longer words have at most 17 gaps each.

Inside a task the words of a key are rows of padded code-point matrices, one of the words and one
of the words reversed. Blocks of at most ``TILE`` rows are compared pair by pair, small keys
many at a time: the first difference in either matrix gives the prefix and the suffix length. A
pair counts only under the key of its first difference, so no pair is found twice. Counts and the
best neighbour are summed up in the task; pairs are never written.

Defined results: null and empty texts have no words; a null doc_id counts as the empty text in
the deletion hash; repeated rows count again; equal counts are settled by the smaller word in
code-point order; very long texts and words are taken whole; an empty table, or one without a word
often enough, gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged

LETTERS = "A-Za-zÀ-ÿ"
FLUSH_WORDS = 400_000   # distinct words a task holds before it hands on their counts
BATCH_ROWS = 50_000     # key rows compared together; a key is never parted
TILE = 64
TILE_CELLS = 1 << 22    # compared code points held at once
GAP, MAX_GAPS = 2, 16


def gap(m):
    """Positions of a gap for the longer length ``m`` (numbers or arrays)."""
    return np.maximum(GAP, -(-m // MAX_GAPS))


def word_counts(docs: DataFrame, min_chars: int = 5, min_count: int = 3, drop_one_in: int = 97) -> DataFrame:
    """word, n: runs of letters with A-Z lower-cased, one code point of some of them deleted (``drop_one_in``
    divides the CRC-32 of ``<doc_id>:<run>``); words of ``min_chars`` code points seen ``min_count`` times."""
    letters = LETTERS.replace("A-Z", "")

    def count(batches):
        find, crc = re.compile(f"[{letters}]{{{min_chars},}}").findall, zlib.crc32
        held = Counter()

        def flush():
            words = [w for w in held if len(w) >= min_chars]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                runs = find(text.as_buffer().to_pybytes().lower().decode("utf-8")) if text.is_valid else []
                head = crc(f"{doc}:".encode())
                changed = {}
                for r in set(runs):
                    h = crc(r.encode(), head)
                    if h % drop_one_in == 0:
                        changed[r] = r[:h % len(r)] + r[h % len(r) + 1:]
                held.update([changed.get(r, r) for r in runs] if changed else runs)
                if len(held) >= FLUSH_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def gap_keys(words: DataFrame) -> DataFrame:
    """m, g, h, word, n: one row per word, longer length (its own or one more) and gap."""
    size = F.length("word")
    by_class = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    wide = F.greatest(F.lit(GAP), F.ceil(F.col("m") / MAX_GAPS)).cast("int")
    by_gap = by_class.select("word", "n", "m", wide.alias("w"),
                             F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / wide).cast("int"))).alias("g"))
    around = F.expr("xxhash64(substring(word, 1, g * w), right(word, m - least((g + 1) * w, m)))")
    return by_gap.select("m", "g", around.alias("h"), "word", "n")


def _blocks(starts: np.ndarray, sizes: np.ndarray):
    """(width, left rows, right rows, equal): the block pairs of all keys, stacked by width; -1 pads."""
    for width in (2, 4, 8, 16, 32, TILE):
        low = width // 2 if width > 2 else 1
        mine = (sizes > low) & (sizes <= width)
        at = np.arange(width)
        if mine.any():
            s, n = starts[mine], sizes[mine]
            rows = np.where(at < n[:, None], s[:, None] + at, -1)
            yield width, rows, rows, True
    at = np.arange(TILE)
    for s, n in zip(starts[sizes > TILE], sizes[sizes > TILE]):
        first = s + TILE * np.arange(-(-n // TILE))
        rows = first[:, None] + at
        rows[rows >= s + n] = -1
        yield TILE, rows, rows, True
        for i in range(len(first) - 1):
            rest = rows[i + 1:]
            yield TILE, np.broadcast_to(rows[i], rest.shape), rest, False


def _matrix(texts: list[str]) -> np.ndarray:
    """Code points, one row per text, padded with 0."""
    padded = np.array(texts, dtype="U")
    codes = padded.view(np.uint32).reshape(len(texts), -1)
    return codes.astype(np.uint8) if codes.max() < 256 else codes


def near_pairs(words: list[str], m: np.ndarray, g: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (left, right) of the pairs one edit apart, each under its canonical key. Rows of a
    key are adjacent, keys begin at ``starts`` and ascend in ``m``."""
    sizes = np.diff(np.append(starts, len(words)))
    length = np.array([len(w) for w in words], dtype=np.int64)
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    place = np.zeros(len(words) + 1, dtype=np.int64)
    for c, left, right, equal in _blocks(starts[sizes > 1], sizes[sizes > 1]):
        k, cells = 0, c * c * m[left[:, 0]].astype(np.int64)
        while k < len(left):
            end = min(len(left), k + max(1, TILE_CELLS // int(cells[k])))
            end = k + max(1, min(end - k, TILE_CELLS // int(cells[end - 1])))  # wider words follow
            a, b, k = left[k:end], right[k:end], end
            rows = np.unique(a if equal else np.append(a, b))
            rows = rows[rows >= 0]
            place[rows] = np.arange(len(rows))
            texts = [words[r] for r in rows]
            ahead, back = _matrix(texts), _matrix([t[::-1] for t in texts])
            # words of a key are distinct, so some column differs in every pair that counts
            prefix = (ahead[place[a]][:, :, None, :] == ahead[place[b]][:, None, :, :]).argmin(axis=-1)
            cls, at = (x[a[:, 0]][:, None, None] for x in (m, g))
            ok = (a >= 0)[:, :, None] & (b >= 0)[:, None, :]
            if equal:
                ok &= np.triu(np.ones((c, c), dtype=bool), 1)
            ok &= (np.maximum(length[a][:, :, None], length[b][:, None, :]) == cls) & (prefix // gap(cls) == at)
            t, i, j = np.nonzero(ok)
            i, j, p = a[t, i], b[t, j], prefix[t, i, j]
            suffix = (back[place[i]] == back[place[j]]).argmin(axis=-1)
            hit = p + suffix >= m[i] - 1
            lefts.append(i[hit])
            rights.append(j[hit])
    return np.concatenate(lefts), np.concatenate(rights)


def _neighbours(batches):
    """(word, near, neg_n, form) from rows sorted by key; the last key of a batch waits for the next batch."""
    def solve(t):
        m, g, h, n = (t.column(c).to_numpy() for c in ("m", "g", "h", "n"))
        words = t.column("word").to_pylist()
        starts = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])))
        i, j = near_pairs(words, m, g, starts)
        src, dst = np.append(i, j), np.append(j, i)
        names = np.array([words[k] for k in dst], dtype="U") if len(dst) else np.empty(0, "U1")
        order = np.lexsort((names, -n[dst], src))
        src, dst = src[order], dst[order]
        first = np.flatnonzero(np.append(True, src[1:] != src[:-1])) if len(src) else np.empty(0, np.int64)
        near = np.diff(np.append(first, len(src)))
        return pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in src[first]], pa.string()), pa.array(near, pa.int64()),
             pa.array(-n[dst[first]], pa.int64()), pa.array([words[k] for k in dst[first]], pa.string())],
            names=["word", "near", "neg_n", "form"])

    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < BATCH_ROWS:
            continue
        t = pa.Table.from_batches(held)
        m, g, h = (t.column(c).to_numpy() for c in ("m", "g", "h"))
        cut = np.flatnonzero((m[1:] != m[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1]))
        if len(cut):
            last = int(cut[-1]) + 1
            yield solve(t.slice(0, last).combine_chunks())
            held, rows = t.slice(last).to_batches(), t.num_rows - last
    if rows:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of distinct words and their counts."""
    words = staged(words.select("word", "n"), "words")
    keys = gap_keys(words).repartition("m", "g", "h").sortWithinPartitions("m", "g", "h")
    found = keys.mapInArrow(_neighbours, "word string, near long, neg_n long, form string")
    best = (found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("neg_n", "form")).alias("b"))
            .select("word", "n_near", (-F.col("b.neg_n")).alias("near_n"), "b.form"))
    takes = F.col("near_n") >= times * F.col("n")
    forms = staged(words.join(best, "word", "left").select(
        "word", F.when(takes, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("near_n")).alias("form_n")), "forms")
    return (forms.join(roots(forms), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the words with a form: each round follows every pointer twice as far. A form counts at
    least twice its word, so there are no rings, and rounds grow with the log of the longest chain."""
    at = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        at = staged(at.join(ahead, "root", "left").select("word", F.coalesce("__next", "root").alias("root"),
                                                          F.col("__next").isNotNull().alias("moved")), "roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")
        at = at.select("word", "root")
