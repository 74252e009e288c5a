"""Language identification by nearest centroids.

A text becomes a vector of hashed letter n-grams (1 to 3 characters, words bounded by one
space), weighted by TF-IDF and normalised. For every label, spherical k-means on a bounded
sample of labelled rows (``FIT_ROWS`` per label, the classifier's only bound) gives several
centroids. The prediction is the label of the centroid with the highest cosine. Short texts have
fewer n-grams and lie further off, so likeness is divided by what the label's own rows, cut to
that many n-grams, reach (``BEGINNINGS``). A text that is then much further from its centroid
than nearly all rows of that label from theirs is rejected.

Every text is read whole, in pieces of bounded size whose counts add up.

Defined results: null text and text without a letter get ``und`` with score 0 and are
rejected; a fit without rows predicts ``und`` for all; rows with a null label are never
learned from; a tie goes to the label that sorts first; a null doc_id gives a null ``held_out`` and is not
learned from; repeated rows are predicted each; an empty table gives no rows; other columns come back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import per_worker

BUCKETS = 4096
CLUSTERS = 4
FIT_ROWS = 400  # labelled rows per label, the ones with the smallest hashes of their ids
BEGINNINGS = (6, 12, 25, 50, 100, 200, 400, 800)  # characters of the cut rows
CUT_ROWS = 32  # of a label's FIT_ROWS, those that are cut
REJECT_SHARE = 0.5  # of the likeness for their length that all but 1 % of a label's own rows reach
UNKNOWN = "und"
PIECE = 1 << 18


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """One row of n-gram counts per text; all zero without a letter."""
    letter = per_worker(("letters",), _letters)
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    start = 0
    while start < len(texts):  # runs of short texts, or one piece after another of a long one
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or "") <= PIECE) and stop - start < 64:
            size += len(texts[stop] or "")
            stop += 1
        if stop == start + 1 and size > PIECE:
            t = texts[start]
            for a in range(0, len(t), PIECE):  # two characters of overlap keep the n-grams across the cut
                _count([t[max(0, a - 2):a + PIECE]], letter, out[start:stop], 0 if a == 0 else 2)
        else:
            _count([t or "" for t in texts[start:stop]], letter, out[start:stop], 0)
        start = stop
    return out


def _count(texts: list[str], letter: np.ndarray, out: np.ndarray, seen: int) -> None:
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in low])
    code = np.where(letter[code], code, 32)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (row[1:] != row[:-1])
    code, row = code[keep], row[keep]
    first = seen + 1 if seen else 0
    cells = []
    for n, salt in ((1, 0x9E3779B1), (2, 0x85EBCA6B), (3, 0xC2B2AE35)):
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = np.zeros(m, dtype=np.uint64)
        for j in range(n):
            h = (h ^ code[j:j + m].astype(np.uint64)) * np.uint64(0x100000001B3) + np.uint64(salt)
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(52)
        ok = row[:m] == row[n - 1:n - 1 + m]
        if n == 1:
            ok = ok & (code != 32)  # no letter: no n-gram at all
        else:
            inner = (code[:m] != 32) | (code[1:1 + m] != 32)
            ok = ok & inner
        if first:
            ok[:max(0, min(first - n + 1, m))] = False
        cells.append(row[:m][ok] * BUCKETS + h[ok].astype(np.int64))
    flat = np.concatenate(cells) if cells else np.empty(0, np.int64)
    out += np.bincount(flat, minlength=out.size).reshape(out.shape)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _centroids(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means, started from rows spread evenly by their likeness to the mean; deterministic."""
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    k = min(k, len(x))
    picked = [int(order[(2 * j + 1) * len(x) // (2 * k)]) for j in range(k)]
    c = x[picked].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].mean(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def sizes(counts: np.ndarray) -> np.ndarray:
    """ln of the number of distinct n-grams."""
    return np.log(np.maximum((counts > 0).sum(axis=1), 1))


def fit(docs: DataFrame, learn: Column, rows_per_label: int = FIT_ROWS, clusters: int = CLUSTERS) -> dict:
    """Model from ``rows_per_label`` rows of each non-null lang among the rows where ``learn`` holds.

    What reaches the driver is bounded by labels x (rows_per_label + CUT_ROWS x beginnings) x BUCKETS counts."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    at = F.xxhash64(F.lit(3), F.col("doc_id").cast("string"))
    ids = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per label
    if not ids:
        return {"labels": [], "idf": np.ones(BUCKETS, np.float32), "centroids": np.zeros((0, BUCKETS), np.float32),
                "owner": np.zeros(0, np.int64), "least": np.zeros(0, np.float32), "usual": []}
    # hashes are uniform: a threshold per label keeps about twice the rows wanted, the exact cut follows
    share = {r["lang"]: min(1.0, 2.0 * rows_per_label / r["n"]) for r in ids}
    low = -(1 << 63)
    limit = F.lit(low)
    for lang, p in share.items():
        limit = F.when(F.col("lang") == lang, F.lit(min((1 << 63) - 1, int(low + p * ((1 << 64) - 1))))).otherwise(limit)
    near = rows.select("lang", at.alias("h"), "text").where(F.col("h") <= limit)

    def count(batches):
        for b in batches:
            rows = []  # lang, h, characters (0: all), text
            for lang, h, r, t in zip(*(b.column(i).to_pylist() for i in range(4))):
                rows.append((lang, h, 0, t))
                rows += [(lang, h, n, t[:n]) for n in BEGINNINGS if r <= CUT_ROWS and len(t) > n]
            for a in range(0, len(rows), 256):
                langs, hs, ns, texts = zip(*rows[a:a + 256])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(hs, pa.int64()), pa.array(ns, pa.int32()),
                     pa.array([x.astype("<u4").tobytes() for x in gram_counts(texts)], pa.binary())], names=["lang", "h", "part", "counts"])

    best = Window.partitionBy("lang").orderBy("h")
    got = (near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= rows_per_label)
           .select("lang", "h", "r", F.col("text").cast("string")).mapInArrow(count, "lang string, h long, part int, counts binary").collect())
    got = sorted(got, key=lambda r: (r["lang"], r["h"], r["part"]))
    labels = sorted({r["lang"] for r in got})
    counts = np.stack([np.frombuffer(r["counts"], "<u4").astype(np.float32) for r in got])
    lang, part = np.array([labels.index(r["lang"]) for r in got]), np.array([r["part"] for r in got])
    some = counts.sum(axis=1) > 0
    cut, cut_lang, cut_part = (x[some & (part > 0)] for x in (counts, lang, part))
    counts, lang = (x[some & (part == 0)] for x in (counts, lang))
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = weighted(counts, idf).astype(np.float32)
    cs, owner, least, usual = [], [], [], []
    for i in range(len(labels)):
        own = x[lang == i]
        usual.append(((0.0,), (1.0,)))
        if not len(own):
            continue
        c = _centroids(own, clusters)
        near_own, size = (own @ c.T).max(axis=1), sizes(counts[lang == i])
        # medians of size and likeness: whole rows, and beginnings of some; by size
        points = [(float(np.median(size)), float(np.median(near_own)))]
        for n in BEGINNINGS:
            begun = cut[(cut_lang == i) & (cut_part == n)]
            if len(begun):
                points.append((float(np.median(sizes(begun))), float(np.median((weighted(begun, idf) @ c.T).max(axis=1)))))
        usual[i] = tuple(zip(*sorted(points)))
        cs += list(c)
        owner += [i] * len(c)
        least += [REJECT_SHARE * float(np.quantile(near_own / np.interp(size, *usual[i]), 0.01))] * len(c)
    return {"labels": labels, "idf": idf, "centroids": np.array(cs, np.float32).reshape(-1, BUCKETS),
            "owner": np.array(owner, np.int64), "least": np.array(least, np.float32), "usual": usual}


def predict(model: dict, texts: list[str | None]) -> pd.DataFrame:
    out = {"lang_pred": [], "score": [], "rejected": []}
    labels, owner, least = model["labels"], model["owner"], model["least"]
    for a in range(0, len(texts), 256):
        counts = gram_counts(texts[a:a + 256])
        some = (counts.sum(axis=1) > 0) & (len(owner) > 0)
        if len(owner):
            near = weighted(counts, model["idf"]) @ model["centroids"].T
            best = np.argmax(near, axis=1)
            score = np.clip(near[np.arange(len(best)), best], 0, 1)
            likely = np.array([s / np.interp(n, *model["usual"][owner[b]]) for s, n, b in zip(score, sizes(counts), best)])
            out["lang_pred"] += [labels[owner[b]] if s else UNKNOWN for b, s in zip(best, some)]
            out["rejected"] += [not s or bool(v < least[b]) for b, s, v in zip(best, some, likely)]
            out["score"] += np.where(some, score, 0.0).astype(float).tolist()
        else:
            out["lang_pred"] += [UNKNOWN] * len(counts)
            out["rejected"] += [True] * len(counts)
            out["score"] += [0.0] * len(counts)
    return pd.DataFrame(out)


def language_of(docs: DataFrame, model: dict, name: str = "language") -> DataFrame:
    """All columns and a struct ``name``: lang_pred, score, rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # labels x clusters x BUCKETS numbers

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield predict(sent.value, [t if isinstance(t, str) else None for t in b])

    return docs.withColumn(name, guess(F.col("text").cast("string")))


def learned_rows() -> Column:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
