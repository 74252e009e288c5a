"""Spelling variants, hard negatives and token files against brute force; long words, hot keys, several rounds and shards."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from embedding_rows import vectors
from pyspark.sql import functions as F

from sonara.llm import bpe_files, hard_negatives, spelling, wavelet
from sonara.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- spelling variants ----

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows):
    n = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            n[r if h % 97 else r[:h % len(r)] + r[h % len(r) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute_variants(n):
    near, meets = defaultdict(list), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            meets[w[:i] + "_" + w[i + 1:]].add(w)
            meets[w[:i] + w[i + 1:]].add(w)
        meets[w].add(w)
    for ws in meets.values():
        for a in ws:
            near[a] += [b for b in ws if b not in near[a] and one_edit(a, b)]
    form = {}
    for w, k in n.items():
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * k else None
    out = []
    for w, k in n.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w] or "", root, k, len(near[w]), n.get(form[w], 0)))
    return sorted(out)


def got_variants(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_spelling_query_on_edge_rows(spark, edge_dir, edge_rows):
    want = brute_variants(brute_counts([(i, t) for i, t, _ in edge_rows]))
    assert want and got_variants(QUERIES["op11_spelling_variants"](spark, edge_dir)) == want


def test_spelling_deletes_some_runs(spark):
    rows = [(i, "Straße ÉTÉ naïveté ×÷×÷× Colour colour COLOUR x_colour2colour") for i in range(400)] + [(None, "colour"), (7, "colour")]
    want = brute_variants(brute_counts(rows))
    assert any(w != "colour" and f == "colour" for w, f, *_ in want)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(0))
    assert got_variants(spelling.variants(spelling.word_counts(docs))) == want


def test_spelling_chains_hot_keys_and_long_words(spark):
    rng = random.Random(2)
    n = {"prefix" + "".join(rng.choice("abcde") for _ in range(3)) + "suffix": rng.randint(3, 50) for _ in range(140)}
    n |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaab": 24, "aaaaabab": 48}       # a chain
    n |= {"start" + a + b: 3 + i + j for i, a in enumerate("abcdefghijklmnop") for j, b in enumerate("abcdefghijklmnop")}  # over one tile
    long = "".join(rng.choice("abc") for _ in range(5000))
    n |= {long: 40, long[:777] + long[778:]: 5, long[:60] + "z" + long[61:]: 4, long + "q": 3, "q" + long: 3, long[::-1]: 9}
    n |= {w * 20: k for w, k in (("ab", 9), ("ba", 4))} | {"ab" * 19 + "a": 3, "ab" * 19 + "b": 3}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got_variants(spelling.variants(words)) == brute_variants(n)


def test_spelling_gap_of_sql_and_numpy_agree(spark):
    words = ["x" * k for k in (5, 31, 32, 33, 100, 257)]
    got = {(r["word"], r["m"]): r["k"] for r in
           spelling.gap_keys(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).groupBy("word", "m").agg(F.count("*").alias("k")).collect()}
    for w in words:
        for m in (len(w), len(w) + 1):
            assert got[w, m] == -(-m // int(spelling.gap(np.int64(m))))


# ---- hard negatives ----

def brute_negatives(rows, every=100, per=10, kind=np.float32):
    v = [(i, (x + 1) % 10 if i is not None and i % 7 == 0 else x, None if e is None else np.floor(256 * np.array(e, dtype=kind).astype(float)))
         for i, x, e in rows if x is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)]
    out = []
    last = lambda c: (-c[0], c[1] is None, c[1] or 0)
    for k, (a, label, q) in enumerate(v):
        if a is None or a % every:
            continue
        score = [int(sum(int(x) * int(y) for x, y in zip(q, p))) for _, _, p in v]
        same = sorted(((score[j], v[j][0]) for j in range(len(v)) if j != k and v[j][1] == label), key=last)[:5]
        for p, pid in same:
            other = sorted(((score[j], v[j][0]) for j in range(len(v)) if v[j][1] != label and 30 * p <= 100 * score[j] <= 90 * p), key=last)
            out += [(a, pid, r + 1, i, p, s) for r, (s, i) in enumerate(other[:per])]
    return out


NEG = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def as_text(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def test_hard_negatives_query_on_edge_rows(spark, edge_dir):
    got = [tuple(r[c] for c in NEG) for r in QUERIES["op12_hard_negatives"](spark, edge_dir).collect()]
    want = brute_negatives(vectors())
    assert len(want) > 200 and as_text(got) == as_text(want)


def test_hard_negatives_in_several_rounds_and_cut_hits(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, rng.randrange(3), [rng.gauss(0, 1) for _ in range(11)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    moved = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    want = as_text(brute_negatives(rows, every=20, kind=float))
    one = as_text([tuple(r[c] for c in NEG) for r in hard_negatives.mine(moved, F.col("vec_id") % 20 == 0).collect()])
    many = as_text([tuple(r[c] for c in NEG) for r in hard_negatives.mine(moved, F.col("vec_id") % 20 == 0, round_anchors=7).collect()])
    assert one == many == want and len(one) > 1000


def test_subset_sums_score_exactly():
    rng = np.random.default_rng(1)
    for scale, dims in ((1, 3), (200, 64), (40_000, 17), (1 << 40, 9)):
        a, c = rng.integers(-scale, scale, (6, dims)), rng.integers(-scale, scale, (50, dims))
        want = (c.astype(object) @ a.T.astype(object))
        got = hard_negatives.SubsetSums(a).score(hard_negatives.bit_planes(c))
        assert got.astype(object).tolist() == ((want + 2 ** 63) % 2 ** 64 - 2 ** 63).tolist()


def test_best_keeps_ties_by_id_and_respects_floors():
    best = hard_negatives.Best(2, 2, np.array([-5, 3]))
    best.add(np.array([0, 0, 0, 1]), np.array([7, 7, 7, 4]), np.array([9, 2, 5, 1]), np.zeros(4, bool), np.arange(4))
    best.cut()
    (slot, score, ids, _, _), = best.held
    assert list(zip(slot, score, ids)) == [(0, 7, 2), (0, 7, 5), (1, 4, 1)] and best.floor.tolist() == [7, 3]


# ---- token files ----

@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_files.public_path("word_bpe_49k.json"))


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (9, 2), (70_000, 49_410), (200_000, 300), (66_000, 1 << 20)])
def test_matrix_answers_like_the_array(n, top):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % top).astype(np.uint32)
    m = wavelet.WaveletMatrix(wavelet.build(ids))
    assert m.decode().tolist() == ids.tolist()
    for t in [0, 1, 2, 7, top - 1, top, 1 << 30]:
        at = np.flatnonzero(ids == t)
        assert m.count(t) == len(at) and m.find(t).tolist() == at.tolist()
        lo, hi = n // 3, n // 3 + n // 2
        assert m.count(t, lo, hi) == ((at >= lo) & (at < hi)).sum() and m.find(t, lo, hi).tolist() == at[(at >= lo) & (at < hi)].tolist()
        if len(at):
            assert m.select(t, len(at) // 2) == at[len(at) // 2]
    for i in rng.integers(0, max(1, n), 20) if n else []:
        assert m.access(int(i)) == ids[i]
    with pytest.raises(IndexError):
        m.access(n)


def test_a_query_opens_few_blocks():
    ids = (np.arange(3_000_000) * 7919 % 40_000).astype(np.uint32)
    m = wavelet.WaveletMatrix(wavelet.build(ids))
    assert m.access(1_234_567) == ids[1_234_567] and len(m.open) <= m.planes * 2
    assert m.planes * len(m.places[0]) > 20 * m.planes


def digest(tok, text):
    ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
    return len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_query_on_edge_rows(spark, edge_dir, edge_rows, word_bpe):
    got = QUERIES["op13_token_files"](spark, edge_dir).collect()
    want = sorted((str(i), *digest(word_bpe, t)) for i, t, _ in edge_rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda i: (i is not None, i or 0))


def test_files_of_small_shards_answer_queries(spark, word_bpe, tmp_dir):
    words = "alpha beta gamma <|endoftext|> delta 42 it's".split()
    rng = random.Random(4)
    rows = [(f"d{i:03}" if i % 3 else "hot", " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    docs.write.parquet(f"{tmp_dir}/docs")
    path = f"{tmp_dir}/files"
    wavelet.write_files(spark.read.parquet(f"{tmp_dir}/docs"), path, shard_tokens=500, partitions=5)
    files = list(Path(path).glob("*.parquet"))
    assert len(files) == spark.read.parquet(path).count() > 8     # a file per shard
    back = wavelet.read_ids(spark, path).collect()
    ids = {(r["doc_id"], r["start"]): np.frombuffer(r["ids"], "<u4").tolist() for r in back}
    assert sorted((k[0], v) for k, v in ids.items()) == sorted((i, [*word_bpe.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows)
    starts = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in back)
    assert [s for s, _, _ in starts] == np.cumsum([0, *(n for *_, n in starts)])[:-1].tolist()
    assert [d for _, d, _ in starts] == sorted(i for i, _ in rows)
    hot = Counter(r["part"] for r in spark.read.parquet(path).where("array_contains(doc_id, 'hot')").collect())
    assert len(hot) > 1                                             # one doc_id lies in several parts
    token = word_bpe.encode("gamma", add_special_tokens=False).ids[0]
    assert {(r["doc_id"], r["start"]): r["n"] for r in wavelet.count_token(spark, path, token).collect()} == \
        {k: v.count(token) for k, v in ids.items() if token in v}
    assert {(r["doc_id"], r["start"], r["position"]) for r in wavelet.find_token(spark, path, token).collect()} == \
        {(*k, p) for k, v in ids.items() for p, x in enumerate(v) if x == token}


def test_encoder_like_the_library_on_odd_text(word_bpe):
    rng = random.Random(8)
    odd = "aB é́ÅΣσς  \u0085\t\n\x1cİ'sDon't 12٣½ 😀ẞ<|startoftext|>​　ﬁ—…"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + ["", "ΑΣ ΑΣ.", "a" * 3000]
    enc = wavelet.WordEncoder(bpe_files.public_path("word_bpe_49k.json"), bpe_files.split_patterns()["bare"])
    got = enc.encode(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == word_bpe.encode(t, add_special_tokens=False).ids, repr(t)


def test_encoder_splits_no_known_word_again_and_forgets_by_generations(word_bpe, monkeypatch):
    rng = random.Random(5)
    odd = "aB é́ÅΣσς  \u0085\t\n\x1c\x1f　İ'sDon't 12٣½ 😀ẞ<|startoftext|>​　ﬁ—…!'s"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(900)] + ["it's, it's \x1d ok"]
    want = [word_bpe.encode(t, add_special_tokens=False).ids for t in texts]
    path, pattern = bpe_files.public_path("word_bpe_49k.json"), bpe_files.split_patterns()["bare"]
    enc = wavelet.WordEncoder(path, pattern)
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    enc.find = None  # before: the pattern ran over every text
    assert enc.encode(texts) == got
    monkeypatch.setattr(wavelet, "MEMO_WORDS", 60)
    enc = wavelet.WordEncoder(path, pattern)
    assert [x for i in range(0, len(texts), 30) for x in enc.encode(texts[i:i + 30])] == got
    assert len(enc.memo) + len(enc.memo.before) < 1500


def test_merge_table_finds_each_pair_and_no_other():
    from sonara.llm.rank_merge import RankMerger

    r = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in r.integers(0, 300, (20_000, 2))})
    m = RankMerger({p: (i, i) for i, p in enumerate(pairs)}, 300)
    a, b = np.divmod(np.arange(300 * 300), 300)
    index = {p: i for i, p in enumerate(pairs)}
    assert m._lookup(a, b).tolist() == [index.get(p, -1) for p in zip(a.tolist(), b.tolist())]
    assert len(m.cells) >= 8 * len(pairs)
