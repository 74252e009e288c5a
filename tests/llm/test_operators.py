"""Each operator's query against a brute-force version, on rows with nulls, empty and long texts,
ties, repeated rows and clashing column names; and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sonara.llm import bpe_files, gru_lm, html_template, lang_id, minhash, order_minhash, transducer
from sonara.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def run(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def same_rows(got, want, cols):
    key = lambda r: tuple(repr(r[c]) for c in cols)
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty_dir, name):
    assert run(spark, name, empty_dir) == []


def test_sharding(spark, edge_dir, edge_rows):
    got = run(spark, "op1_sharding", edge_dir)
    want = [{"doc_id": i, "size": len((t or "").encode()) + 1, "text_crc32": zlib.crc32((t or "").encode())} for i, t, _ in edge_rows]
    same_rows(got, want, ["doc_id", "size", "text_crc32"])
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16 for r in got)
    home = {}
    for r in got:
        assert home.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])


def test_sharding_splits_a_hot_id_over_buckets(spark, tmp_dir):
    from pyspark.sql import functions as F

    from sonara.llm import sharding

    rows = [(5 if i % 3 == 0 else None if i % 9 == 1 else i, "same text" if i % 2 else f"text {i} " * 8) for i in range(6000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    out = sharding.shuffle_into_shards(docs, 4, bucket_bytes=4000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    buckets = -(-total // (4 * 4000))
    place = F.pmod(F.xxhash64(F.lit(18), F.monotonically_increasing_id()), F.lit(buckets))
    sizes = [r["n"] for r in docs.groupBy(sharding.shard_of(F.col("doc_id"), 4).alias("s"), place.alias("b")).agg(F.count("*").alias("n")).collect()]
    hot = max(sizes)
    assert hot < 8 * 6000 / (4 * buckets)                    # 2,000 rows share a doc_id
    got = out.collect()
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    hot_slots = sorted(r["slot"] for r in got if r["doc_id"] == 5)
    assert hot_slots[-1] - hot_slots[0] > len(hot_slots)     # mixed with the shard's other rows


def test_written_shards_read_back(spark, edge_dir, tmp_dir):
    from sonara.llm import sharding

    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    sharding.write_shards(docs, f"{tmp_dir}/shards", 4)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    want = sharding.shuffle_into_shards(docs, 4)
    cols = ["doc_id", "text", "size", "shard", "slot", "grown_shard"]
    assert sorted(map(repr, back.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
    for s in range(4):   # the files of a shard, in name order, are its slots in order
        slots = [r["slot"] for r in spark.read.parquet(f"{tmp_dir}/shards/shard={s}").select("slot").collect()] if \
            want.where(f"shard = {s}").count() else []
        assert sorted(slots) == list(range(len(slots)))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {n: Tokenizer.from_file(bpe_files.public_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def test_bpe_codec(spark, edge_dir, edge_rows, library):
    tok, want = library["byte_bpe_50k.json"], []
    for i, t, _ in edge_rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want.append({"doc_id": i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     "decoded_sha256": hashlib.sha256(text.encode()).hexdigest()})
    same_rows(run(spark, "op2_bpe_codec", edge_dir), want, list(want[0]))


def test_lexicon_shares_suffixes_and_finds_every_word():
    words = [b"walking", b"talking", b"talk", b"walk", b"w"]
    block = transducer.compile_lexicon(words, {w: [len(w)] for w in words})
    lexicon = transducer.Lexicon(block)
    assert lexicon.ordinals(sorted(words)).tolist() == list(range(5))
    assert lexicon.ordinals([b"walkin", b"", b"x", b"walkings"]).tolist() == [-1] * 4
    assert len(lexicon.final) < sum(map(len, words))  # "alking" is stored once


def brute_groups(rows, size):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    return sets, [find(a) for a in range(len(rows))]


def test_near_duplicates(spark, edge_dir, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None]
    sets, group = brute_groups(rows, 4)
    low = {}
    for g, r in zip(group, rows):
        low[g] = min(low.get(g, r[0]), r[0])
    want = [{"doc_id": r[0], "n_shingles": len(s), "component_id": low[g], "kept": low[g] == r[0]} for r, s, g in zip(rows, sets, group)]
    got = [r for r in run(spark, "op3_minhash", edge_dir) if r["doc_id"] is not None]
    same_rows(got, want, list(want[0]))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_near_duplicates_of_shared_and_missing_ids(spark, kind):
    t, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "tu")
    rows = [(None, t), (None, t + " tail"), (1, u), (1, t), (2, u + " tail"), (3, t + " other"), (None, "quite another text of seven words"),
            (4, "quite another text of seven words"), (None, "alone " * 9), (None, None)]
    ids = (lambda i: i) if kind == "long" else (lambda i: None if i is None else f"d{i}")
    df = spark.createDataFrame([(ids(i), x) for i, x in rows], f"doc_id {kind}, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, 4, 80).collect()), key=repr)
    want = [(None, 1, False)] * 2 + [(1, 1, True)] * 2 + [(2, 1, False), (3, 1, False), (None, 4, False), (4, 4, True), (None, None, True), (None, None, True)]
    assert got == sorted(((ids(a), ids(b), k) for a, b, k in want), key=repr)


def test_near_duplicates_of_a_drifting_group(spark):
    """Copies that drift away from each other word by word: links only between neighbours."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(words)
        words[(7 * i) % 120] = f"new{i}"
        rows.append((i, " ".join(words), None))
    rows += [(100 + i, " ".join(f"p{j}" for j in range(40)) + " " + " ".join(f"u{i}_{j}" for j in range(60)), None) for i in range(60)]
    _, group = brute_groups(rows, 4)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, x string"), 4, 80)
    ids = {r["doc_id"]: r["component_id"] for r in got.collect()}
    low = {}
    for g, r in zip(group, rows):
        low[g] = min(low.get(g, r[0]), r[0])
    assert ids == {r[0]: low[g] for g, r in zip(group, rows)}


def test_circulant_signature_estimates_likeness():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:350], rng.integers(0, 2**63, 50).astype(np.uint64)])
    keys = minhash.band_keys([a, b], 200, 1)
    assert abs((keys[0] == keys[1]).mean() - 350 / 450) < 0.12


def test_language_id(spark, edge_dir, edge_rows):
    got = run(spark, "op4_language_id", edge_dir)
    assert len(got) == len(edge_rows)
    for r, (i, t, _) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)),
                            sorted(edge_rows, key=lambda r: (r[0] is None, r[0] or 0))):
        assert r["held_out"] == (None if i is None else zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if i is not None:
            assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, t or "")))


def test_language_id_held_out_accuracy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(rows, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert sum(r["rejected"] for r in got) <= 0.02 * len(got)


def test_long_text_counts_as_in_one_piece(monkeypatch):
    text = "abc déf ghi " * 3000
    whole = lang_id.gram_counts([text])
    monkeypatch.setattr(lang_id, "PIECE", 1000)
    assert (lang_id.gram_counts([text]) == whole).all()


def test_quality_rules(spark, edge_dir, edge_rows):
    want = []
    for i, t, _ in edge_rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        covered = {p for j in range(len(w) - 7) if seen[tuple(w[j:j + 8])] > 1 for p in range(j, j + 8)}
        want.append({"doc_id": i, "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
                     "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
                     "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)})
    got = run(spark, "op5_quality_rules", edge_dir)
    same_rows(got, want, list(want[0]))
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert all(r["kept"] for r in got if r["doc_id"] in (4, 5, 13)) and not any(r["kept"] for r in got if r["doc_id"] in (15, 17))


def test_packing(spark, edge_dir, edge_rows, library):
    tok = library["byte_bpe_50k.json"]
    want = Counter((i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 0])) for i, t, _ in edge_rows)
    pieces = sorted(run(spark, "op6_packing", edge_dir), key=lambda r: (r["sequence_id"], r["offset"]))
    by_id = {}
    for (i, ids), n in want.items():
        by_id.setdefault(i, []).extend([ids] * n)
    at, starts = 0, Counter()
    for p in pieces:  # one gapless run of full sequences
        assert p["sequence_id"] * 1024 + p["offset"] == at and 0 < p["length"] <= 1024 - p["offset"]
        at += p["length"]
        a, b = p["start"], p["start"] + p["length"]
        assert any(len(ids) == p["doc_tokens"] and zlib.crc32(np.array(ids[a:b], "<u4").tobytes()) == p["ids_crc32"]
                   for ids in by_id[p["doc_id"]])
        starts[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert starts == Counter({k: v for k, v in Counter(
        {(i, len(ids)): 0 for i, ids in want}).items()}) + Counter({k: sum(len(ids) * n for (i, ids), n in want.items() if (i, len(ids)) == k)
                                                                     for k in {(i, len(ids)) for i, ids in want}})


def test_html_extraction(spark, edge_dir):
    got = run(spark, "op7_html_extraction", edge_dir)
    assert len(got) == 14 and all(r["n_chars"] == len(r["text"]) for r in got)
    for r in got:
        if r["page_id"] is not None and r["page_id"] <= 8:
            assert r["text"] == f"T{r['page_id']} a & b{r['page_id']} cd < e"
    text = {r["page_id"]: r["text"] for r in got}
    assert text[9] == text[10] == "" and text[None] == "plain 1 < 2 text" and text[11] == " ".join(["w w"] * 3000)


def test_html_of_the_tables(spark):
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in run(spark, "op7_html_extraction", "/root/testdata/sf0.001"):
        a = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", a))).split("\0")
        assert r["text"] == " ".join(b for b in (" ".join(unescape(x).split()) for x in blocks) if b)


def test_template_text_leaves_the_slot():
    t = [dict(token=k, support=20, total=20, chars=c, v1=1, v2=1) for k, c in
         (("", 900), ("/html", 900), ("/html/body", 900), ("/html/body/div", 880))]
    fixed = html_template._text_token("/html/body/div", "same on every page")
    t.append(dict(token=fixed, support=20, total=20, chars=0, v1=1, v2=1))
    slot = html_template.main_slot(t, 20)
    assert slot[0] == "/html/body/div"
    page = "<html><body>top<div>same on every page<p>own words of this page</p></div>"
    assert html_template.extract(page, *slot) == "own words of this page"


def test_token_counts(spark, edge_dir, edge_rows, library):
    tok = library["word_bpe_49k.json"]
    want = []
    for i, t, _ in edge_rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append({"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": n, "over_limit": n > 2048})
    same_rows(run(spark, "op8_token_counts", edge_dir), want, list(want[0]))


def test_lm_scoring(spark, edge_dir, edge_rows, monkeypatch):
    monkeypatch.setattr(gru_lm, "LOOKUP_WORDS", 30)
    monkeypatch.setattr(gru_lm, "MODEL_WORDS", 20)
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = [r.asDict() for r in gru_lm.score(docs, 30, 20).collect()]
    tokens = [(i, [*WORD.findall((t or "").translate(LOW)), " "]) for i, t, _ in edge_rows]
    held = [None if i is None else zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens]
    c = Counter()
    for (_, ws), h in zip(tokens, held):
        if h is False:
            c.update(ws)
    n, v = sum(c.values()), len(c)
    want = [{"doc_id": i, "held_out": h, "n_tokens": len(ws), "n_known": sum(w in c for w in ws), "train_tokens": n,
             "base_score": round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)} for (i, ws), h in zip(tokens, held)]
    for r in got:
        r["base_score"] = round(r["base_score"], 6)
        assert r["score"] < 0
    same_rows(got, want, list(want[0]))


def test_lm_probabilities_sum_to_one_and_gradients_hold():
    w = {k: x.astype(np.float64) for k, x in gru_lm.start_weights(70, 5).items()}
    h = np.random.default_rng(0).standard_normal((1, 5)) * 0.3
    p = np.exp([gru_lm.log_probability(w, h, np.array([y]))[0] for y in range(70)])
    assert abs(p.sum() - 1) < 1e-6  # id 0 stands for the rare class
    docs = [np.random.default_rng(i).integers(0, 70, 5 + 9 * i).astype(np.int16) for i in range(12)]
    alone = [gru_lm.score_documents(w, [d])[0] for d in docs]
    assert np.allclose(alone, gru_lm.score_documents(w, docs, 7))


def test_lm_beats_the_base_on_held_out(spark):
    got = [r for r in run(spark, "op9_lm_scoring", "/root/testdata/sf0.01") if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def brute_fingerprint(text, filled=False):
    def xx(value, seed=42):
        return xxhash.xxh64_intdigest(value if isinstance(value, bytes) else (value & (2**64 - 1)).to_bytes(8, "little"), seed=seed)

    signed = lambda x: x - 2**64 if x >= 2**63 else x
    ws = [xx(w.encode()) for w in WORD.findall(text)]
    kmers = [xx(b, xx(a)) for a, b in zip(ws, ws[1:])] if len(ws) > 1 else [xx(w) for w in ws]
    kmers = [signed((k << 24) % 2**64) >> 24 for k in kmers]
    seen, ranked = Counter(), []
    for p, k in enumerate(kmers):
        seen[k] += 1
        ranked.append((signed(xxhash.xxh64_intdigest(seen[k].to_bytes(4, "little"), seed=xx(k))), p))
    out = {}
    for h, p in sorted(ranked):
        out.setdefault((h % 2**64) >> 58, []).append((p, h))
    prints = {}
    if filled:  # each coordinate ranks all k-mers from its own start on, round the circle of hashes
        out = {c: [(p, h) for h, p in sorted(ranked, key=lambda x: (x[0] - (c << 58)) % 2**64)] for c in range(64) if ranked}
    for c, members in out.items():
        state = xxhash.xxh64_intdigest(c.to_bytes(4, "little"), seed=42)
        for _, h in sorted(members[:2]):
            state = xx(h, state)
        prints[c] = state
    return prints


@pytest.mark.parametrize("filled", [False, True])
def test_order_minhash(spark, edge_dir, edge_rows, filled):
    rows = sorted((r for r in edge_rows if r[0] is not None and r[0] != 6), key=lambda r: r[0])
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = sorted((r.asDict() for r in order_minhash.fingerprint_edits(d, filled).collect()), key=lambda r: r["doc_id"])
    texts = [t or "" for _, t, _ in rows]
    for r, t, nxt in zip(got, texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r["n_chars"] == len(t) and r["edited"] == edited
        a, b, c = (brute_fingerprint(x, filled) for x in (t, edited, nxt))
        assert r["fingerprint"] == ",".join(format(a[k], "x") for k in sorted(a))
        for x, name in ((b, "near_edited"), (c, "near_next")):
            union = a.keys() | x.keys()
            assert math.isclose(r[name], sum(a.get(k) == x.get(k) for k in union) / len(union) if union else 1.0)


def test_order_minhash_splits_equal_ids(spark, tmp_dir):
    rows = [(None if i % 5 == 0 else 7 if i % 3 else i, f"text {i}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_dir}/docs")
    d = order_minhash.beside_next(spark.read.parquet(f"{tmp_dir}/docs"), 20)
    got = d.select("doc_id", "text", "next_text").collect()
    after, ids = {r["text"]: r["next_text"] for r in got}, {r["text"]: r["doc_id"] for r in got}
    chain, at = [], min(after)
    for _ in after:
        chain.append(at)
        at = after[at]
    assert len(set(chain)) == 300 and at == chain[0]           # one ring through all rows
    order = [-1 if ids[t] is None else ids[t] for t in chain]
    drops = [i for i in range(300) if order[i - 1] > order[i]]
    assert len(drops) == 1                                     # ascending ids, nulls first
    from pyspark.sql import functions as F
    sizes = {r["n"] for r in d.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()}
    assert max(sizes) < 300


def test_order_minhash_over_cells_and_edge_rows(spark, edge_dir, edge_rows):
    d = spark.createDataFrame([(3 * i, f"text number {i} with words {i * i}") for i in range(50)], "doc_id long, text string")
    one, many = (sorted(tuple(r) for r in order_minhash.beside_next(d, n).select("doc_id", "text", "next_text").collect()) for n in (1000, 7))
    assert one == many and one[-1][2] == one[0][1]
    got = run(spark, "op10_order_minhash", edge_dir)
    assert len(got) == len(edge_rows)
    by_text = {}
    for i, t, _ in edge_rows:
        if i is not None:
            by_text.setdefault(t or "", set()).update(r["fingerprint"] for r in got if r["doc_id"] == i)
    assert all(len(v) == 1 for v in by_text.values())


def test_lm_rare_words_reach_the_network(spark):
    rare = [f"rare{i}" for i in range(40)]
    text = lambda ws: " ".join(f"the {w} of" for w in ws)
    rows = [(i, text(rare[i:i + 9])) for i in range(30)] + [(100, text(rare)), (101, text(rare[7:] + rare[:7]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in gru_lm.score(docs, 200, 3).collect()}
    assert abs(got[100] - got[101]) > 1e-6  # the same words in another order


def test_lm_shared_ids_sum_to_one_and_the_network_grows(spark):
    words = [("the", 9), ("of", 5)] + [(f"w{i}", 1 + i % 3) for i in range(900)]
    sums = gru_lm.rare_totals(spark.createDataFrame(words, "token string, c long"), words[:2])
    share = np.zeros(len(sums))
    for w, c in words[2:]:
        share[gru_lm.rare_id(w, 2)] += (c + 1) / 10 ** sums[gru_lm.rare_id(w, 2)]
    here = [0, *range(3, len(sums))]  # 1 and 2 are the words' own
    assert np.allclose(share[here] + 1 / 10 ** sums[here], 1) and (sums[1:3] == 0).all()
    sizes = [gru_lm.network_size(v) for v in (10, 10**4, 10**5, 10**6, 10**8)]
    assert sizes == sorted(sizes) and sizes[0] == (512, 8) and sizes[-1][0] > 100_000
    for ids, state in ((600, 8), (70_000, 32)):  # no exponential overflows at the limits of the weights
        w = gru_lm.start_weights(ids, state)
        w = {k: np.full_like(v, gru_lm.limit(state)) for k, v in w.items()}
        p = gru_lm.log_probability(w, np.ones((3, state), np.float32), np.array([0, 1, ids - 1]))
        assert np.isfinite(p).all()


def texts_of(spark, pages):
    rows = [(i, f"http://site.org/{i}", p) for i, p in enumerate(pages)]
    got = html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><article><p>{}</p></article><div class='sidebar'>links</div>",
    "<html id='no-sidebar'><body><main class='side'><article class='post comments-open'><p>{}</p><div class='comments'>said</div></article></main>",
    "<body><nav>menu</nav><div class='content-with-sidebar'><article><p>{}</p></article><div class='sidebar'>links</div></div>",
    "<body><div class='page-with-menu'><div id='post' class='comments-open'>{}</div><div class='cookie notice'>we use cookies</div></div>"])
def test_html_words_do_not_condemn_the_main_slot(spark, page):
    data = [f"own text of page {i}, " + " ".join(f"word{i * j}" for j in range(1, 40)) for i in range(4)]
    assert texts_of(spark, [page.format(d) for d in data]) == data


def test_html_words_condemn_comments_longer_than_the_article(spark):
    said = " ".join(f"said{j}" for j in range(200))
    pages = [f"<body><article><p>short {i}</p></article><div class='comments'>{said} {i}</div>" for i in range(3)]
    assert texts_of(spark, pages) == [f"short {i}" for i in range(3)]


@pytest.mark.parametrize("page", [
    "<body><nav>menu</nav><div>top</div><article><h1>{0}</h1><p>{1}</p><div class='body'><section><p>{2}</p></section></div></article>",
    "<body><nav>menu</nav><main><h1>{0}</h1><article><p>{1}</p><div>{2}</div></article></main>",
    "<body><nav>menu</nav><div class='post'><h1>{0}</h1><p>{1}</p><div class='body'><p>{2}</p></div></div>"])
def test_html_title_and_lead_outside_the_body_stay(spark, page):
    parts = [(f"Title {i}", f"lead {i}", " ".join(f"word{i * j}" for j in range(120 if i else 2))) for i in range(4)]
    assert texts_of(spark, [page.format(*p) for p in parts]) == [" ".join(p) for p in parts]


MENU = "<div>Home News Sport Weather</div>"


@pytest.mark.parametrize("n", [2, 6, 12])
@pytest.mark.parametrize("page", [MENU + "<article><p>{}</p></article>", MENU + "<div><p>{}</p></div>", "<div>" + MENU + "<p>{}</p></div>"])
def test_html_identical_menus_go_from_two_pages_on(spark, page, n):
    data = [f"a short story {i}" for i in range(n)]
    assert texts_of(spark, [f"<html><body>{page.format(d)}</body></html>" for d in data]) == data


@pytest.mark.parametrize("n", [1, 3])
def test_html_words_leave_headings_sections_and_inline_words(spark, n):
    page = ("<body><nav>menu</nav><article><h1>T{0}</h1><h2 id='related-work'>Related{0}</h2><p>He sat <span class='side'>beside{0}</span> her</p>"
            "<h2 id='skip-lists'>Lists{0}</h2><section class='search-algorithms'><p class='notice'>found{0}</p></section>"
            "<div class='post-comments'>said</div><ul class='share-links'><li>mail</li></ul></article>")
    want = "T{0} Related{0} He sat beside{0} her Lists{0} found{0}"
    assert texts_of(spark, [page.format(i) for i in range(n)]) == [want.format(i) for i in range(n)]


@pytest.mark.parametrize("page", ["<body><nav><a>menu</a><article><p>{}</p></article></body>", "<body><nav><ul><li>menu</ul><div><p>{}</p></div>",
                                  "<body><header>top<main><p>{}</p></main>", "<body><aside>ads<h1></h1><p>{}</p>"])
def test_html_an_element_without_an_end_tag_does_not_swallow_the_article(spark, page):
    assert texts_of(spark, [page.format(f"story {i}") for i in range(3)]) == [f"story {i}" for i in range(3)]


def test_html_any_depth_keeps_what_follows(spark):
    page = "<body><article>" + "<div>" * 250 + "deep {0}" + "</div>" * 250 + "<p>behind {0}</p></article><div>tail {0}</div>"
    assert texts_of(spark, [page.format(i) for i in range(3)]) == [f"deep {i} behind {i}" for i in range(3)]
    html_template.Page("<div>" * 100_000 + "</p>" * 100_000)   # linear


def test_language_id_rejects_unlearned_languages_and_random_letters(spark):
    import random
    import string

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.fit(docs, lang_id.learned_rows())
    rng = random.Random(1)
    letters = " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(1000))
    italian = ("La ricerca scientifica richiede pazienza e metodo, ogni risultato deve essere verificato con cura da altri studiosi "
               "che lavorano nello stesso campo. ")
    finnish = ("Tieteellinen tutkimus vaatii kärsivällisyyttä ja menetelmiä, jokainen tulos täytyy tarkistaa huolellisesti muiden "
               "tutkijoiden toimesta. ")
    base64 = "".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(2000))
    strange = [t for x in (italian, finnish, letters) for t in (x[:150], x * 5)] + [letters[:2000], base64]
    assert lang_id.predict(model, strange)["rejected"].all()
    held = [r["text"] for r in docs.where("crc32(cast(doc_id AS string)) % 4 = 2 AND lang IS NOT NULL").collect()]
    for n in (80, 300, None):  # whole rows and their beginnings
        got = lang_id.predict(model, [t[:n] for t in held])
        assert got["rejected"].mean() <= 0.02, n


def test_filled_order_minhash_of_short_texts_follows_the_order(spark):
    rng = np.random.default_rng(2)

    def true_likeness(a, b, coordinates=256):
        """An own random order of all k-mers for each coordinate; the two smallest, in text order."""
        same = 0
        for c in range(coordinates):
            picks = []
            for ws in (a, b):
                ranked = sorted((xxhash.xxh64_intdigest(f"{x} {y}", seed=c), p) for p, (x, y) in enumerate(zip(ws, ws[1:])))[:2]
                picks.append([h for p, h in sorted((p, h) for h, p in ranked)])
            same += picks[0] == picks[1]
        return same / coordinates

    rows, want = [], []
    for i in range(10):
        ws = [f"w{x}" for x in rng.permutation(10_000)[:40]]
        swapped = ws[20:] + ws[:20]
        rows.append((i, " ".join(ws), " ".join(swapped)))
        want.append(true_likeness(ws, swapped))
    d = spark.createDataFrame(rows, "i int, a string, b string")
    near = {}
    for filled in (False, True):
        both = order_minhash.with_fingerprint(order_minhash.with_fingerprint(d, "a", "fa", filled), "b", "fb", filled)
        near[filled] = np.mean([r[0] for r in both.select(order_minhash.likeness(both["fa"], both["fb"])).collect()])
    assert abs(near[True] - np.mean(want)) < 0.1 < near[False] - np.mean(want)


def test_order_minhash_query_is_filled(spark, edge_dir):
    got = {r["doc_id"]: r["fingerprint"] for r in run(spark, "op10_order_minhash", edge_dir)}
    assert len(got[4].split(",")) == len(got[9].split(",")) == 64 and got[2] == ""


def test_lm_training_clears_the_state_where_a_document_begins_inside_a_window():
    w, zero = gru_lm.start_weights(70, 5), np.zeros((1, 5), np.float32)
    both = gru_lm.Trainer(w).window(zero, np.array([[70], [3], [70], [4]]), np.array([[3], [9], [4], [8]]))
    alone = gru_lm.Trainer(w).window(zero, np.array([[70], [4]]), np.array([[4], [8]]))
    assert np.allclose(both, alone)


def test_lm_gradients_equal_differences_of_the_loss():
    r = np.random.default_rng(3)
    w = {k: x.astype(np.float64) for k, x in gru_lm.start_weights(40, 4).items()}
    xs = r.integers(0, 40, (5, 6))
    xs[0] = xs[3, 2] = len(w["x"]) - 1  # documents begin
    ys = r.integers(0, 40, (5, 6))
    ys[4, 5] = -1

    def loss(w):
        h, out = np.zeros((6, 4)), 0.0
        for x, y in zip(xs, ys):
            h, _ = gru_lm.gates(w, h * (x != len(w["x"]) - 1)[:, None], x)
            out -= gru_lm.log_probability(w, h[y >= 0], y[y >= 0]).sum()
        return out * 32 / (ys >= 0).sum()

    trainer = gru_lm.Trainer(w)
    trainer.window(np.zeros((6, 4)), xs, ys)
    for k in w:
        step = (w[k] - trainer.w[k]) * np.sqrt(trainer.seen[k].astype(np.float64)) / gru_lm.RATE
        for at in zip(*(r.integers(0, n, 12) for n in w[k].shape)):
            ends = []
            for d in (1e-5, -1e-5):
                moved = {n: v.copy() for n, v in w.items()}
                moved[k][at] += d
                ends.append(loss(moved))
            slope = np.clip((ends[0] - ends[1]) / 2e-5, -1, 1)
            assert abs(step[at] - slope) < 1e-3 + 1e-3 * abs(slope), (k, at)


@pytest.mark.parametrize("tasks", [1, 3])
def test_lm_training_averages_what_its_tasks_learned(spark, tasks, monkeypatch):
    r = np.random.default_rng(8)
    rows = [(i, i if i % 5 else None, r.integers(0, 30, 40 + i).astype(np.uint16).tobytes()) for i in range(60)]
    coded = spark.createDataFrame(rows, "row long, doc_id long, ids binary").repartition(3, "row")
    coded = gru_lm.staged(coded.sortWithinPartitions("row"), "coded")
    monkeypatch.setattr(gru_lm, "training_tasks", lambda *_: tasks)
    monkeypatch.setattr(gru_lm, "WEIGHT_BLOCK", 1000)
    got = gru_lm.train(coded, 20)
    want = gru_lm.start_weights(20 + gru_lm.RARE, gru_lm.STATE)
    F = gru_lm.F
    early = F.pmod(F.xxhash64(F.lit(11), "row"), F.lit(8)) == 0
    for part in (early, ~early):
        dealt = coded.where(gru_lm.learned(F.col("doc_id")) & part).select("ids").coalesce(tasks)
        groups: dict = {}
        for x in dealt.select("ids", F.spark_partition_id().alias("p")).collect():
            groups.setdefault(x["p"], []).append(np.frombuffer(x["ids"], np.uint16))
        learned = []
        for docs in groups.values():
            trainer = gru_lm.Trainer(want)
            trainer.train(docs)
            learned.append((trainer.tokens, gru_lm.flat(trainer.w)))
        assert sum(n for n, _ in learned) == sum(len(d) for docs in groups.values() for d in docs)
        want = gru_lm.shaped(sum(n * v for n, v in learned) / sum(n for n, _ in learned), want)
    assert all(np.allclose(got[k], want[k], atol=1e-5) for k in want)


def test_lm_training_tasks_send_less_than_they_read():
    for ids, weights in ((0, 10**5), (10**6, 10**6), (2 * 10**8, 3 * 10**6), (10**13, 5 * 10**7)):
        tasks = gru_lm.training_tasks(ids, weights)
        assert tasks == 1 or tasks * weights * gru_lm.SHARE <= ids
    assert gru_lm.training_tasks(10**13, 5 * 10**7) == 10**5


@pytest.mark.parametrize("ids", [40, 276, 7_588, 21_040, 120_000])
def test_lm_outputs_computed_per_token_grow_with_the_cube_root_of_the_ids(ids):
    w = gru_lm.start_weights(ids, 8)
    width, leaves, groups, size = gru_lm.shape_of(ids)
    assert 2 * width + size <= 4 * 1.16 * ids ** (1 / 3) + 12  # before: two square roots
    slot, place = gru_lm.codes(w)
    assert len({*zip(slot.tolist(), np.where(slot < leaves, 0, place).tolist())}) == ids  # each id has a place of its own
    h = np.random.default_rng(1).standard_normal((1, 8)).astype(np.float32) * 0.3
    p = np.exp(gru_lm.log_probability(w, np.repeat(h, ids, axis=0), np.arange(ids)).astype(np.float64))
    assert abs(p.sum() - 1) < 1e-4


def test_lm_words_of_bytes_are_those_of_the_pattern():
    text = "A\x1cB\x85c\xa0D E\x0bf\x0cg\r\nH\tÄÖ İ Σ  x  y\x1f"
    assert [w.decode() for w in gru_lm._words(text.encode())] == [*WORD.findall(text.translate(LOW)), " "]
    assert gru_lm._words(None) == [b" "]


def test_lm_encodes_a_text_that_fills_a_slice_alone(spark):
    docs = spark.createDataFrame([(1, "the of " * 160_000), (2, "the x")], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in gru_lm.encode(docs, [("the", 5), ("of", 2), (" ", 1)], ["the"]).collect()}
    assert got[1]["n_tokens"] == got[1]["n_known"] == 320_001 and got[1]["words"] == {}
    assert got[2]["n_tokens"] == 3 and got[2]["n_known"] == 2 and got[2]["words"] == {"x": 1}
    assert abs(got[2]["logs"] - math.log10(12)) < 1e-9 and abs(got[2]["rare_logs"] - math.log10(2)) < 1e-9
    ids = [1, gru_lm.rare_id("x", 1), gru_lm.rare_id(" ", 1)]
    assert np.frombuffer(got[2]["ids"], np.uint16).tolist() == ids


def test_lm_texts_split_together_have_the_words_of_each():
    r = np.random.default_rng(4)
    signs = [bytes([i]) for i in range(256)] + [b" ", b"A", b"\n", b"\t"] * 25
    texts = [None, b"", b" \x0b"] + [b"".join(signs[i] for i in r.integers(0, len(signs), r.integers(0, 60))) for _ in range(500)] + [b"", b"\n", None]
    for kind in (pa.binary(), pa.large_binary()):
        for part in (slice(0, len(texts)), slice(2, 90), slice(len(texts) - 3, len(texts)), slice(0, 1)):
            codes, words, ends = gru_lm._coded(pa.array(texts, kind)[part])
            assert [[words[k] for k in codes[a:e]] for a, e in zip([0, *ends[:-1]], ends)] == [gru_lm._words(t) for t in texts[part]]


def test_lm_text_slices_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(gru_lm, "SLICE", 10)
    got = list(gru_lm.text_slices(pa.array([None, b"abc", b"x" * 30, b"", b"1234567890", b"y", None])))
    assert got == [slice(0, 3), slice(3, 5), slice(5, 7)]


def test_lm_encodes_words_by_their_distinct_values(spark):
    docs = spark.createDataFrame([(1, "the of " * 700_000), (2, "x The y x"), (3, None)], "doc_id long, text string").coalesce(1)
    for known, end in (([("the", 5), ("of", 2), (" ", 1)], {}), ([("the", 5), ("of", 2)], {" ": 1})):  # the end is looked up like a word
        got = {r["doc_id"]: r for r in gru_lm.encode(docs, known, ["the"]).collect()}
        assert [got[i]["n_tokens"] for i in (1, 2, 3)] == [1_400_001, 5, 1]
        assert [got[i]["words"] for i in (1, 2, 3)] == [end, {"x": 2, "y": 1, **end}, end]
        ids = [gru_lm.rare_id("x", 1), 1, gru_lm.rare_id("y", 1), gru_lm.rare_id("x", 1), gru_lm.rare_id(" ", 1)]
        assert np.frombuffer(got[2]["ids"], np.uint16).tolist() == ids
        assert len(got[1]["ids"]) == 2 * 1_400_001


def test_lm_groups_of_like_size_share_a_batch():
    r = np.random.default_rng(6)
    group = np.sort(np.minimum((r.pareto(0.7, 5000) * 4).astype(np.int64), 299))
    taken, batches = [], 0
    for of, row, real in gru_lm._batches(group, 300):
        assert (group[row] == of[:, None])[real].all() and row.shape == real.shape
        assert row.shape[1] == gru_lm.TILE or (2 * real.sum(axis=1) > row.shape[1]).all()  # at least half are the group's own
        taken += row[real].tolist()
        batches += 1
    assert sorted(taken) == list(range(5000))
    assert batches <= math.log2(np.bincount(group).max()) + 5000 // gru_lm.BLOCK + 2


def test_lm_sums_of_runs_equal_those_one_by_one():
    r = np.random.default_rng(7)
    x = np.minimum((r.pareto(0.6, 9000) * 3).astype(np.int64), 400)
    d = r.standard_normal((9000, 5))
    order = np.argsort(x, kind="stable")
    used, first = np.unique(x[order], return_index=True)
    assert np.bincount(x).max() > gru_lm.PIECE**2  # pieces of pieces
    by, sums = gru_lm._gathered(d, order, first)
    assert sorted(by.tolist()) == list(range(len(used)))
    assert np.allclose(sums, [d[x == k].sum(axis=0) for k in used[by]])
