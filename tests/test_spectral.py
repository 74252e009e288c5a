"""Signal features: both kernels against an independent numpy brute force; chunking,
frame counts, dB range, pure-tone band."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonara.operators import spectral as S


def _signals(spark, arrays, sr=22050):
    rows = [(i + 1, sr, [float(v) for v in a]) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, "song_id bigint, sr int, samples array<float>")


def _mel(f):
    f = np.asarray(f, dtype=float)
    return np.where(f < 1000.0, f * 3.0 / 200.0, 15.0 + np.log(np.maximum(f, 1e-9) / 1000.0) * 27.0 / np.log(6.4))


def _hz(m):
    m = np.asarray(m, dtype=float)
    return np.where(m < 15.0, m * 200.0 / 3.0, 1000.0 * np.exp((m - 15.0) * np.log(6.4) / 27.0))


def brute(x, sr, p):
    """Reference: numpy pad (reflect) + periodic Hann + rfft + Slaney filterbank + dB."""
    N, H, M = p.n_fft, p.hop, p.n_mels
    x = np.asarray(x, dtype=np.float64)
    xp = np.pad(x, N // 2, mode=p.pad_mode)
    nf = 1 + len(x) // H
    win = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(N) / N)
    frames = np.stack([xp[f * H: f * H + N] for f in range(nf)]) * win
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    fmax = sr / 2 if p.fmax is None else p.fmax
    edges = _hz(np.linspace(_mel(p.fmin), _mel(fmax), M + 2))
    g = np.arange(N // 2 + 1) * sr / N
    W = np.zeros((M, N // 2 + 1))
    for m in range(M):
        lo = (g - edges[m]) / (edges[m + 1] - edges[m])
        hi = (edges[m + 2] - g) / (edges[m + 2] - edges[m + 1])
        W[m] = np.maximum(0, np.minimum(lo, hi)) * 2.0 / (edges[m + 2] - edges[m])
    mel = power @ W.T
    ref = max(p.amin, mel.max())
    db = 10 * np.log10(np.maximum(p.amin, mel)) - 10 * np.log10(ref)
    db = np.maximum(db, db.max() - p.top_db)
    return power, mel, db


def _collect(df, col):
    rows = df.orderBy("song_id", "timeseries").collect()
    out = {}
    for r in rows:
        out.setdefault(r.song_id, []).append(r[col])
    return {k: np.array(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(7)
    return [rng.uniform(-0.5, 0.5, n).astype(np.float32) for n in (64, 100, 257, 1000, 33)]


@pytest.mark.parametrize("kernel", ["hof", "arrow"])
def test_kernels_match_brute_force(spark, arrays, kernel):
    p = replace(S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0), kernel=kernel, frames_per_chunk=5)
    sig = _signals(spark, arrays)
    mel = _collect(S.mel_spectrogram(sig, p), "mel")
    pw = _collect(S.power_spectrum(sig, p), "power")
    db = _collect(S.spec_packed(sig, p), "db")
    for i, a in enumerate(arrays):
        bp, bm, bd = brute(a, 22050, p)
        np.testing.assert_allclose(pw[i + 1], bp, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(mel[i + 1], bm, rtol=1e-9, atol=1e-14)
        np.testing.assert_allclose(db[i + 1], bd, rtol=0, atol=1e-8)


def test_arrow_kernel_real_sizes_and_constant_pad(spark):
    rng = np.random.default_rng(3)
    arrs = [rng.normal(0, 0.1, n).astype(np.float32) for n in (5000, 12345)]
    for pad in ("reflect", "constant"):
        p = replace(S.MelParams(n_fft=512, hop=128, n_mels=40), pad_mode=pad, kernel="arrow", frames_per_chunk=7)
        db = _collect(S.spec_packed(_signals(spark, arrs, sr=16000), p), "db")
        for i, a in enumerate(arrs):
            np.testing.assert_allclose(db[i + 1], brute(a, 16000, p)[2], atol=1e-7)


def test_chunked_equals_unchunked(spark, arrays):
    base = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0, kernel="hof")
    sig = _signals(spark, arrays)
    a = _collect(S.mel_spectrogram(sig, replace(base, frames_per_chunk=1000)), "mel")
    b = _collect(S.mel_spectrogram(sig, replace(base, frames_per_chunk=3)), "mel")
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=1e-12)


def test_frame_count_and_db_range(spark, arrays):
    p = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0)
    db = S.spec_packed(_signals(spark, arrays), p)
    counts = {r.song_id: r.n for r in db.groupBy("song_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {i + 1: 1 + len(a) // 8 for i, a in enumerate(arrays)}
    ex = db.select(F.explode("db").alias("d")).agg(F.max("d"), F.min("d")).first()
    assert abs(ex[0]) < 1e-12 and ex[1] >= -80.0 - 1e-9


def test_pure_tone_peaks_in_its_band(spark):
    sr, f0 = 8000, 1000.0
    t = np.arange(sr) / sr
    tone = (0.5 * np.sin(2 * np.pi * f0 * t)).astype(np.float32)
    p = S.MelParams(n_fft=256, hop=64, n_mels=16, kernel="arrow")
    mel = S.mel_spectrogram(_signals(spark, [tone], sr=sr), p)
    avg = np.mean(np.stack([np.array(r.mel) for r in mel.collect()]), axis=0)
    edges = _hz(np.linspace(_mel(0.0), _mel(sr / 2), p.n_mels + 2))
    band = int(np.argmax(avg))
    assert edges[band] <= f0 <= edges[band + 2]


def test_filterbank_df_matches_numpy(spark):
    from sonara.functions.melscale import np_filterbank
    p = S.MelParams(n_fft=64, hop=16, n_mels=10, fmax=8000.0)
    rates = spark.createDataFrame([(22050,), (16000,), (22050,)], "sr int")
    fb = S.mel_filterbank(rates, p).collect()
    for sr in (22050, 16000):
        W = np_filterbank(sr, 64, 10, 0.0, 8000.0)
        got = np.zeros_like(W)
        for r in fb:
            if r.sr == sr:
                got[r.band, r.bin] = r.weight
        np.testing.assert_allclose(got, W, rtol=1e-12, atol=1e-15)


def test_wide_long_round_trip(spark, arrays):
    p = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0)
    packed = S.spec_packed(_signals(spark, arrays), p)
    long1 = S.spec_long(packed)
    long2 = S.wide_to_long(S.spec_wide(packed, 8), 8)
    assert long1.exceptAll(long2).count() == 0 and long2.exceptAll(long1).count() == 0


def test_job_params_query_matches_brute_force(spark):
    """The registered production-parameter query on a few real signals (pad > length)."""
    import __spark_entry__ as E
    from data_dirs import SF001
    df = E.queries()["spec_job_params"](spark, SF001)
    got = {(r.song_id, r.timeseries): r for r in df.collect()}
    emb = {r.vec_id + 1: np.array(r.embedding, dtype=np.float32)
           for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()}
    assert len(got) == sum(1 + len(x) // 512 for x in emb.values())
    for sid in list(emb)[:20]:
        _, _, db = brute(emb[sid], 22050, S.JOB_PARAMS)
        for t in range(db.shape[0]):
            row = got[(sid, t)]
            np.testing.assert_allclose([row[f"spec{i + 1}"] for i in range(128)], db[t], atol=1.01e-4)


def test_hot_song_is_spread_over_tasks(spark):
    """One song with most of the samples: its chunk rows land on many tasks, and its
    spectrogram still equals the brute force."""
    rng = np.random.default_rng(11)
    hot = rng.uniform(-0.5, 0.5, 120_000).astype(np.float32)
    others = [rng.uniform(-0.5, 0.5, 500).astype(np.float32) for _ in range(20)]
    p = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0, frames_per_chunk=512, balance=True)
    sig = _signals(spark, [hot] + others)
    ch = S.frame_chunks(sig, p).withColumn("pid", F.spark_partition_id())
    tasks = ch.where("song_id = 1").select("pid").distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    db = S.spec_packed(sig, p).where("song_id = 1").orderBy("timeseries")
    got = np.array([r.db for r in db.collect()])
    np.testing.assert_allclose(got, brute(hot, 22050, p)[2], atol=1e-8)


@pytest.mark.parametrize("pad", ["reflect", "constant"])
def test_short_last_piece(spark, pad):
    """Last piece shorter than the halo: the previous piece's frames reflect at the song end."""
    rng = np.random.default_rng(5)
    arrs = [rng.uniform(-0.5, 0.5, n).astype(np.float32) for n in (85, 121, 41, 80, 200)]
    p = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0, frames_per_chunk=5, pad_mode=pad)  # pieces of 40
    db = _collect(S.spec_packed(_signals(spark, arrs), p), "db")
    for i, a in enumerate(arrs):
        np.testing.assert_allclose(db[i + 1], brute(a, 22050, p)[2], atol=1e-8)


def test_pieces_input_equals_whole_input(spark, arrays):
    p = S.MelParams(n_fft=32, hop=8, n_mels=8, fmax=10000.0, frames_per_chunk=5)
    sig = _signals(spark, arrays)
    whole = _collect(S.mel_spectrogram(sig, p), "mel")
    pieces = _collect(S.mel_spectrogram(S.to_pieces(sig, p), p), "mel")
    for k in whole:
        np.testing.assert_allclose(whole[k], pieces[k], rtol=1e-12)


def test_random_piece_geometry_matches_brute_force(spark):
    """Random n_fft, hop, piece length and signal lengths (including signals shorter than
    the halo and last pieces of every size) against the numpy reference."""
    rng = np.random.default_rng(17)
    for trial in range(6):
        n_fft = int(rng.choice([16, 32, 64]))
        hop = int(rng.choice([h for h in (4, 8, 16) if h <= n_fft]))
        fpc = int(rng.integers(1, 9))
        pad = "reflect" if trial % 2 == 0 else "constant"
        p = S.MelParams(n_fft=n_fft, hop=hop, n_mels=6, fmax=8000.0, frames_per_chunk=fpc, pad_mode=pad)
        lengths = [int(x) for x in rng.integers(n_fft // 2 + 1, 12 * n_fft, 5)] + [n_fft // 2 + 1]
        arrs = [rng.uniform(-0.5, 0.5, n).astype(np.float32) for n in lengths]
        db = _collect(S.spec_packed(_signals(spark, arrs, sr=16000), p), "db")
        for i, a in enumerate(arrs):
            np.testing.assert_allclose(db[i + 1], brute(a, 16000, p)[2], atol=1e-8,
                                       err_msg=f"trial {trial} n_fft {n_fft} hop {hop} fpc {fpc} len {len(a)}")


def test_signals_shorter_than_the_halo(spark):
    """Repeated reflection (numpy's 'reflect' for pads longer than the signal)."""
    rng = np.random.default_rng(23)
    arrs = [rng.uniform(-0.5, 0.5, n).astype(np.float32) for n in (2, 3, 5)]
    p = S.MelParams(n_fft=32, hop=8, n_mels=6, fmax=8000.0)
    db = _collect(S.spec_packed(_signals(spark, arrs, sr=16000), p), "db")
    for i, a in enumerate(arrs):
        np.testing.assert_allclose(db[i + 1], brute(a, 16000, p)[2], atol=1e-8)


def test_bands_do_not_depend_on_the_rows_of_a_batch(spark):
    """A retried task may fetch its rows in another order and in other batches: same bits."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    p = S.JOB_PARAMS
    segs = [rng.standard_normal(p.n_fft + p.hop * (n - 1)).astype(np.float32) for n in (1, 3, 7, 2, 16, 5)]
    rows = [(i, 22050 if i % 2 else 44100, 0, (len(s) - p.n_fft) // p.hop + 1, s) for i, s in enumerate(segs)]

    def run(order, max_values):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in order], pa.int64()), pa.array([r[1] for r in order], pa.int32()),
             pa.array([r[2] for r in order], pa.int64()), pa.array([r[3] for r in order], pa.int32()),
             pa.array([r[4].tolist() for r in order], pa.list_(pa.float32()))], names=["song_id", "sr", "f0", "nfc", "seg"])
        out = {}
        for rb in S._arrow_kernel(p, "mel", max_values)([batch]):
            for r in rb.to_pylist():
                out[r["song_id"], r["timeseries"]] = r["mel"]
        return out

    want = run(rows, 1 << 22)
    assert len(want) == sum(r[3] for r in rows)
    assert run(rows[::-1], 1 << 22) == want and run(rows, 1) == want and run(rows[3:] + rows[:3], 8 * p.n_fft) == want


def test_song_without_id_and_hot_song_get_their_peak(spark):
    """Null song ids are a group; a long song's frames meet their peak in many tasks without a broadcast."""
    long = spark.range(40000).select(F.lit(1).cast("bigint").alias("song_id"), F.col("id").alias("timeseries"),
                                     F.array(F.col("id") * 1.0, F.lit(2.0)).alias("mel"))
    few = spark.createDataFrame([(None, 0, [5.0, 1.0]), (None, 9000, [1.0, 7.0]), (2, 0, [3.0, 0.5])],
                                "song_id bigint, timeseries bigint, mel array<double>")
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = S.with_peak(long.unionByName(few))
        peaks = {(r.song_id, r.peak) for r in out.select("song_id", "peak").distinct().collect()}
        assert peaks == {(1, 39999.0), (None, 7.0), (2, 3.0)} and out.count() == 40003
        sizes = [r["count"] for r in out.where("song_id = 1").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 3 and max(sizes) <= 20000
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
