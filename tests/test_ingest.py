"""Ingest from generated WAV files: listing, header, decode, numbering, limits, sinks."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonara.operators import ingest as I
from sonara.operators import series as Q
from sonara.operators import spectral as S
from sonara.sinks import tables as K
from sonara.sources.objects import list_objects, relative_key
from sonara.sources.wav import header_fields, wav_bytes


def whole_signals(out):
    """Test helper: reassemble each (short) recording from its pieces."""
    own = S.owned_samples(out.pieces, out.piece_length)
    sig = own.groupBy("song_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("timeseries", "intensity"))),
                    lambda x: x["intensity"]).alias("samples"))
    return sig.join(out.pieces.select("song_id", "sr").distinct(), "song_id")


def tone(f, sr, n, ch=1):
    t = np.arange(n) / sr
    x = 0.5 * np.sin(2 * np.pi * f * t)
    return np.stack([x, -0.5 * x], axis=1) if ch == 2 else x


@pytest.fixture()
def wav_dir(tmp_dir):
    files = {
        "a/mono.wav": wav_bytes(tone(440, 8000, 8000), 8000),
        "a/stereo.wav": wav_bytes(tone(440, 8000, 8000, 2), 8000, channels=2),
        "b/odd.wav": wav_bytes(tone(300, 8000, 1001), 8000),
        "b/song.mp3.bak": b"ID3 not really audio",
        "b/notes.txt": b"hello",
    }
    for k, v in files.items():
        p = os.path.join(tmp_dir, k)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(v)
    return tmp_dir


def test_listing_prunes_content(spark, wav_dir):
    df = list_objects(spark, wav_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    keys = sorted(r.k for r in df.select(relative_key("path", wav_dir).alias("k")).collect())
    assert keys == ["a/mono.wav", "a/stereo.wav", "b/notes.txt", "b/odd.wav", "b/song.mp3.bak"]


def test_header_fields(spark, wav_dir):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(wav_dir)
    h = {os.path.basename(r.path): r for r in header_fields(files).collect()}
    assert (h["stereo.wav"].channels, h["stereo.wav"].samplerate) == (2, 8000)
    assert h["mono.wav"].duration == 1.0 and h["mono.wav"].bitrate == 128.0
    assert h["notes.txt"].channels is None and h["notes.txt"].filesize == 5


def test_ingest_tables(spark, wav_dir):
    out = I.ingest(spark, wav_dir, S.MelParams(n_fft=256, hop=64, n_mels=16))
    cat = {r.s3_key: r for r in out.catalog.collect()}
    # substring filter: the .bak keeps, the .txt does not; ids follow the key order
    assert [cat[k].song_id for k in sorted(cat)] == ["1", "2", "3", "4"]
    assert cat["b/song.mp3.bak"].channels == "None" and cat["a/mono.wav"].channels == "1"
    sig = {r.song_id: r for r in whole_signals(out).collect()}
    assert sorted(sig) == [1, 2, 3]   # the .bak has a catalog row but no signal
    st = np.array(sig[2].samples)
    assert len(st) == 8000 and np.allclose(st, 0.125 * np.sin(2 * np.pi * 440 * np.arange(8000) / 8000), atol=1e-4)
    assert out.audio.where("song_id = 3").count() == 1001
    frames = out.spec.groupBy("song_id").count().collect()
    assert {r.song_id: r["count"] for r in frames} == {1: 1 + 8000 // 64, 2: 1 + 8000 // 64, 3: 1 + 1001 // 64}


def test_limit_opens_only_first_files(spark, wav_dir):
    numbered = I.number_files(list_objects(spark, wav_dir), wav_dir)
    files = I.selected_files(numbered, 2)
    assert sorted(r.s3_key for r in files.collect()) == ["a/mono.wav", "a/stereo.wav"]
    os.remove(os.path.join(wav_dir, "b", "odd.wav"))   # a file beyond the limit is not missed
    out = I.ingest(spark, wav_dir, S.MelParams(n_fft=64, hop=16, n_mels=4), numbered=numbered, limit=2)
    assert sorted(r.s3_key for r in out.catalog.collect()) == ["a/mono.wav", "a/stereo.wav"]


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("k1", 1), ("k2", 2)], "s3_key string, song_id bigint")
    p = os.path.join(tmp_dir, "t")
    K.write_create(df, p)
    with pytest.raises(Exception):
        K.write_create(df, p)
    K.write_append(df, p)
    assert spark.read.parquet(p).count() == 4


def test_append_catalog_twice_is_once(spark, tmp_dir):
    p = os.path.join(tmp_dir, "catalog")
    listing = spark.createDataFrame([("b",), ("a",)], "s3_key string")
    K.append_catalog(spark, p, listing)
    more = spark.createDataFrame([("c",), ("a",), ("b",), ("0",)], "s3_key string")
    K.append_catalog(spark, p, more)
    K.append_catalog(spark, p, more)
    got = sorted((r.s3_key, r.song_id) for r in spark.read.parquet(p).collect())
    assert got == [("0", 3), ("a", 1), ("b", 2), ("c", 4)]


def test_chunked_layout_round_trip(spark, tmp_dir):
    audio = spark.range(1000).select((F.col("id") % 7).alias("song_id"), (F.col("id") / 7).cast("bigint").alias("timeseries"),
                                     F.rand(1).cast("float").alias("intensity"))
    p = os.path.join(tmp_dir, "chunked")
    K.write_chunked(audio, p, 16)
    back = spark.read.parquet(p)
    assert back.select("song_id", "timeseries", "intensity").exceptAll(audio).count() == 0
    assert back.where("chunk = 2").agg(F.min("timeseries"), F.max("timeseries")).first() == (32, 47)


def test_newest_samples_read_only_their_chunks(spark, tmp_dir):
    """Songs of many lengths, with gaps, a song without id and one longer than all others together:
    the same rows as from the whole table, and only the folders that hold them are scanned."""
    rows = [(s, t) for s, n in ((1, 900), (2, 40), (3, 3), (4, 17)) for t in range(n)]
    rows += [(5, t) for t in (0, 1, 2, 130, 700)] + [(None, t) for t in range(66)]
    audio = spark.createDataFrame(rows, "song_id bigint, timeseries bigint").withColumn(
        "intensity", (F.col("timeseries") * 0.5).cast("float"))
    p = os.path.join(tmp_dir, "newest")
    K.write_chunked(audio, p, 16)
    for k in (1, 4, 20):
        got, want = K.read_latest(spark, p, k), Q.latest_samples(audio, k)
        assert got.collect() == want.collect() and got.columns == want.columns
    chunks = {t // 16 for t in (899, 898, 39, 38, 2, 1, 16, 15, 700, 130, 65, 64)}
    read = K.read_latest(spark, p, 2)
    assert {int(f.split("/chunk=")[1].split("/")[0]) for f in read.inputFiles() if "/chunk=" in f} >= chunks
    plan = read._jdf.queryExecution().executedPlan().toString()
    named = re.search(r"PartitionFilters: \[chunk#\d+ IN \(([\d,]+)\)", plan).group(1)
    assert {int(c) for c in named.split(",")} == chunks
    one = K.read_latest(spark, p, 4, song_id=2)
    assert [r.timeseries for r in one.collect()] == [39, 38, 37, 36]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(song_id,2)" in plan and re.search(r"PartitionFilters: \[[^\]]*\(chunk#\d+ = 2\)", plan)
    assert K.read_latest(spark, p, 4, song_id=77).collect() == []
    K.write_chunked(audio.where("false"), os.path.join(tmp_dir, "none"), 16)
    assert K.read_latest(spark, os.path.join(tmp_dir, "none"), 4).collect() == []


def test_batch_shows_in_all_tables_or_none(spark, wav_dir, tmp_dir, monkeypatch):
    """A run that breaks off before or after any of its writes: readers see the tables of the last
    complete batch, and the next run ends with what one unbroken run writes."""
    from pyspark.sql.readwriter import DataFrameWriter
    p = S.MelParams(n_fft=256, hop=64, n_mels=16)
    whole = os.path.join(tmp_dir, "unbroken")
    I.ingest_batches(spark, wav_dir, whole, 2, p)
    write = DataFrameWriter.parquet

    def ids(out):
        found = [I.read_ingested(spark, out, t) for t in I.TABLES]
        return [None if f is None else sorted(int(r.song_id) for r in f.select("song_id").distinct().collect()) for f in found]

    def stop_at(table, after):
        def parquet(self, path, *args, **kwargs):
            if path.endswith(f"/{table}/first_id=3"):
                if after:
                    write(self, path, *args, **kwargs)
                raise RuntimeError("lost")
            return write(self, path, *args, **kwargs)
        return parquet

    for n, (table, after) in enumerate([("audio", False), ("audio", True), ("spec", True), ("catalog", True)]):
        out = os.path.join(tmp_dir, f"broken{n}")
        assert ids(out) == [None, None, None]
        monkeypatch.setattr(DataFrameWriter, "parquet", stop_at(table, after))
        with pytest.raises(RuntimeError, match="lost"):
            I.ingest_batches(spark, wav_dir, out, 2, p)
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        assert I.committed_batches(spark, out) == [1]
        assert ids(out) == [[1, 2]] * 3
        assert I.ingest_batches(spark, wav_dir, out, 2, p) == 1
        for t in I.TABLES:
            got, want = I.read_ingested(spark, out, t), I.read_ingested(spark, whole, t)
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_tables_written_before_the_log_are_taken_over(spark, wav_dir, tmp_dir):
    p = S.MelParams(n_fft=256, hop=64, n_mels=16)
    out = os.path.join(tmp_dir, "older")
    assert I.ingest_batches(spark, wav_dir, out, 3, p) == 2
    os.rename(f"{out}/catalog-commits", f"{out}/set-aside")
    assert I.ingest_batches(spark, wav_dir, out, 3, p) == 0
    assert I.committed_batches(spark, out) == [1, 4]


def test_ingest_batches_equal_one_run(spark, wav_dir, tmp_dir):
    p = S.MelParams(n_fft=256, hop=64, n_mels=16)
    out = os.path.join(tmp_dir, "batched")
    assert I.ingest_batches(spark, wav_dir, out, 3, p) == 2
    whole = I.ingest(spark, wav_dir, p)
    assert spark.read.parquet(f"{out}/catalog").drop("first_id").exceptAll(whole.catalog).count() == 0
    assert spark.read.parquet(f"{out}/audio").count() == whole.audio.count()
    spec = spark.read.parquet(f"{out}/spec").drop("first_id")
    assert spec.count() == whole.spec.count() and spec.columns[:3] == ["song_id", "timeseries", "spec1"]


def test_chunked_layout_spreads_hot_chunk(spark, tmp_dir):
    """Every song fills chunk 0: it is written by several tasks, not one."""
    audio = spark.range(20000).select((F.col("id") % 400).alias("song_id"),
                                      (F.col("id") / 400).cast("bigint").alias("timeseries"),
                                      F.lit(0.5).cast("float").alias("intensity"))
    p = os.path.join(tmp_dir, "hot")
    K.write_chunked(audio, p, chunk_size=64, num_partitions=8)
    files = [f for f in os.listdir(os.path.join(p, "chunk=0")) if f.endswith(".parquet")]
    assert len(files) >= 4


def test_decoder_pieces_equal_whole_signal_path(spark, wav_dir):
    """Pieces of 512 samples from the decoder (16 per 8000-sample file): samples and
    spectrogram equal those computed from whole signals."""
    p = S.MelParams(n_fft=256, hop=64, n_mels=16, frames_per_chunk=8)
    out = I.ingest(spark, wav_dir, p)
    assert out.piece_length == 512
    assert out.pieces.where("song_id = 1").count() == 16
    whole = whole_signals(out)
    assert out.audio.exceptAll(whole.select("song_id", F.posexplode("samples").alias("timeseries", "intensity"))
                               .withColumn("timeseries", F.col("timeseries").cast("bigint"))).count() == 0
    a = {(r.song_id, r.timeseries): np.array(r.db) for r in out.spec.collect()}
    b = {(r.song_id, r.timeseries): np.array(r.db) for r in S.spec_packed(whole, p).collect()}
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(a[k], b[k], atol=1e-9)


def test_job_cli(spark, wav_dir, tmp_dir):
    from sonara import jobs
    out = os.path.join(tmp_dir, "job")
    assert jobs.main(["ingest", "--input", wav_dir, "--output", out, "--batch-files", "2",
                      "--n-fft", "256", "--hop", "64", "--n-mels", "16", "--fmax", "0"]) == 0
    cat = spark.read.parquet(f"{out}/catalog")
    assert cat.count() == 4 and spark.read.parquet(f"{out}/spec").columns[-2:] == ["spec16", "first_id"]
    ck, catalog = os.path.join(tmp_dir, "ck"), os.path.join(tmp_dir, "stream-cat")
    assert jobs.main(["stream", "--input", wav_dir, "--catalog", catalog, "--checkpoint", ck]) == 0
    assert spark.read.parquet(catalog).count() == 4


def test_listing_accepts_prefixes(spark, wav_dir):
    df = list_objects(spark, [os.path.join(wav_dir, "a"), os.path.join(wav_dir, "b")])
    assert df.count() == 5


def _wav(fmt_tag, bits, ch, sr, data, extra_chunk=b""):
    block = ch * bits // 8
    fmt = (fmt_tag.to_bytes(2, "little") + ch.to_bytes(2, "little") + sr.to_bytes(4, "little")
           + (sr * block).to_bytes(4, "little") + block.to_bytes(2, "little") + bits.to_bytes(2, "little"))
    body = b"WAVE" + b"fmt " + len(fmt).to_bytes(4, "little") + fmt + extra_chunk \
        + b"data" + len(data).to_bytes(4, "little") + data
    return b"RIFF" + len(body).to_bytes(4, "little") + body


def test_decoder_sample_formats(spark, tmp_dir):
    from sonara.sources.wav import decode_wav
    x = np.array([0.0, 0.5, -0.5, 0.25, -1.0], dtype=np.float64)
    i24 = np.round(x * (1 << 23)).clip(-(1 << 23), (1 << 23) - 1).astype(np.int32)
    b24 = b"".join(int(v & 0xFFFFFF).to_bytes(3, "little") for v in i24)
    files = {
        "f32.wav": _wav(3, 32, 1, 8000, x.astype("<f4").tobytes()),
        "i24.wav": _wav(1, 24, 1, 8000, b24, extra_chunk=b"LIST" + (4).to_bytes(4, "little") + b"INFO"),
        "i32.wav": _wav(1, 32, 1, 8000, np.round(x * (1 << 31)).clip(-(1 << 31), (1 << 31) - 1).astype("<i4").tobytes()),
        "u8.wav": _wav(1, 8, 1, 8000, np.round(x * 128 + 128).clip(0, 255).astype(np.uint8).tobytes()),
    }
    for k, v in files.items():
        with open(os.path.join(tmp_dir, k), "wb") as fh:
            fh.write(v)
    df = spark.read.format("binaryFile").load(tmp_dir)
    got = {os.path.basename(r.path): (r.sr, np.array(r.samples)) for r in decode_wav(df).collect()}
    assert set(got) == set(files)
    for k, (sr, y) in got.items():
        assert sr == 8000
        np.testing.assert_allclose(y, np.clip(x, -1, 1 - 1 / 128), atol=1 / 127, err_msg=k)


def test_header_fields_skip_extra_chunks(spark, tmp_dir):
    x = (np.arange(1000) % 50 / 100.0).astype("<f4")
    pcm = np.round(x * 32767).astype("<i2").tobytes()
    listc = b"LIST" + (11).to_bytes(4, "little") + b"INFOmetadat" + bytes(1)      # odd size + pad byte
    with open(os.path.join(tmp_dir, "list.wav"), "wb") as fh:
        fh.write(_wav(1, 16, 2, 11025, pcm + pcm, extra_chunk=listc))
    df = spark.read.format("binaryFile").load(tmp_dir)
    h = header_fields(df).first()
    assert (h.channels, h.samplerate) == (2, 11025)
    assert abs(h.duration - 1000 / 11025) < 1e-12 and h.bitrate == 11025 * 4 * 8 / 1000.0


def test_ingest_from_objects_table_equals_folder(spark, wav_dir, tmp_dir):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(wav_dir)
    p_table = os.path.join(tmp_dir, "objects")
    files.select("path", "length", "content").write.parquet(p_table)
    objects = spark.read.parquet(p_table)
    p = S.MelParams(n_fft=256, hop=64, n_mels=16)
    a = I.ingest(spark, wav_dir, p)
    b = I.ingest(spark, wav_dir, p, objects=objects)
    assert a.catalog.exceptAll(b.catalog).count() == 0 and b.catalog.count() == 4
    assert a.audio.exceptAll(b.audio).count() == 0


def test_wav_objects_decode(spark):
    from sonara.sources.wav import decode_wav, wav_objects
    sig = spark.createDataFrame([(1, 8000, [0.0, 0.5, -0.5])], "song_id bigint, sr int, samples array<float>")
    r = decode_wav(wav_objects(sig, "x")).first()
    assert r.path == "x/000001.wav" and r.sr == 8000
    np.testing.assert_allclose(r.samples, [0.0, 0.5, -0.5], atol=1 / 32768)


def _stored(spark, out):
    return [sorted(map(tuple, spark.read.parquet(f"{out}/{t}").drop("first_id").collect()), key=repr) for t in ("catalog", "audio", "spec")]


def test_ingest_can_be_repeated_and_names_are_literal(spark, tmp_dir, monkeypatch):
    """A second run adds nothing, later files go on with the ids, a broken-off run is repeated."""
    p = S.MelParams(n_fft=64, hop=16, n_mels=4)
    root = os.path.join(tmp_dir, "in")
    os.makedirs(root)

    def add(*names):
        for i, n in enumerate(names):
            with open(os.path.join(root, n), "wb") as fh:
                fh.write(wav_bytes(np.sin(np.arange(100 + 10 * i) / 5), 8000))

    add("Song [Official Audio].wav", "a {b}.wav", "c*d?.wav", "e 100%.wav", "f.wav")
    out, again = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "again")
    assert I.ingest_batches(spark, root, out, 2, p) == 3
    first = _stored(spark, out)
    assert len(first[0]) == 5 and I.ingest_batches(spark, root, out, 2, p) == 0 and _stored(spark, out) == first
    add("0 new.wav", "z.wav")
    assert I.ingest_batches(spark, root, out, 2, p) == 1
    ids = {r.s3_key: int(r.song_id) for r in spark.read.parquet(f"{out}/catalog").collect()}
    assert ids["0 new.wav"] == 6 and ids["z.wav"] == 7 and len(set(ids.values())) == 7
    assert {r.song_id for r in spark.read.parquet(f"{out}/audio").select("song_id").distinct().collect()} == set(range(1, 8))
    # a run that breaks off between the tables of its second batch
    real, calls = S.spec_wide_db, []

    def broken(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **k)

    monkeypatch.setattr(S, "spec_wide_db", broken)
    with pytest.raises(RuntimeError):
        I.ingest_batches(spark, root, again, 3, p)
    monkeypatch.setattr(S, "spec_wide_db", real)
    I.ingest_batches(spark, root, again, 3, p)
    whole = os.path.join(tmp_dir, "whole")
    routes = {t: f"{whole}/{t}" for t in ("catalog", "audio", "spec")}
    I.ingest_batches(spark, root, routes, 100, p)
    assert _stored(spark, again) == _stored(spark, whole)


def test_many_chunks_before_the_data(spark):
    base = wav_bytes(np.arange(200) / 400.0, 8000)
    junk = b"".join(b"junk" + (3).to_bytes(4, "little") + b"abc\0" for _ in range(20))
    buf = base[:36] + junk + base[36:]
    df = spark.createDataFrame([("x", bytearray(buf))], "path string, content binary")
    h = header_fields(df).first()
    assert (h.channels, h.samplerate, h.filesize) == (1, 8000, len(buf)) and abs(h.duration - 200 / 8000) < 1e-12


def test_catalog_append_raises_on_a_damaged_table(spark, tmp_dir):
    p = os.path.join(tmp_dir, "damaged")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.parquet"), "wb") as fh:
        fh.write(b"not parquet")
    with pytest.raises(Exception):
        K.append_catalog(spark, p, spark.createDataFrame([("a",)], "s3_key string"))


def _info_chunk(tags):
    body = b"INFO"
    for name, text in tags:
        body += name + len(text).to_bytes(4, "little") + text + bytes(len(text) & 1)
    return b"LIST" + len(body).to_bytes(4, "little") + body


def test_text_tags_reach_the_catalog(spark, tmp_dir):
    tags = [(b"INAM", b"A tune\0"), (b"IART", "J\u00f6rg".encode()), (b"IPRD", b"Caf\xe9"), (b"IGNR", b""), (b"ICRD", b"1999"),
            (b"IART", b"second artist"), (b"ISFT", b"not a catalog field"), (b"ITRK", b"7")]
    base = wav_bytes(np.arange(200) / 400.0, 8000)
    before = base[:36] + _info_chunk(tags) + base[36:]
    after = base + _info_chunk(tags)
    cut = base + _info_chunk(tags)[:30]      # the file ends inside the list
    for k, v in {"a.wav": before, "b.wav": after, "c.wav": cut, "d.wav": base}.items():
        with open(os.path.join(tmp_dir, k), "wb") as fh:
            fh.write(v)
    cat = {r.s3_key: r for r in I.ingest(spark, tmp_dir, S.MelParams(n_fft=256, hop=64, n_mels=16)).catalog.collect()}
    for k in ("a.wav", "b.wav"):
        r = cat[k]
        assert (r.title, r.artist, r.album, r.genre, r.year, r.track) == ("A tune", "J\u00f6rg", "Caf\u00e9", "None", "1999", "7")
        assert (r.channels, r.samplerate) == ("1", "8000")
    assert cat["c.wav"].title == "A tune" and cat["c.wav"].year == "None"
    assert cat["d.wav"].title == "None"


@pytest.mark.parametrize("ch", [1, 2])
def test_decoder_memory_does_not_grow_with_the_file(monkeypatch, ch):
    import tracemalloc

    import pyarrow as pa

    from sonara.sources import wav as W
    monkeypatch.setattr(W, "DECODE_SAMPLES", 1 << 14)
    step, halo, peaks = 4096, 512, []
    for n in (1 << 18, 1 << 21):
        x = np.sin(np.arange(n * ch) / 50.0).reshape(n, ch)
        rb = pa.RecordBatch.from_pydict({"path": ["a", "b"], "content": pa.array([W.wav_bytes(x, 8000, ch), b"junk"])})
        whole = next(W._decoder(["path"], False, None, 0)([rb])).column("samples")[0].values.to_numpy()
        tracemalloc.start()
        start, seen = 0, 0
        for out in W._decoder(["path"], True, step, halo)([rb]):
            assert len(out.column("ext").flatten()) <= (1 << 14) + step + 2 * halo
            for r in out.to_pylist() if n == 1 << 18 else ():
                if r["ext"] is not None:
                    np.testing.assert_array_equal(np.float32(r["ext"]), whole[r["ext_start"]:r["k"] * step + step + halo])
                    assert r["n_samples"] == n
                    seen += 1
            start += out.num_rows
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert start == n // step + 1 and seen in (0, n // step)
    assert peaks[1] < 4 << 20      # the long file has 4 or 8 MB of PCM bytes


def test_first_files_is_a_top_k(spark):
    from sonara.operators import catalog as C
    df = spark.createDataFrame([(k,) for k in "dbeac"], "s3_key string")
    top = C.first_files(df, 3)
    assert sorted(top.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert C.first_files(df.where("false"), 3).count() == 0


class Counting:
    """An open file that counts what is read."""

    def __init__(self, uri):
        from sonara.sources.files import open_file
        self.f, self.got, self.calls = open_file(uri), 0, 0

    def size(self):
        return self.f.size()

    def read_at(self, n, at):
        data = self.f.read_at(n, at)
        self.got += len(data)
        self.calls += 1
        return data


def _sparse_wav(path, n_samples, ones_at=()):
    """16-bit mono at 44.1 kHz whose samples are zero (a hole in the file) but for a few."""
    head = wav_bytes(np.zeros(0), 44100)
    data = 2 * n_samples
    with open(path, "wb") as fh:
        fh.write(head[:4] + (36 + data).to_bytes(4, "little") + head[8:40] + data.to_bytes(4, "little"))
        for i in ones_at:
            fh.seek(44 + 2 * i)
            fh.write((16384).to_bytes(2, "little"))
        fh.seek(44 + data)
        fh.write(_info_chunk([(b"INAM", b"long")]))


def test_heads_read_as_much_of_a_long_file_as_of_a_short_one(tmp_dir):
    from sonara.sources.wav import head_of

    read = []
    for n in (1 << 20, 1500 << 20):
        path = os.path.join(tmp_dir, f"{n}.wav")
        _sparse_wav(path, n)
        f = Counting("file:" + path)
        row = head_of(f)
        assert (row["frames"], row["data_at"], row["title"], row["samplerate"], row["data"]) == (n, 44, "long", 44100, 2 * n)
        read.append((f.got, f.calls))
    assert read[0] == read[1] and read[1][0] < 20_000 and read[1][1] < 8


def test_a_file_of_three_gigabytes_is_decoded_by_many_tasks(spark, tmp_dir):
    from sonara.sources.wav import decode_ranges, file_heads

    n, piece, halo = 1500 << 20, 1 << 17, 1024
    marks = [0, piece - 1, piece, 700_000_003, n - 1]
    path = os.path.join(tmp_dir, "long.wav")
    _sparse_wav(path, n, marks)
    heads = file_heads(spark.createDataFrame([(f"file:{path}",)], "path string"))
    out = decode_ranges(heads, piece, halo)
    assert "BinaryFile" not in out._jdf.queryExecution().toString()

    def look(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        for b in batches:
            xs, lo = b.column(5), b.column(4).to_pylist()
            values = xs.flatten().to_numpy()
            sizes = xs.value_lengths().to_numpy()
            first = np.cumsum(sizes) - sizes
            at = [[int(lo[i] + j) for j in np.flatnonzero(values[f:f + s])] for i, (f, s) in enumerate(zip(first, sizes))]
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()] * len(at), "size": sizes.astype(np.int64), "at": pa.array(at, pa.list_(pa.int64()))})

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))   # this session's JVM is small
    try:
        found = (out.mapInArrow(look, "task long, size long, at array<long>").groupBy("task")
                 .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("size").alias("most"),
                      F.flatten(F.collect_list("at")).alias("at")).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    pieces = n // piece
    assert sum(r.n for r in found) == pieces and len(found) >= 40 and max(r.n for r in found) <= 3 * pieces // len(found)
    assert max(r.most for r in found) == piece + 2 * halo
    assert sum(r["size"] for r in found) == n + 2 * halo * (pieces - 1)
    assert sorted({x for r in found for x in r["at"]}) == marks


def test_ranges_equal_whole_file_decoding(spark, wav_dir, monkeypatch):
    from sonara.sources import wav as W

    monkeypatch.setattr(W, "RANGE_BYTES", 3000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(wav_dir)
    want = W.decode_wav(files, piece=256, halo=64)
    got = W.decode_ranges(W.file_heads(files.select("path")), 256, 64)
    assert got.schema == want.schema and want.count() > 60
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    a, b = W.header_fields(files.select("path", "content")), W.file_heads(files.select("path"))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))
