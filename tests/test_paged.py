"""Paged listings: key order, what is opened, broken-off runs, second runs."""

import os

import pytest

from sonara.sources.paged import children_of, find_prefixes, keys_after, list_in_pages
from sonara.sources.wav import wav_bytes
from sonara.streaming.ingest import ingest_pages

KEYS = ["a.wav", "a/1.wav", "a/b/2.wav", "a/b/3.wav", "a/c.wav", "a-z/4.wav", "b/x/y/z/5.wav", "b/6 [7].wav",
        "é/8.wav", "c/%20.wav", "c/n.txt", "_hidden/9.wav", "k=1/.tmp", "k=1/_SUCCESS", "k=1/_v=2/10.wav"]
SEEN = sorted(k for k in KEYS if k not in ("_hidden/9.wav", "k=1/.tmp", "k=1/_SUCCESS"))


def put(root, key, data=None):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(wav_bytes([0.1, 0.2], 8000) if data is None else data)


@pytest.fixture()
def root(tmp_dir):
    top = os.path.join(tmp_dir, "in")
    for k in KEYS:
        put(top, k)
    return top


@pytest.mark.parametrize("page", [1, 2, 3, 100])
def test_pages_are_the_sorted_keys_and_open_no_folder_of_files_twice(root, page):
    opened, got, after, done = [], [], "", False
    children = children_of(root)

    def spy(prefix):
        opened.append(prefix)
        return children(prefix)

    while not done:
        opened_before = len(opened)
        for key, _, _, end in keys_after(spy, "", True, after, page):
            if key is None:
                done = end
            else:
                got.append(key)
        again = set(opened[:opened_before]) & set(opened[opened_before:])
        assert all(after.startswith(p) for p in again)   # only folders around the last key
        after = got[-1]
    assert got == SEEN


def test_a_page_holds_a_folder_of_files_whole(tmp_dir):
    for i in range(50):
        put(tmp_dir, f"d/{i:02d}.wav", b"")
    rows = list(keys_after(children_of(tmp_dir), "d/", True, "", 10))
    assert len(rows) == 51 and rows[-1][3] is True


@pytest.mark.parametrize("depth,page", [(1, 1), (1, 100), (2, 2), (3, 1)])
def test_every_key_once(spark, root, tmp_dir, depth, page):
    out = []
    n = list_in_pages(spark, root, os.path.join(tmp_dir, "place"), lambda p: out.extend(r.s3_key for r in p.collect()), page, depth)
    assert sorted(out) == SEEN and n >= 1


def test_prefixes_cover_all_levels(spark, root):
    got = {(r.prefix, r.deep) for r in find_prefixes(spark, root, 2).collect()}
    assert {("", False), ("a/", False), ("a/b/", True), ("b/x/", True), ("k=1/_v=2/", True)} <= got
    assert ("_hidden/", True) not in got


def test_empty_and_missing_roots(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "none"))
    seen = []
    list_in_pages(spark, os.path.join(tmp_dir, "none"), os.path.join(tmp_dir, "p1"), lambda p: seen.append(p.count()))
    assert sum(seen) == 0
    with pytest.raises(Exception):
        list_in_pages(spark, os.path.join(tmp_dir, "absent"), os.path.join(tmp_dir, "p2"), lambda p: None)


def test_a_broken_off_run_goes_on_behind_its_last_round(spark, root, tmp_dir):
    place, out, calls = os.path.join(tmp_dir, "place"), [], []

    def broken(page):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        out.extend(r.s3_key for r in page.collect())

    with pytest.raises(RuntimeError):
        list_in_pages(spark, root, place, broken, 1)
    first = set(out)
    assert 0 < len(first) < len(SEEN)
    list_in_pages(spark, root, place, broken, 1)
    assert sorted(out) == SEEN   # nothing of the first two rounds again


def test_later_keys_only_does_not_go_back(spark, tmp_dir):
    root, place = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "place")
    out = []
    take = lambda p: out.extend(r.s3_key for r in p.collect())
    put(root, "d/2024-01.wav")
    list_in_pages(spark, root, place, take, later_keys_only=True)
    for k in ("d/2024-02.wav", "d/2023-12.wav", "e/2023-01.wav"):
        put(root, k)
    out.clear()
    list_in_pages(spark, root, place, take, later_keys_only=True)
    assert sorted(out) == ["d/2024-02.wav", "e/2023-01.wav"]
    out.clear()
    list_in_pages(spark, root, place, take)   # a whole listing finds the early one too
    assert "d/2023-12.wav" in out and len(out) == 4


def test_ingest_in_pages_catalogues_each_file_once_and_opens_no_other(spark, root, tmp_dir):
    cat, place = os.path.join(tmp_dir, "cat"), os.path.join(tmp_dir, "place")
    put(root, "c/n.txt", b"no audio")
    ingest_pages(spark, root, cat, place, page_keys=1)
    put(root, "a/0.wav")
    put(root, "zz/last.wav")
    ingest_pages(spark, root, cat, place, page_keys=1)
    rows = spark.read.parquet(cat).collect()
    accepted = {k for k in SEEN if k != "c/n.txt"} | {"a/0.wav", "zz/last.wav"}
    assert {r.s3_key for r in rows} == accepted and len(rows) == len(accepted)
    assert sorted(r.song_id for r in rows) == list(range(1, len(rows) + 1))
    assert all(r.samplerate == 8000 for r in rows)
