"""Token-id files: a wavelet matrix per shard.

Documents are put in ascending doc_id order by one range shuffle of their texts. A task encodes its
documents, appends the end id, and closes a shard after the document that brings it to
``SHARD_TOKENS`` ids. A shard becomes one compressed file: bit plane by bit plane, high bit first, the
ids of a plane stably parted into zeros and ones for the next plane. Every plane is cut into blocks of
``BLOCK_BITS`` bits, compressed one by one, with the number of ones before each block. So one id, the
count of an id in a range, or its k-th occurrence opens a block per plane, and nothing else.

``write_files`` writes a table of one Parquet file per shard: the blob and the shard's documents with
their lengths. ``read_ids``, ``count_token`` and ``find_token`` need no other data.

Defined results: null text counts as empty (its only id is the end id); a null doc_id comes first;
equal doc_ids lie next to each other, ordered by text hash, then place in the table, so a doc_id that
many rows share spreads over shards; repeated rows are written again; very long texts are taken
whole and stay in one shard; an empty table gives an empty folder of files; other columns are
ignored, whatever their names. ``docs`` must be a table or a staged frame (rows in a fixed order).
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from . import bpe_files
from .common import per_worker
from .rank_merge import Memo, RankMerger
from .token_counts import slices

SHARD_TOKENS = 1 << 22
BLOCK_BITS = 1 << 16
END_ID = 2
MEMO_WORDS = 500_000
# The file begins with this mark and the numbers of ids, planes and bits per block (little-endian)
MARK, HEAD = b"SWM1", "<4sQII"


class Recent(Memo):
    """Known words, and those of the generation before, which come over when they are met again."""

    def __init__(self, before: dict | None = None):
        super().__init__()
        self.before = before or {}

    def __missing__(self, word: str):
        got = self.before.get(word, word)
        if got is word:
            self.new.append(word)
        self[word] = got
        return got


class WordEncoder:
    """Token ids of texts as a word-end BPE file states.

    No pre-token has white space, so the ids of whole words (runs without white space) are kept, and those
    of pre-tokens: two generations of about ``MEMO_WORDS``."""

    def __init__(self, path: str, pattern: tuple):
        spec = bpe_files.load(path)
        vocab, self.special = spec["vocab"], spec["special"]
        chars = bpe_files.byte_chars()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[chars[b] + spec["suffix"]] for b in range(256)], dtype=np.int64)
        self.merger = RankMerger(spec["merges"], max(vocab.values()) + 1)
        self.find = bpe_files.finder(pattern)
        self.solid = re.compile(f"[^{bpe_files.WHITE_SPACE}]+").findall
        self.memo = Recent()

    def learn(self, new: list[str]) -> None:
        """Ids of pre-tokens."""
        raw = [w.encode("utf-8") for w in new]
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        flat, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum(lengths) - 1
        sym = self.inner[flat]
        sym[ends] = self.last[flat[ends]]
        ids, left = self.merger.merge(sym, lengths)
        block, at = ids.astype("<u4").tobytes(), 0
        for w, e in zip(new, (np.cumsum(left) * 4).tolist()):
            self.memo[w] = block[at:e]
            at = e

    def learn_words(self, new: list[str]) -> None:
        memo, single, several = self.memo, [], []
        for w in new:
            pre = None if w.isalpha() else self.find(w)  # letters alone are one pre-token
            if pre is None or len(pre) == 1:
                single.append(w)
            else:
                several.append((w, pre))
        noted = len(new)
        for _, pre in several:
            for p in pre:
                memo[p]  # notes an unknown one
        self.learn(single + new[noted:])
        for w, pre in several:
            memo[w] = b"".join([memo[p] for p in pre])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.memo) > MEMO_WORDS or self.memo.new:
            self.memo = Recent(None if self.memo.new else dict(self.memo))
        memo, out, late = self.memo, [], []
        for t in texts:
            parts: list = []
            for piece in bpe_files.split_specials(t, self.special):
                if isinstance(piece, str):
                    if not piece.isascii():  # one final form of sigma, as lower-casing char by char gives
                        piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                    piece = piece.lower()
                    # split() parts at four more characters than white space
                    odd = "\x1c" in piece or "\x1d" in piece or "\x1e" in piece or "\x1f" in piece
                    parts += map(memo.__getitem__, self.solid(piece) if odd else piece.split())
                else:
                    parts.append(piece.to_bytes(4, "little"))
            try:
                out.append(b"".join(parts))
            except TypeError:  # words to be learned
                late.append((len(out), parts))
                out.append(b"")
        if memo.new:
            self.learn_words(memo.new)
            memo.new.clear()
            for i, parts in late:
                out[i] = b"".join([p if p.__class__ is bytes else memo[p] for p in parts])
        return out


def build(ids: np.ndarray) -> bytes:
    """The file of one shard's ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    planes = max(1, int(ids.max(initial=0)).bit_length())
    now = ids.astype(np.uint16) if planes <= 16 else ids
    n, pack = len(ids), zstandard.ZstdCompressor(level=1)
    head, blocks = [struct.pack(HEAD, MARK, n, planes, BLOCK_BITS)], []
    for b in range(planes - 1, -1, -1):
        bit, small, ones, low, high = now.dtype.type(1 << b), [], [], [], []
        for i in range(0, n, BLOCK_BITS):  # block by block: what is parted lies in the cache
            part = now[i:i + BLOCK_BITS]
            one = (part & bit).astype(bool)
            small.append(pack.compress(np.packbits(one, bitorder="little")))
            high.append(np.compress(one, part))  # much faster than by masks
            low.append(np.compress(~one, part))
            ones.append(len(high[-1]))
        ones = np.array(ones, dtype=np.uint64)
        before = np.cumsum(ones) - ones
        head += [struct.pack("<Q", int(ones.sum())), before.astype("<u8").tobytes(),
                 np.array([len(s) for s in small], dtype="<u4").tobytes()]
        blocks += small
        if b and n:
            now = np.concatenate(low + high)
    return b"".join(head + blocks)


class WaveletMatrix:
    """Queries on the bytes of a file; only the blocks a query meets are opened (and kept)."""

    def __init__(self, data):
        self.data = memoryview(data)
        mark, self.n, self.planes, self.block = struct.unpack_from(HEAD, self.data)
        if mark != MARK:
            raise ValueError("not a token file")
        n_blocks = -(-self.n // self.block)
        at = struct.calcsize(HEAD)
        self.zeros, self.before, sizes = [], [], []
        for _ in range(self.planes):
            ones = struct.unpack_from("<Q", self.data, at)[0]
            self.zeros.append(self.n - ones)
            self.before.append(np.frombuffer(self.data, "<u8", n_blocks, at + 8).astype(np.int64))
            sizes.append(np.frombuffer(self.data, "<u4", n_blocks, at + 8 + 8 * n_blocks).astype(np.int64))
            at += 8 + 12 * n_blocks
        ends = at + np.cumsum(np.concatenate(sizes)).reshape(self.planes, n_blocks) if n_blocks else np.zeros((self.planes, 0), np.int64)
        self.places = [list(zip((e - s).tolist(), e.tolist())) for e, s in zip(ends, sizes)]
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _raw(self, level: int, k: int) -> np.ndarray:
        start, end = self.places[level][k]
        return np.frombuffer(self.unpack(self.data[start:end]), np.uint8)

    def _bits(self, level: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(bits, ones up to each bit) of a block."""
        if (level, k) not in self.open:
            size = min(self.block, self.n - k * self.block)
            bits = np.unpackbits(self._raw(level, k), count=size, bitorder="little")
            self.open[level, k] = bits, np.append(0, np.cumsum(bits, dtype=np.int64))
        return self.open[level, k]

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        if at >= self.n:
            return self.n - self.zeros[level]
        k, r = divmod(at, self.block)
        return int(self.before[level][k] + self._bits(level, k)[1][r])

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.planes):
            bit = int(self._bits(level, at // self.block)[0][at % self.block])
            ones = self._ones(level, at)
            value, at = value << 1 | bit, self.zeros[level] + ones if bit else at - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` from ``lo`` to ``hi`` lie after the last plane."""
        lo, hi = max(0, lo), min(self.n, hi)
        if not 0 <= token < 1 << self.planes:
            return 0, 0
        for level in range(self.planes):
            a, b = self._ones(level, lo), self._ones(level, max(lo, hi))
            if token >> (self.planes - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, max(lo, hi) - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id at positions ``lo`` to ``hi`` (not included)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, bit: int, ranks: np.ndarray) -> np.ndarray:
        """Positions of the ones (zeros) of a plane with the given ranks, ascending."""
        before = self.before[level] if bit else np.arange(len(self.before[level])) * self.block - self.before[level]
        k = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for block in np.unique(k):
            mine = k == block
            out[mine] = block * self.block + np.flatnonzero(self._bits(level, block)[0] == bit)[ranks[mine] - before[block]]
        return out

    def find(self, token: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ascending positions of an id."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        at = np.arange(a, max(a, b))
        for level in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of an id."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = np.array([a + k])
        for level in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return int(at[0])

    def decode(self) -> np.ndarray:
        """All ids, in order: the planes are joined from the last to the first."""
        ids = np.zeros(self.n, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for level in range(self.planes - 1, -1, -1):
            bit, above = ids.dtype.type(1 << (self.planes - 1 - level)), np.empty_like(ids)
            low, high = 0, self.zeros[level]
            for k in range(len(self.places[level])):  # block by block: what is joined lies in the cache
                block = above[k * self.block:(k + 1) * self.block]
                one = np.unpackbits(self._raw(level, k), count=len(block), bitorder="little").view(bool)
                at = np.flatnonzero(one)
                block[at] = ids[high:high + len(at)] | bit
                high += len(at)
                zeros = len(block) - len(at)
                block[np.flatnonzero(~one)] = ids[low:low + zeros]
                low += zeros
            ids = above
        return ids.astype(np.uint32)


def write_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> None:
    """Token files of all documents in ascending doc_id order below ``path``, one Parquet file per shard:
    part, shard (in the part), doc_id array, n_tokens array, matrix (the file's bytes)."""
    vocabulary = vocabulary or bpe_files.public_path("word_bpe_49k.json")
    pattern = bpe_files.split_patterns()["bare"]
    spark = docs.sparkSession
    end = int(end_id).to_bytes(4, "little")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    order = ["doc_id", "__h", "__at"]
    placed = (rows.withColumn("__h", F.xxhash64("text")).withColumn("__at", F.monotonically_increasing_id())
              .repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text"))

    def shards(batches):
        encoder = per_worker(("word_bpe_ids", vocabulary), lambda: WordEncoder(vocabulary, pattern))
        part, shard, ids, docs_in, sizes, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close():
            data = build(np.frombuffer(b"".join(ids), "<u4"))
            doc_ids = pa.concat_arrays(docs_in)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["part", "shard", "doc_id", "n_tokens", "matrix"])

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s in slices(texts):
                for i, x in zip(range(s.start, s.stop), encoder.encode(texts[s])):
                    ids.append(x + end)
                    sizes.append(len(x) // 4 + 1)
                    docs_in.append(b.column(0).slice(i, 1))
                    held += sizes[-1]
                    if held >= shard_tokens:
                        yield close()
                        shard, ids, docs_in, sizes, held = shard + 1, [], [], [], 0
        if ids:
            yield close()

    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                           T.StructField("doc_id", T.ArrayType(kind)), T.StructField("n_tokens", T.ArrayType(T.LongType())),
                           T.StructField("matrix", T.BinaryType())])
    (placed.mapInArrow(shards, schema).write.mode("errorifexists")
     .option("compression", "uncompressed").option("maxRecordsPerFile", 1).parquet(path))


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, shard, base: ids of all shards before each; the sums read no matrix, one row per shard."""
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.parquet(path).select("part", "shard", total.alias("total"))
            .select("part", "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian unsigned 32-bit) of every
    document; with ``digest`` ids_crc32 in place of the ids."""
    files = spark.read.parquet(path).select("part", "shard", "doc_id", "n_tokens", "matrix")
    kind = files.schema["doc_id"].dataType.elementType.simpleString()

    def read(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids = WaveletMatrix(b.column(4)[r].as_buffer()).decode().astype("<u4").tobytes()
                n = b.column(3)[r].values.to_numpy()
                ends = np.cumsum(n) * 4
                parts = [ids[e - 4 * k:e] for e, k in zip(ends.tolist(), n.tolist())]
                for at in range(0, len(n), 1000):   # bounded batches to Spark
                    some = slice(at, at + 1000)
                    last = pa.array([zlib.crc32(x) for x in parts[some]], pa.int64()) if digest else pa.array(parts[some], pa.binary())
                    size = len(last)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(r, 1).take(pa.array(np.zeros(size, np.int32))), b.column(1).slice(r, 1).take(pa.array(np.zeros(size, np.int32))),
                         b.column(2)[r].values.slice(at, size), pa.array(ends[some] // 4 - n[some]), pa.array(n[some]), last],
                        names=["part", "shard", "doc_id", "start", "n_tokens", last_name])

    last_name = "ids_crc32" if digest else "ids"
    rows = files.mapInArrow(read, f"part int, shard int, doc_id {kind}, start long, n_tokens long, {last_name} {'long' if digest else 'binary'}")
    return (rows.join(shard_starts(spark, path), ["part", "shard"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", last_name))


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id, start, n: how often an id occurs in each document that has it, from rank queries alone."""
    return _lookup(spark, path, lambda m, lo, hi: [m.count(token, lo, hi)], "n long").where("n > 0")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id, start, position (in the document): every occurrence of an id, from select queries alone."""
    return _lookup(spark, path, lambda m, lo, hi: (m.find(token, lo, hi) - lo).tolist(), "position long")


def _lookup(spark: SparkSession, path: str, query, field: str) -> DataFrame:
    files = spark.read.parquet(path).select("part", "shard", "doc_id", "n_tokens", "matrix")
    kind = files.schema["doc_id"].dataType.elementType.simpleString()
    name = field.split()[0]

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                matrix, n = WaveletMatrix(b.column(4)[r].as_buffer()), b.column(3)[r].values.to_numpy()
                ends, ids = np.cumsum(n), b.column(2)[r].values
                for at in range(0, len(n), 1000):
                    found = [(i, e - k, x) for i, e, k in zip(range(at, len(n)), ends[at:at + 1000].tolist(), n[at:].tolist())
                             for x in query(matrix, e - k, e)]
                    row, start, value = zip(*found) if found else ((), (), ())
                    zero = pa.array(np.zeros(len(row), np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(r, 1).take(zero), b.column(1).slice(r, 1).take(zero), ids.take(pa.array(row, pa.int32())),
                         pa.array(start, pa.int64()), pa.array(value, pa.int64())], names=["part", "shard", "doc_id", "start", name])

    rows = files.mapInArrow(run, f"part int, shard int, doc_id {kind}, start long, {field}")
    return (rows.join(shard_starts(spark, path), ["part", "shard"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), name))
