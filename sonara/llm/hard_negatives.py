"""Hard-negative mining with exact Four-Russians scores.

A vector's components are integers in two's complement. A candidate is held as bit planes: for
every bit, one byte per group of eight dimensions. For a block of anchors a table holds, per group,
the 256 subset sums of the anchor's eight components. A score is then read, not multiplied: per
plane the groups' table rows named by the candidate's bytes are added, and the planes are joined by
shift and add, the sign plane subtracted. Scores are full and exact.

The anchors are a stated query set; they go in rounds of about ``ROUND_ANCHORS`` (a broadcast of
bounded size), each against all rows where these lie, without a shuffle of candidates. A task keeps
the best k per slot (an anchor's positives, then the negatives of each anchor and positive) and
hands on only these. A 32nd of the rows, chosen by hash, goes first: its k-th best score per slot is
a lower bound that keeps most of the other tasks' entries from being handed on at all.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part;
vectors of unequal length count missing components as 0; a null vec_id is never an anchor and comes last
in ties; rows that repeat a vec_id or a vector are rows of their own, settled by their place in the
table; components beyond a long are cut to it and sums are taken modulo 2^64, so every score that fits
a long is exact; an empty table, or one without anchors or positives, gives no rows; other columns are
ignored, whatever their names. ``vec_id`` and ``label`` are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sonara.session import scratch_path

from .common import staged

SCALE = 256
ROUND_ANCHORS = 8192   # anchors of a round: 4 KB of tables each in a task, at 64 dimensions
TABLE_ANCHORS = 512    # anchors scored together
CHUNKS = (64, 128, 256, 512, 1024)  # candidates scored together: few at first, until bounds are known
LEAD = 32              # one row in so many goes first
KEPT_HITS = 1 << 20    # hits a task holds before it cuts them back to the best


def quantised(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(rows taking part, their components as one integer matrix): floor(SCALE * x), zero-padded."""
    n, sizes = len(lists), np.asarray(lists.value_lengths().fill_null(0))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
    row = np.repeat(np.arange(n), sizes)
    good = np.asarray(lists.is_valid()) & (np.bincount(row[~np.isfinite(values)], minlength=n) == 0)
    out = np.zeros((n, int(sizes.max(initial=0))), dtype=np.int64)
    keep = good[row]
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(SCALE * values[keep]), -2.0 ** 63, np.nextafter(2.0 ** 63, 0))
    out[row[keep], at[keep]] = scaled.astype(np.int64)
    return np.flatnonzero(good), out[good]


def bit_planes(ints: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes; the last plane is the sign."""
    top = int(np.maximum(ints, ~ints).max(initial=0))
    planes = top.bit_length() + 1
    return np.stack([np.packbits((ints >> b & 1).astype(bool), axis=1, bitorder="little") for b in range(planes)], axis=1)


def _room(bound: int, narrowest=np.int16):
    return next((t for t in (np.int16, np.int32) if np.dtype(t).itemsize >= np.dtype(narrowest).itemsize
                 and bound < np.iinfo(t).max), np.int64)


class SubsetSums:
    """Tables of a block of anchors: per group of eight dimensions, one row of sums for each byte."""

    def __init__(self, ints: np.ndarray):
        n, dims = ints.shape
        self.groups = -(-dims // 8)
        wide = np.zeros((n, 8 * self.groups), dtype=np.int64)
        wide[:, :dims] = ints
        self.bound = int(np.abs(wide.astype(np.float64)).sum(axis=1).max(initial=0)) + 1
        parts = wide.reshape(n, self.groups, 8).transpose(1, 2, 0)
        self.sums = np.zeros((self.groups, 256, n), dtype=_room(self.bound))
        for j in range(8):
            half = 1 << j
            self.sums[:, half:2 * half] = self.sums[:, :half] + parts[:, j][:, None, :].astype(self.sums.dtype)

    def score(self, planes: np.ndarray) -> np.ndarray:
        """(candidates, anchors): sums of looked-up rows per plane, joined by shift and add."""
        n, bits, groups = planes.shape
        kind = _room(self.bound << bits, np.int32)
        out = np.zeros((n, self.sums.shape[2]), dtype=kind)
        one = np.empty(out.shape, dtype=self.sums.dtype)
        for b in range(bits - 1, -1, -1):
            plane = np.zeros(out.shape, dtype=self.sums.dtype)
            for g in range(min(groups, self.groups)):
                plane += np.take(self.sums[g], planes[:, b, g], axis=0, out=one, mode="clip")
            out <<= 1
            if b == bits - 1:
                out -= plane
            else:
                out += plane
        return out


class Best:
    """The best k hits of every slot: higher scores first, then smaller ids, then earlier rows."""

    def __init__(self, slots: int, k: int, floor: np.ndarray):
        self.k, self.floor, self.held, self.n = k, floor.copy(), [], 0

    def add(self, slot, score, vec_id, none, row):
        if len(slot):
            self.held.append((slot, score.astype(np.int64), vec_id, none, row))
            self.n += len(slot)
            if self.n > KEPT_HITS:
                self.cut()

    def cut(self):
        if not self.held:
            return
        slot, score, vec_id, none, row = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((row, vec_id, none, ~score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.floor[slot[rank == self.k - 1]] = np.maximum(self.floor[slot[rank == self.k - 1]], score[full])
        self.held = [(slot[rank < self.k], score[keep], vec_id[keep], none[keep], row[keep])]
        self.n = len(keep)


def coded(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """vec_id, label, row, groups, code (bit planes), ints (anchors only), lead: staged, ``lead`` as folders."""
    spark = rows.sparkSession

    def code(batches):
        for b in batches:
            take, ints = quantised(b.column(2))
            if not len(take):
                continue
            planes = bit_planes(ints)
            anchor = b.column(3).to_numpy(zero_copy_only=False)[take]
            kept = [b.column(i).take(pa.array(take)) for i in (0, 1, 4)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.full(len(take), planes.shape[2], np.int32)), pa.array([p.tobytes() for p in planes], pa.binary()),
                 pa.array([x.tobytes() if a else None for x, a in zip(ints, anchor)], pa.binary())],
                names=["vec_id", "label", "row", "groups", "code", "ints"])

    source = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                         F.col("embedding").cast("array<double>").alias("embedding"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor")).where("label IS NOT NULL AND embedding IS NOT NULL")
    source = source.withColumn("row", F.monotonically_increasing_id())
    out = source.mapInArrow(code, "vec_id long, label long, row long, groups int, code binary, ints binary")
    path = scratch_path(spark, "codes")
    (out.withColumn("lead", F.pmod(F.xxhash64("row"), F.lit(LEAD)) == 0).sortWithinPartitions("lead", "label")
     .write.partitionBy("lead").parquet(path))
    return spark.read.schema("vec_id long, label long, row long, groups int, code binary, ints binary, lead boolean").parquet(path)


def _scan(sent, same: bool, k: int):
    """The best ``k`` rows of each slot in a task. Slot = anchor * slots per anchor + position; a row counts where its
    score lies in the slot's range and its label is the anchor's (``same``; never the anchor itself), or is not."""
    def run(batches):
        a = sent.value
        low, high = a["low"], a["high"]              # (anchors, slots per anchor)
        n, per = low.shape
        best = Best(n * per, k, low.reshape(-1))
        tables = {}

        def chunks(size):
            at = 0
            for c in CHUNKS:
                if at < size:
                    yield at, min(size, at + c)
                    at += c
            for s in range(at, size, CHUNKS[-1]):
                yield s, min(size, s + CHUNKS[-1])

        def table(key, members):
            if key not in tables:
                tables[key] = SubsetSums(a["ints"][members])
            return tables[key]

        def meet(key, members, planes, label, vec_id, none, row):
            t = table(key, members)
            for lo, hi in chunks(len(row)):
                s = t.score(planes[lo:hi])
                least, most = np.iinfo(s.dtype).min, np.iinfo(s.dtype).max
                may = (row[lo:hi, None] != a["row"][members]) if same else (label[lo:hi, None] != a["label"][members])
                for p in range(per):
                    slot = members * per + p
                    floor, top = (np.clip(x, least, most).astype(s.dtype) for x in (best.floor[slot], high[members, p]))
                    i, j = np.nonzero((s >= floor) & (s <= top) & may)
                    best.add(slot[j], s[i, j], vec_id[lo + i], none[lo + i], row[lo + i])
                best.cut()

        for b in batches:
            groups = b.column(3).to_numpy()
            sizes = np.array([len(x.as_buffer()) for x in b.column(4)], dtype=np.int64)
            vec_id = b.column(0).fill_null(0).to_numpy()
            none, label, row = np.asarray(b.column(0).is_null()), b.column(1).to_numpy(), b.column(2).to_numpy()
            kind = np.stack([groups, sizes], axis=1)
            for gs, size in np.unique(kind, axis=0):
                rows = np.flatnonzero((groups == gs) & (sizes == size))
                if not size:
                    planes = np.zeros((len(rows), 1, 0), np.uint8)
                else:
                    raw = b"".join(b.column(4)[int(r)].as_buffer().to_pybytes() for r in rows)
                    planes = np.frombuffer(raw, np.uint8).reshape(len(rows), -1, gs)
                sets = [(rows, np.arange(len(rows)), None)]
                if same:
                    sets = [(rows[x], x, v) for v in np.unique(label[rows]) for x in (np.flatnonzero(label[rows] == v),)]
                for own, at, v in sets:
                    members = np.flatnonzero(a["label"] == v) if same else np.arange(n)
                    for s in range(0, len(members), TABLE_ANCHORS):
                        meet((v, s), members[s:s + TABLE_ANCHORS], planes[at], label[own], vec_id[own], none[own], row[own])
        best.cut()
        for slot, score, vec_id, none, row in best.held:
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(vec_id, mask=none), pa.array(row), pa.array(score)],
                                             names=["slot", "vec_id", "row", "score"])
    return run


def _best(codes: DataFrame, anchors: dict, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> DataFrame:
    """slot, rank, vec_id, row, score: the best ``k`` of every slot, the leading rows first."""
    spark = codes.sparkSession
    found, floor = None, low
    ordered = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    for lead in (True, False):
        sent = spark.sparkContext.broadcast({**anchors, "low": floor, "high": high})
        part = codes.where(F.col("lead") == lead).select("vec_id", "label", "row", "groups", "code")
        hits = part.mapInArrow(_scan(sent, same, k), "slot long, vec_id long, row long, score long")
        hits = hits if found is None else hits.union(found.select("slot", "vec_id", "row", "score"))
        found = staged(hits.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k), "best")
        sent.unpersist()
        if lead:
            floor = low.copy()
            for x in found.where(F.col("rank") == k).select("slot", "score").collect():  # at most a row per slot of the round
                floor.reshape(-1)[x["slot"]] = x["score"]
    return found


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_pct: int = 30,
         high_pct: int = 90, round_anchors: int = ROUND_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best other rows of the same label; the negatives of a positive are the best
    rows of other labels whose score lies between ``low_pct`` and ``high_pct`` hundredths of the positive's."""
    spark = rows.sparkSession
    codes = coded(rows, is_anchor)
    marked = codes.where("ints IS NOT NULL").select("row", "vec_id", "label", "ints")
    n_rounds = -(-marked.count() // round_anchors)
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for r in range(n_rounds):
        mine_now = marked.where(F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(n_rounds)) == r).orderBy("row").collect()  # about round_anchors
        if not mine_now:
            continue
        n = len(mine_now)
        ints = np.zeros((n, max(len(x["ints"]) for x in mine_now) // 8), dtype=np.int64)
        for i, x in enumerate(mine_now):
            own = np.frombuffer(x["ints"], np.int64)
            ints[i, :len(own)] = own
        anchors = {"ints": ints, "row": np.array([x["row"] for x in mine_now]), "label": np.array([x["label"] for x in mine_now])}
        pairs = _best(codes, anchors, np.full((n, 1), least), np.full((n, 1), most), True, positives).collect()  # bounded alike
        low, high, names = np.full((n, positives), most), np.full((n, positives), least), []
        for x in pairs:
            s, k, score = x["slot"], x["rank"] - 1, x["score"]
            low[s, k], high[s, k] = -(-score * low_pct // 100), score * high_pct // 100
            names.append((s * positives + k, mine_now[s]["vec_id"], x["vec_id"], score))
        if not pairs:
            continue
        negative = _best(codes, anchors, low, high, False, negatives)
        named = spark.createDataFrame(names, "slot long, anchor_id long, positive_id long, positive_score long")
        (negative.join(named, "slot").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                                             F.col("score").alias("negative_score"))
         .write.mode("append").parquet(path))
    spark.createDataFrame([], schema).write.mode("append").parquet(path)  # the folder exists in any case
    return spark.read.schema(schema).parquet(path)
