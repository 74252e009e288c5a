"""Near-duplicate groups by circulant MinHash, with every link confirmed on full shingle sets.

1. One pass over the texts gives each document's set of hashed word shingles, its size, a
   128-bit fingerprint of the set, and its signature. All signature coordinates come from two
   permutations of the 64-bit numbers: the first is applied to a shingle once, the second to
   that value shifted round the circle by k for coordinate k. Only the band keys are kept.
2. Documents with equal sets form one class, numbered when the classes are written; links, hubs and
   components are between these numbers, and doc_ids come back at the end.
3. Rounds of links. Within a band bucket a round compares every class with one hub only, so a
   bucket of m classes costs m pairs. Classes that are linked need no further comparison
   inside their component; buckets whose classes lie in one component are done.
4. After ``HUB_ROUNDS`` rounds, classes outside the largest component of one of their buckets
   are compared with the other classes left that share one of their rarest shingles. Sets alike
   must share one of them, early enough to leave room for the overlap (the prefix and position
   tests of similarity joins), so no link between classes that share a bucket is lost, while
   classes that only share common passages never meet.
5. Components by smallest label, with the labels written to the shared folder every round.

At the threshold of 0.8 a pair shares none of the 40 bands of 5 coordinates with a
probability of about 1.2e-7.

Defined results: null or empty text and text without a word have the empty set, link with
nothing and are kept; every row is a document of its own, also where rows share a doc_id or have none: a
class takes its text from one row, told by doc_id and text; null doc_ids come after all others, so a
group has a null component_id (and its rows are kept) only where all its doc_ids are null; doc_ids may be of
any type that can be ordered; very long texts are taken whole; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import UPPER, LOWER, WORD, staged
from .token_counts import slices

SHINGLE = 5
THRESHOLD = 80  # percent
BANDS, ROWS = 40, 5
HUB_ROUNDS = 2
SEED = 0x5EED
SHIFT = 0x9E3779B97F4A7C15  # the unit of the circular shift; odd, so 2^64 shifts come round


def _mix(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 64-bit numbers: odd multiplications and shifted exclusive-ors."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(a)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(b)
    return x ^ (x >> np.uint64(31))


def first_permutation(x: np.ndarray) -> np.ndarray:
    return _mix(x + np.uint64(SEED), 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def second_permutation(x: np.ndarray) -> np.ndarray:
    """One multiplication and two folds are enough here: its input is already spread."""
    x = x * np.uint64(0x9FB21C651E98DF25)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band keys (one row per set) of non-empty sets of 64-bit hashes."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    base = first_permutation(np.concatenate(sets))
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for k in range(bands * rows):  # the circular shift: addition modulo 2^64
        shift = np.uint64(k * SHIFT % 2**64)
        low = np.minimum.reduceat(second_permutation(base + shift), starts)
        keys[:, k // rows] = _mix(keys[:, k // rows] + low + np.uint64(k), 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
    return keys


class Shingler:
    def __init__(self, size: int):
        import re

        self.size, self.find = size, re.compile(WORD).findall
        self.lower = str.maketrans(UPPER, LOWER)

    def word_hashes(self, texts: list[str | None]) -> list[np.ndarray]:
        """64-bit hashes of each text's words; equal words hash alike everywhere."""
        import xxhash

        h, memo = xxhash.xxh64_intdigest, {}
        out = []
        for t in texts:
            ws = self.find((t or "").translate(self.lower) if not (t or "").islower() else t)
            for w in set(ws).difference(memo):
                memo[w] = h(w.encode("utf-8"))
            out.append(np.fromiter(map(memo.__getitem__, ws), dtype=np.uint64, count=len(ws)))
        return out

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes; a shorter text is one shingle, no word gives the empty set."""
        out = []
        for ws in self.word_hashes(texts):
            n = min(self.size, len(ws))
            h = np.full(len(ws) - n + 1 if n else 0, np.uint64(n), dtype=np.uint64)
            for j in range(n):
                h = _mix(h + ws[j:j + len(h)], 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
            out.append(np.unique(h))
        return out


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, set_key (null for the empty set), bands."""
    rows_ = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    kind = rows_.schema["doc_id"].dataType.simpleString()

    def run(batches):
        shingler = Shingler(shingle)
        for b in batches:
            texts = b.column(1).to_pylist()
            for s in slices(texts):
                sets = shingler.sets(texts[s])
                some = [x for x in sets if len(x)]
                keys = iter(band_keys(some, bands, rows).view(np.int64)) if some else iter(())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.start, s.stop - s.start), b.column(2).slice(s.start, s.stop - s.start),
                     pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets],
                              pa.binary()),
                     pa.array([next(keys) if len(x) else None for x in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "th", "n_shingles", "set_key", "bands"])

    return rows_.mapInArrow(run, f"doc_id {kind}, th long, n_shingles long, set_key binary, bands array<long>")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """rep, shingles (array of long) of rows (rep, text)."""

    def run(batches):
        shingler = Shingler(shingle)
        for b in batches:
            texts = b.column(1).to_pylist()
            for s in slices(texts):
                sets = [x.view(np.int64) for x in shingler.sets(texts[s])]
                bounds = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.start, s.stop - s.start),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(sets)))],
                    names=["rep", "shingles"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, shingles array<long>")


def near_sizes(a: Column, b: Column, threshold: int) -> Column:
    """Sets whose sizes differ more than this can't reach the threshold."""
    return (100 * F.least(a, b) >= threshold * F.greatest(a, b))


def alike(a: Column, b: Column, threshold: int) -> Column:
    """100 * intersection >= threshold * union, on whole sets without repeats."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= threshold * (F.size(a) + F.size(b) - both)


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of (a, b): the smallest vertex reachable.

    Each round moves every root to the smallest root next to it and then follows the roots'
    roots; all tables are written to the shared folder, none is collected. Edges inside one
    component leave."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = staged(both.where("a != b").distinct(), "links")
    root = staged(links.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("root")), "roots")
    for _ in count():
        # the edges between today's roots, then the smallest neighbour of each root
        left = root.select(F.col("v").alias("a"), F.col("root").alias("ra"))
        right = root.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        links = staged(links.join(left, "a").join(right, "b").where("ra != rb")
                       .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        nodes = root.select("root").distinct()
        low = links.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("low"))
        up = staged(nodes.join(low, "root", "left").select(
            F.col("root").alias("v"), F.least(F.col("root"), F.coalesce("low", "root")).alias("up")), "up")
        # follow the pointers to their ends: the path lengths halve with every step
        while True:
            hop = up.select(F.col("v").alias("up"), F.col("up").alias("next"))
            far = staged(up.join(hop, "up").select("v", F.col("next").alias("up"), (F.col("up") != F.col("next")).alias("moved")), "up")
            moved = not far.where("moved").isEmpty()
            up = far.select("v", "up")
            if not moved:
                break
        root = staged(root.join(up.select(F.col("v").alias("root"), F.col("up").alias("new")), "root")
                      .select("v", F.col("new").alias("root")), "roots")
        if links.isEmpty():
            return root


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept: one row per input row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sig = staged(signatures(docs, shingle, bands, rows), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th"))
    classes = staged(sig.where("set_key IS NOT NULL").groupBy("set_key")
                     .agg(F.min(first).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
                     .withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("band", "key")
    members = staged(members.join(shared, ["band", "key"]), "members")  # rep, n, band, key: buckets of two and more

    # texts of the classes that share a bucket with another one, as shingle sets
    wanted = (classes.select("rep", F.col("first.id").alias("__id"), F.col("first.th").alias("__th"))
              .join(members.select("rep").distinct(), "rep", "left_semi"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th"))
    sets = staged(shingle_sets(docs.join(wanted, same).select("rep", "text").dropDuplicates(["rep"]), shingle), "sets")

    root = staged(members.select(F.col("rep").alias("v"), F.col("rep").alias("root")).distinct(), "roots")
    for r in range(hub_rounds):
        open_members = _mixed(members, root)
        # hub: of the bucket's component with the smallest hash, the member with the smallest hash
        order = F.struct(F.xxhash64(F.lit(r), "rep"), F.col("rep"), F.col("root"), F.col("n"))
        hubs = (open_members.groupBy("band", "key").agg(F.min(order).alias("hub"))
                .select("band", "key", F.col("hub.rep").alias("hub"), F.col("hub.root").alias("hub_root"), F.col("hub.n").alias("hub_n")))
        pairs = (open_members.join(hubs, ["band", "key"])
                 .where((F.col("root") != F.col("hub_root")) & near_sizes(F.col("n"), F.col("hub_n"), threshold))
                 .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct())
        links = _confirmed(pairs, sets, threshold)
        root, any_new = _merge(root, links)
        if not any_new:
            break
    # what is left: classes outside their bucket's largest component, against the others
    rest = _mixed(members, root)
    by_root = rest.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("m"))
    largest = (by_root.groupBy("band", "key").agg(F.max(F.struct("m", "root")).alias("x"))
               .select("band", "key", F.col("x.root").alias("main")))
    left = staged(rest.join(largest, ["band", "key"]).groupBy("rep", "root", "n")
                  .agg(F.max(F.col("root") != F.col("main")).alias("outside")), "left")
    rare = staged(_rarest(sets.join(left.select("rep"), "rep", "left_semi"), threshold).join(left, "rep"), "rarest")
    outside = rare.where("outside").select("token", F.col("rep").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("at").alias("pa"))
    others = rare.select("token", F.col("rep").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("outside").alias("ob"),
                         F.col("at").alias("pb"))
    # from their first common shingle on, both must have enough shingles left for the overlap needed
    left_over = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    pairs = (outside.join(others, "token")
             .where((F.col("ra") != F.col("rb")) & (~F.col("ob") | (F.col("a") < F.col("b")))
                    & ((100 + threshold) * left_over >= threshold * (F.col("na") + F.col("nb"))))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    root, _ = _merge(root, _confirmed(pairs, sets, threshold))

    known = (classes.select("set_key", "rep", "first").join(root.select(F.col("v").alias("rep"), "root"), "rep", "left")
             .select("set_key", "first", F.coalesce("root", "rep").alias("root")))
    lowest = known.groupBy("root").agg(F.min("first").alias("low"))
    known = known.join(lowest, "root").select("set_key", F.col("first.id").alias("class_id"), F.col("low.id").alias("component_id"),
                                              F.lit(True).alias("in_class"))
    own = F.col("in_class").isNull()
    return (sig.select("doc_id", "n_shingles", "set_key").join(known, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose whole sets are alike; the sets are part of the second join's condition."""
    first = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    second = sets.select(F.col("rep").alias("r"), F.col("shingles").alias("sb"))
    return first.join(second, (F.col("b") == F.col("r")) & alike(F.col("sa"), F.col("sb"), threshold)).select("a", "b")


def _rarest(sets: DataFrame, threshold: int) -> DataFrame:
    """(rep, at, token): the rarest shingles of each set, so many that sets alike share one of them.

    Any order of all shingles serves (here: rarest first); of a set of n the first n - ceil(t n) + 1
    are needed. Those that no other set has are left out."""
    tokens = sets.select("rep", F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f"))
    need = F.size("ts") - F.ceil(F.size("ts") * threshold / 100).cast("int") + 1
    return (tokens.join(often, "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("ts"))
            .select("rep", F.posexplode(F.slice("ts", F.lit(1), need)).alias("at", "t")).where("t.f > 1")
            .select("rep", "at", F.col("t.token").alias("token")))


def _mixed(members: DataFrame, root: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component, with their roots."""
    placed = staged(members.join(root.withColumnRenamed("v", "rep"), "rep"), "placed")
    mixed = (placed.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo != hi").select("band", "key"))
    return placed.join(mixed, ["band", "key"])


def _merge(root: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Roots after the links are added, and whether there was any."""
    left = root.select(F.col("v").alias("a"), F.col("root").alias("ra"))
    right = root.select(F.col("v").alias("b"), F.col("root").alias("rb"))
    edges = staged(links.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                   .where("a != b").distinct(), "edges")
    if edges.isEmpty():
        return root, False
    new = components(edges).select(F.col("v").alias("root"), F.col("root").alias("new"))
    return staged(root.join(new, "root", "left").select("v", F.coalesce("new", "root").alias("root")), "roots"), True
