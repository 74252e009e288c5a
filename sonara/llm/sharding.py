"""Sharding: a two-pass external shuffle in Spark SQL functions only.

Pass 1 scatters records over memory-sized buckets by seeded hashes. Pass 2 takes one bucket
at a time, permutes it by Fisher-Yates (``shuffle``, seeded) and numbers it, so every shard
is a concatenation of shuffled buckets with gapless slots.

Law ``key``: the shard depends on doc_id and the number of shards alone. It is the shard
with the highest seeded hash (rendezvous), so one more shard takes rows only into itself and
every other row stays where it is.

A record's bucket inside its shard hashes its place in the table (partition and row), so equal doc_ids,
equal texts and repeated rows spread over the buckets like any others; the number of buckets follows the bytes.

Defined results: null text counts as empty (size 1, CRC 0); a null doc_id hashes as the text
``<null>``; repeated rows each get a slot of their own; very long texts are taken whole, a bucket then holds
its share and one more text; an empty table gives no rows; other columns are carried only where named in
``keep``. ``docs`` must be a table or a staged frame (rows in a fixed order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import text_or_empty

BUCKET_BYTES = 4 << 20


def shard_of(doc_id: Column, n_shards: int, seed: int = 17) -> Column:
    """Rendezvous choice among ``n_shards``: the argmax of one seeded hash per shard."""
    key = F.coalesce(doc_id.cast("string"), F.lit("<null>"))
    scores = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("h"), F.lit(i).alias("i"))
              for i in range(n_shards)]
    return (F.greatest(*scores) if n_shards > 1 else scores[0])["i"]


def shuffle_into_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17,
                        bucket_bytes: int = BUCKET_BYTES, keep: tuple[str, ...] = ("text",)) -> DataFrame:
    """doc_id, size, the ``keep`` columns, shard, slot, grown_shard: all rows in shuffled shards."""
    size = F.octet_length(text_or_empty()).cast("long") + 1
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    n_buckets = max(1, -(-int(total) // (n_shards * bucket_bytes)))
    place = docs.withColumn("__at", F.monotonically_increasing_id())
    home = F.pmod(F.xxhash64(F.lit(seed + 1), "__at"), F.lit(n_buckets)).cast("int")
    placed = place.select(shard_of(F.col("doc_id"), n_shards, seed).alias("__shard"), home.alias("__bucket"), "*")

    sizes = placed.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("__shard", "__bucket",
                        F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__base"))  # one row per bucket

    grown = F.when(F.lit(n_shards) < 1, F.lit(None)).otherwise(shard_of(F.col("doc_id"), n_shards + 1, seed))
    record = F.struct(F.xxhash64(F.lit(seed + 2), "__at").alias("h"), F.col("doc_id"), size.alias("size"),
                      *[F.col(c) for c in keep], grown.alias("grown_shard"))
    buckets = (placed.select("__shard", "__bucket", record.alias("r"))
               .groupBy("__shard", "__bucket").agg(F.array_sort(F.collect_list("r")).alias("rs")))
    return (buckets.join(base, ["__shard", "__bucket"])
            .select("__shard", "__base", F.posexplode(F.shuffle("rs", F.lit(seed))).alias("__p", "r"))
            .select("r.doc_id", "r.size", *[f"r.{c}" for c in keep], F.col("__shard").alias("shard"),
                    (F.col("__base") + F.col("__p")).cast("long").alias("slot"), "r.grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, **kw) -> None:
    """The shuffled records as one folder per shard; each file is sorted by slot."""
    out = shuffle_into_shards(docs, n_shards, **kw)
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(path))
