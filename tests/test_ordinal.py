"""Skew-safe numbering equals row_number, also with a key holding a third of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sonara.operators.ordinal import ordinal_within


def test_hot_key_numbering(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        ((F.col("id") * 7919) % n).alias("t"), F.col("id").alias("tie"))
    got = ordinal_within(df, ["k"], ["t", "tie"], name="o")
    want = df.withColumn("o", (F.row_number().over(Window.partitionBy("k").orderBy("t", "tie")) - 1).cast("bigint"))
    assert got.count() == n
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_table_wide_numbering(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(200)][::-1], "s string")
    got = ordinal_within(df, [], ["s"], name="o", base=1).orderBy("o").collect()
    assert [r.o for r in got] == list(range(1, 201))
    assert [r.s for r in got] == sorted(f"k{i:03d}" for i in range(200))


def test_numbering_is_repeatable(spark):
    """Two independent runs (new range bounds each time) give the same ids."""
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 31) % 5000).alias("t"))
    a = ordinal_within(df, ["k"], ["t"], name="o")
    b = ordinal_within(df, ["k"], ["t"], name="o")
    assert a.exceptAll(b).count() == 0 and a.count() == 5000


def test_pairwise_reduce_matches_lag(spark):
    from sonara.operators.windows import pairwise_reduce
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), ((F.col("id") * 17) % 3000).alias("t"),
                                  F.sin(F.col("id")).alias("value"))
    got = {r.k: (round(r.total, 9), r.n_pairs) for r in
           pairwise_reduce(df, ["k"], ["t"], lambda a, b: (b - a) * (b - a)).collect()}
    lag = F.lag("value").over(Window.partitionBy("k").orderBy("t"))
    want = df.withColumn("d", F.col("value") - lag).groupBy("k").agg(
        F.sum(F.col("d") * F.col("d")).alias("total"), F.count("d").alias("n"))
    assert got == {r.k: (round(r.total, 9), r.n) for r in want.collect()}


def test_null_keys_are_one_group(spark):
    df = spark.range(40).select(F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("k"), "id")
    got = ordinal_within(df, ["k"], ["id"], name="o")
    want = df.withColumn("o", (F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1).cast("bigint"))
    assert got.count() == 40 and got.exceptAll(want.select(*got.columns)).count() == 0
