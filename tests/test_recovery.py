"""Lost work is recomputed to the same result: the first attempt of some tasks fails (as
if its executor were lost) and Spark retries it; numbering and spectra must not change."""

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from sonara.operators import spectral as S
from sonara.operators.ordinal import ordinal_within
from sonara.plans import views as V

from data_dirs import SF01


def flaky(df):
    """Identity, except that the first attempt of partitions 0 and 1 fails."""
    def run(batches):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() in (0, 1):
            raise RuntimeError("injected task loss")
        yield from batches
    return df.mapInArrow(run, df.schema)


def test_numbering_survives_task_loss(spark):
    df = spark.range(20000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        ((F.col("id") * 7919) % 20000).alias("t"))
    got = ordinal_within(flaky(df), ["k"], ["t"], name="o")
    want = df.withColumn("o", (F.row_number().over(Window.partitionBy("k").orderBy("t")) - 1).cast("bigint"))
    assert got.count() == 20000 and got.exceptAll(want).count() == 0


def test_spectrogram_survives_task_loss(spark):
    sig = V.v_signal(spark, SF01).repartition(4)
    p = S.TEST_PARAMS
    a = {(r.song_id, r.timeseries): r.db for r in S.spec_packed(flaky(sig), p).collect()}
    b = {(r.song_id, r.timeseries): r.db for r in S.spec_packed(sig, p).collect()}
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=0, atol=0)
