"""Plan shape: pushed filters, pruned columns, broadcast of fixed dimensions, group limit."""

from pyspark.sql import functions as F

from sonara.operators import regions as R
from sonara.operators import series as Q
from sonara.plans import views as V

from data_dirs import SF01


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_scan(spark):
    ev = V.v_events(spark, SF01).where(F.col("subject_id") == 8).select("instr_time", "value")
    p = plan(ev)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,8)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_fixed_dimension_is_broadcast(spark):
    f = R.prepare_facts(V.v_facts(spark, SF01))
    p = plan(R.with_bin_colour(f, F.col("deaths") * 0.2))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_newest_first_uses_group_limit(spark):
    audio = spark.read.parquet(f"{SF01}/events.parquet").select(
        F.col("user_id").alias("song_id"), F.col("event_id").alias("timeseries"), F.col("value").alias("intensity"))
    p = spark.createDataFrame([], "x int")  # noqa: F841
    out = Q.latest_samples(audio, 5)
    txt = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in txt


def test_schema_probe_folds_to_empty(spark):
    from sonara.operators.catalog import schema_probe
    df = schema_probe(V.v_catalog(spark, SF01))
    assert "LocalTableScan" in plan(df) or "EmptyRelation" in plan(df)
    assert df.columns == ["s3_key", "album", "artist", "genre", "title", "filesize", "samplerate"]


def test_fft_from_haloed_pieces_moves_no_samples(spark):
    """Pieces carry their halos: framing + FFT from a stored pieces table is exchange-free."""
    from dataclasses import replace
    from sonara.operators import spectral as S
    sig = V.v_signal(spark, SF01)
    p = replace(S.TEST_PARAMS, balance=False)
    pieces = S.to_pieces(sig, p)
    txt = plan(S.mel_spectrogram(pieces, p))
    assert "Exchange" not in txt and "MapInArrow" in txt
