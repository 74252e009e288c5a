"""Stand-in views over the driver's tables (see FIXTURES.md), built with the DataFrame API.

Each builder takes (spark, sf_dir) and returns a DataFrame whose rows equal the SQL view of
the same name in ``sonara.plans.view_sql`` (the DuckDB oracle runs that text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinal import ordinal_within


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def v_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    ext = (F.when(F.col("doc_id") % 4 == 0, F.lit(".mp3"))
           .when(F.col("doc_id") % 4 == 1, F.lit(".wav"))
           .when(F.col("doc_id") % 4 == 2, F.lit(".m4a"))
           .otherwise(F.lit(".txt")))
    bak = F.when(F.col("doc_id") % 10 == 6, F.lit(".bak")).otherwise(F.lit(""))
    key = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
                   F.lpad(F.col("doc_id").cast("string"), 6, "0"), ext, bak)
    return d.select(
        key.alias("s3_key"),
        F.col("source").alias("album"),
        F.col("lang").alias("artist"),
        F.nullif(F.col("lang"), F.lit("en")).alias("genre"),
        F.concat(F.lit("Title "), F.col("doc_id").cast("string")).alias("title"),
        F.col("n_chars").alias("filesize"),
        F.lit(22050).cast("bigint").alias("samplerate"),
    )


def v_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") + 1).alias("song_id"), F.lit(22050).cast("int").alias("sr"),
                    F.col("embedding").alias("samples"))


def v_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample; the ordinal is numbered without funnelling a song into one task."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    numbered = ordinal_within(ev, ["user_id"], ["ts", "event_id"], name="timeseries")
    return numbered.select(F.col("user_id").alias("song_id"), "timeseries",
                           F.col("value").alias("intensity"))


def v_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # pre-aggregate the fact side on (customer, year) before any join: the shuffle carries
    # one row per customer-year instead of one per order
    per_cust = orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"))
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: safe to broadcast
    dims = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cust = customer.join(F.broadcast(dims), customer.c_nationkey == dims.n_nationkey)
    per_nation = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
                  .groupBy("n_nationkey", "r_name", "n_name", "yr")
                  .agg(F.sum("n").cast("bigint").alias("deaths")))
    rate = (F.when(F.col("n_nationkey") % 7 == 3, F.lit("Missing"))
            .when(F.col("deaths") % 5 == 0,
                  F.concat((F.col("deaths") * 2).cast("string"), F.lit(" (UnReliable)")))
            .otherwise((F.col("deaths") * 2).cast("string")))
    return per_nation.select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("r_name").alias("state"),
        F.col("n_name").alias("county"), F.col("yr").cast("bigint").alias("year"),
        "deaths", rate.alias("rate"))


def v_hover(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("n_nationkey")
    code = (F.when(k % 3 == 0, k.cast("string"))
            .when(k % 3 == 1, (F.lit(1000) + k).cast("string"))
            .otherwise((F.lit(10000) + k).cast("string")))
    j = nation.join(F.broadcast(region.where(F.col("r_name").isin("ASIA", "EUROPE"))),
                    nation.n_regionkey == region.r_regionkey)
    return j.select(F.concat(F.col("n_name"), F.lit("<br>"), F.col("r_name"), F.lit("<br>"), code)
                    .alias("hover"))


def v_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("subject_id"), F.col("event_type").alias("channel"),
                     F.col("ts").alias("instr_time"), "value")


def v_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id")
    frac = (F.when(F.col("event_id") % 4 == 1, F.lit(0.5))
            .when(F.col("event_id") % 4 == 3, F.lit(0.75)).otherwise(F.lit(0.0)))
    return ev.select("event_id", ((F.col("event_id") % 1156).cast("double") + frac).alias("s"))


VIEWS = {
    "v_catalog": v_catalog, "v_signal": v_signal, "v_audio": v_audio, "v_facts": v_facts,
    "v_hover": v_hover, "v_events": v_events, "v_positions": v_positions,
}
