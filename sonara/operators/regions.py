"""Regional report: cleaning, selection (semi join), grouped sums, bins and colours, top-k.

Facts are ``(code, state, county, year, deaths, rate)`` with ``rate`` as dirty text.
Aggregations run as partial aggregate -> exchange on the label -> final aggregate, so a
hot label costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clear_unreliable, coerce_numeric, last_part, pad_four, region_label, zero_pad

# The 16 rate bins, in order, and the colour of each bin.
BINS = [
    "0-2", "2.1-4", "4.1-6", "6.1-8", "8.1-10", "10.1-12", "12.1-14", "14.1-16",
    "16.1-18", "18.1-20", "20.1-22", "22.1-24", "24.1-26", "26.1-28", "28.1-30", ">30",
]
COLORS = [
    "#f2fffb", "#bbffeb", "#98ffe0", "#79ffd6", "#6df0c8", "#69e7c0", "#59dab2", "#45d0a5",
    "#31c194", "#2bb489", "#25a27b", "#1e906d", "#188463", "#157658", "#11684d", "#10523e",
]
BIN_WIDTH = 2.0
SERIES_LIMIT = 500      # trend chart shows the first 500 series
SELECTION_WARN = 500    # selections above this size are flagged


def prepare_facts(facts: DataFrame) -> DataFrame:
    """Zero-padded code and 'state, county' label, as the report loads them."""
    return facts.withColumn("code", zero_pad("code")).withColumn("label", region_label("state", "county"))


def selected_codes(hover: DataFrame, offset_modulus: int | None = None) -> DataFrame:
    """Codes picked on the map: text after the last '<br>', padded if four long.
    ``offset_modulus`` strips the stand-in offset of the test codes; codes that are no numbers stay."""
    code = pad_four(last_part("hover"))
    if offset_modulus:
        code = F.coalesce(zero_pad((code.try_cast("bigint") % offset_modulus).cast("string")), code)
    return hover.select(code.alias("code")).distinct()


def select_regions(facts: DataFrame, codes: DataFrame) -> DataFrame:
    """Facts whose code is in the selection: a left semi join (the selection may be large)."""
    return facts.join(codes, "code", "left_semi")


def clean_rate(facts: DataFrame) -> DataFrame:
    return facts.withColumn("rate", clear_unreliable("rate"))


def sum_by_label(facts: DataFrame, measure: Column | str, label: str = "label",
                 name: str = "total") -> DataFrame:
    """Sum per label of a coerced measure: missing values skipped, an all-missing group is 0."""
    m = coerce_numeric(F.col(measure).cast("string")) if isinstance(measure, str) else measure
    return facts.groupBy(label).agg(F.coalesce(F.sum(m), F.lit(0.0)).alias(name))


def chart_totals(facts: DataFrame, measure: str, year: Column | int | None = None) -> DataFrame:
    """Clean -> (year filter) -> sum per label -> keep > 0 -> ascending by total, label."""
    f = clean_rate(facts)
    if year is not None:
        f = f.where(F.col("year") == (year if isinstance(year, Column) else F.lit(year)))
    totals = sum_by_label(f, measure)
    return totals.where(F.col("total") > 0).orderBy("total", "label")


def year_bounds(facts: DataFrame) -> DataFrame:
    return facts.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def first_year(facts: DataFrame) -> Column:
    """The slider's default year (minimum year) as a scalar subquery."""
    return facts.select(F.min("year")).scalar()


def selection_size(codes: DataFrame, limit: int = SELECTION_WARN) -> DataFrame:
    n = F.count(F.lit(1))
    return codes.agg(n.alias("n_selected"), (n > F.lit(limit)).alias("over_limit"))


def bin_index(rate: Column) -> Column:
    """(lo, hi] bins of width 2 from 0, the first closed at 0, the last open-ended."""
    return F.least(F.lit(len(BINS) - 1),
                   F.greatest(F.lit(0), F.ceil(rate / BIN_WIDTH).cast("int") - 1)).cast("int")


def bin_dimension(spark) -> DataFrame:
    """(bin, label, colour): the fixed 16-row dimension from the two parallel lists."""
    z = F.arrays_zip(F.array(*[F.lit(b) for b in BINS]).alias("label"),
                     F.array(*[F.lit(c) for c in COLORS]).alias("colour"))
    return spark.range(1).select(F.posexplode(z).alias("bin", "z")).select(
        F.col("bin").cast("int").alias("bin"), F.col("z.label").alias("label"), F.col("z.colour").alias("colour"))


def with_bin_colour(df: DataFrame, rate: Column) -> DataFrame:
    """Attach bin label and colour: equi-join with the 16-row dimension (fixed size: broadcast)."""
    dim = F.broadcast(bin_dimension(df.sparkSession).withColumnRenamed("label", "bin_label"))
    return df.withColumn("bin", bin_index(rate)).join(dim, "bin")


def rate_histogram(df: DataFrame, rate: Column) -> DataFrame:
    """Rows per bin (only bins that occur), with label."""
    counts = df.groupBy(bin_index(rate).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    dim = F.broadcast(bin_dimension(df.sparkSession).select("bin", "label"))
    return counts.join(dim, "bin")


def first_series(facts: DataFrame, k: int = SERIES_LIMIT, label: str = "label") -> DataFrame:
    """Rows of the first k series (distinct labels in label order), ordered by year.

    The rank runs over the distinct labels only; Spark applies the rank limit per task
    before the single-partition window, so each task ships at most k labels."""
    labels = facts.select(label).distinct()
    ranked = labels.withColumn("__r", F.dense_rank().over(Window.orderBy(label))).where(F.col("__r") <= k)
    return facts.join(ranked.select(label), label, "left_semi")
