"""Regional report queries on ``v_facts`` / ``v_hover`` (STR-01..06, JON-03/04, AGG-01,
AGG-05..11, PRJ-07/08, SRT-01..03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import regions as R
from ..session import materialize, scratch_path
from ..sources.csv import scan_csv as _scan_csv, write_csv
from .registry import register
from .views import v_facts, v_hover

# Column names of the county facts file and of the coordinates file, whose header pads some.
FACTS_CSV_SCHEMA = ("`Unnamed: 0` string, `County` string, `County Code` string, `Year` bigint, "
                    "`Deaths` string, `Age Adjusted Rate` string")
COORDINATES_CSV_SCHEMA = "`FIPS ` string, `Latitude ` double, `Longitude` double, `Hover` string"

_ZF = "case when length({0}) >= 5 then {0} else lpad({0}, 5, '0') end"
_CLEAN = "case when regexp_matches(rate, '(?i)unreliable') then '0' else rate end"
_FACTS = f"""facts as (select {_ZF.format('code')} as code, state, county, year, deaths, rate,
                 state || ', ' || county as label from v_facts)"""
_SEL = f"""sel as (select distinct {_ZF.format('c')} as code
  from (select cast(cast(case when length(p) = 4 then '0' || p else p end as int) % 1000 as varchar) as c
        from (select string_split(hover, '<br>')[-1] as p from v_hover)))"""
_SELECTED = "selected as (select * from facts where code in (select code from sel))"
_CLEANED = f"""cleaned as (select code, state, county, year, deaths, {_CLEAN} as rate, label from selected)"""
_ALL_CLEANED = f"""all_cleaned as (select code, state, county, year, deaths, {_CLEAN} as rate, label from facts)"""
_PIPE = f"with {_FACTS}, {_SEL}, {_SELECTED}, {_CLEANED}, {_ALL_CLEANED}"
_BINS = ", ".join(f"({i}, '{b}', '{c}')" for i, (b, c) in enumerate(zip(R.BINS, R.COLORS)))
_DIM = f"dim as (select * from (values {_BINS}) t(bin, label, colour))"
_BIN = "cast(least(15, greatest(0, cast(ceil(deaths * 0.2 / 2.0) as int) - 1)) as int)"

CODE_MODULUS = 1000  # the stand-in hover codes are the region codes plus a multiple of this


def facts(spark, d):
    return R.prepare_facts(v_facts(spark, d))


def selected(spark, d):
    return R.select_regions(facts(spark, d), R.selected_codes(v_hover(spark, d), CODE_MODULUS))


@register("zero_pad_code", f"select code, {_ZF.format('code')} as padded from v_facts")
def zero_pad_code(spark, d):
    return v_facts(spark, d).select("code", X.zero_pad("code").alias("padded"))


@register("region_label", "select code, year, state || ', ' || county as label from v_facts")
def region_label(spark, d):
    return v_facts(spark, d).select("code", "year", X.region_label("state", "county").alias("label"))


@register("last_part", "select hover, string_split(hover, '<br>')[-1] as last from v_hover")
def last_part(spark, d):
    return v_hover(spark, d).select("hover", X.last_part("hover").alias("last"))


@register("pad_four", """select hover, case when length(p) = 4 then '0' || p else p end as code
from (select hover, string_split(hover, '<br>')[-1] as p from v_hover)""")
def pad_four(spark, d):
    return v_hover(spark, d).select("hover", X.pad_four(X.last_part("hover")).alias("code"))


@register("clear_unreliable", f"select code, year, rate as raw, {_CLEAN} as rate from v_facts")
def clear_unreliable(spark, d):
    return v_facts(spark, d).select("code", "year", F.col("rate").alias("raw"),
                                    X.clear_unreliable("rate").alias("rate"))


@register("coerce_numeric", f"select code, year, try_cast({_CLEAN} as double) as rate_num from v_facts")
def coerce_numeric(spark, d):
    return v_facts(spark, d).select("code", "year", X.coerce_numeric(X.clear_unreliable("rate")).alias("rate_num"))


@register("select_regions", f"{_PIPE} select * from selected")
def select_regions(spark, d):
    return selected(spark, d)


@register("sort_by_year", f"{_PIPE} select * from cleaned order by year, label, code")
def sort_by_year(spark, d):
    return R.clean_rate(selected(spark, d)).orderBy("year", "label", "code")


@register("filter_year", f"{_PIPE} select * from facts where year = (select min(year) from facts)")
def filter_year(spark, d):
    f = facts(spark, d)
    return f.where(F.col("year") == R.first_year(f))


@register("sum_by_region", f"""{_PIPE} select label, coalesce(sum(try_cast(rate as double)), 0.0) as total
from all_cleaned group by label""")
def sum_by_region(spark, d):
    return R.sum_by_label(R.clean_rate(facts(spark, d)), "rate")


@register("filter_positive", f"""{_PIPE} select * from (
  select label, coalesce(sum(try_cast(rate as double)), 0.0) as total from all_cleaned group by label)
where total > 0""")
def filter_positive(spark, d):
    totals = R.sum_by_label(R.clean_rate(facts(spark, d)), "rate")
    return totals.where(F.col("total") > 0)


@register("year_bounds", "select min(year) as min_year, max(year) as max_year from v_facts")
def year_bounds(spark, d):
    return R.year_bounds(v_facts(spark, d))


@register("selected_count", f"""{_PIPE} select cast(count(*) as bigint) as n_selected, count(*) > 500 as over_limit
from sel""")
def selected_count(spark, d):
    return R.selection_size(R.selected_codes(v_hover(spark, d), CODE_MODULUS))


@register("rate_histogram", f"""{_PIPE}, {_DIM}
select h.bin, dim.label, h.n from (select {_BIN} as bin, cast(count(*) as bigint) as n from facts group by 1) h
join dim on dim.bin = h.bin""")
def rate_histogram(spark, d):
    return R.rate_histogram(facts(spark, d), F.col("deaths") * 0.2).select("bin", "label", "n")


@register("bin_colour", f"""{_PIPE}, {_DIM}
select f.code, f.year, f.deaths, dim.bin, dim.label, dim.colour
from (select *, {_BIN} as bin from facts) f join dim on dim.bin = f.bin""")
def bin_colour(spark, d):
    return R.with_bin_colour(facts(spark, d), F.col("deaths") * 0.2).select(
        "code", "year", "deaths", "bin", F.col("bin_label").alias("label"), "colour")


_CHART = """select label, coalesce(sum(try_cast(cast({m} as varchar) as double)), 0.0) as total
from cleaned {w} group by label"""


@register("chart_deaths_year", f"""{_PIPE} select * from ({_CHART.format(m='deaths', w='where year = (select min(year) from facts)')})
where total > 0 order by total, label""")
def chart_deaths_year(spark, d):
    return R.chart_totals(selected(spark, d), "deaths", R.first_year(facts(spark, d)))


@register("chart_deaths_all", f"""{_PIPE} select * from ({_CHART.format(m='deaths', w='')})
where total > 0 order by total, label""")
def chart_deaths_all(spark, d):
    return R.chart_totals(selected(spark, d), "deaths")


@register("chart_rate_year", f"""{_PIPE} select * from ({_CHART.format(m='rate', w='where year = (select min(year) from facts)')})
where total > 0 order by total, label""")
def chart_rate_year(spark, d):
    return R.chart_totals(selected(spark, d), "rate", R.first_year(facts(spark, d)))


@register("sort_by_total", f"""{_PIPE} select label, coalesce(sum(cast(deaths as double)), 0.0) as total
from all_cleaned group by label order by total, label""")
def sort_by_total(spark, d):
    return R.sum_by_label(facts(spark, d), "deaths").orderBy("total", "label")


@register("chart_rate_trend", f"""{_PIPE} select label, year, try_cast(rate as double) as rate
from cleaned where label in (select label from (select distinct label from cleaned) order by label limit {R.SERIES_LIMIT})
order by year, label""")
def chart_rate_trend(spark, d):
    # the cleaned facts (one row per region and year) feed both sides of the semi join
    c = R.first_series(materialize(R.clean_rate(selected(spark, d)), "trend"))
    return c.select("label", "year", X.coerce_numeric("rate").alias("rate")).orderBy("year", "label")


@register("first_500_series", f"""{_PIPE} select * from all_cleaned
where label in (select label from (select distinct label from all_cleaned) order by label limit {R.SERIES_LIMIT})""")
def first_500_series(spark, d):
    return R.first_series(materialize(R.clean_rate(facts(spark, d)), "series"))


@register("scan_csv", """select state as "Unnamed: 0", county as "County", code as "County Code",
year as "Year", cast(deaths as varchar) as "Deaths", rate as "Age Adjusted Rate" from v_facts""")
def scan_csv(spark, d):
    """SRC-09: the facts written as a header CSV, read back with an explicit schema."""
    path = scratch_path(spark, "facts-csv")
    f = v_facts(spark, d)
    write_csv(f.select(F.col("state").alias("Unnamed: 0"), F.col("county").alias("County"),
                       F.col("code").alias("County Code"), F.col("year").alias("Year"),
                       F.col("deaths").cast("string").alias("Deaths"),
                       F.col("rate").alias("Age Adjusted Rate")), path)
    return _scan_csv(spark, path, FACTS_CSV_SCHEMA)


_PLACE = "n_nationkey * 1.25 - 10", "n_nationkey * 2.5 - 125"  # the nations stand in for counties


@register("scan_coordinates", f"""select {_ZF.format('code')} as "FIPS", cast(lat as double) as "Latitude",
cast(lon as double) as "Longitude", hover as "Hover"
from (select cast(n_nationkey as varchar) as code, {_PLACE[0]} as lat, {_PLACE[1]} as lon,
             n_name || '<br>' || cast(n_nationkey as varchar) as hover from nation)""")
def scan_coordinates(spark, d):
    """SRC-09: a coordinates file whose header pads its names; the names are trimmed, the codes zero-padded."""
    path = scratch_path(spark, "coordinates-csv")
    code = F.col("n_nationkey").cast("string")
    write_csv(spark.read.parquet(f"{d}/nation.parquet").select(
        code.alias("FIPS "), F.expr(_PLACE[0]).alias("Latitude "), F.expr(_PLACE[1]).alias("Longitude"),
        F.concat("n_name", F.lit("<br>"), code).alias("Hover")), path)
    return _scan_csv(spark, path, COORDINATES_CSV_SCHEMA).withColumn("FIPS", X.zero_pad("FIPS"))
