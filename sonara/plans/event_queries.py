"""Event-time queries on ``v_events`` (SER-01, UDF-02, STM-01): per-subject 5-day windows,
10 expected points (gate at 9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reducers as R
from ..operators import windows as W
from ..streaming.windows import window_series_stream as _stream
from .registry import register
from .views import v_events

DURATION = "5 days"
EXPECTED = 10

_WIN = """w as (select subject_id, time_bucket(interval '5 days', instr_time, timestamp '1970-01-01 00:00:00') as window_start,
             instr_time, value from v_events),
d as (select subject_id, window_start,
             value - lag(value) over (partition by subject_id, window_start order by instr_time) as dv from w)"""

_SERIES = f"""with {_WIN},
a as (select subject_id, window_start, count(*) as n, sum(abs(dv)) as s from d group by 1, 2)
select subject_id, window_start, window_start + interval '5 days' as window_end,
       cast(n as bigint) as num_datapoints,
       case when n >= {W.GATE * EXPECTED} then cast(round(s / (n - 1), 6) as float) end as indicator
from a"""


@register("window_series", _SERIES)
def window_series(spark, d):
    return W.window_series(v_events(spark, d), DURATION, EXPECTED)


@register("per_series_reduce", f"""with {_WIN}
select subject_id, window_start, round(sum(abs(dv)) / count(dv), 6) as indicator
from d group by 1, 2 having count(dv) > 0""")
def per_series_reduce(spark, d):
    return W.per_series_reduce(v_events(spark, d), DURATION)


@register("window_series_stream", _SERIES)
def window_series_stream(spark, d):
    """STM-01: the same result from Structured Streaming over the events file."""
    return _stream(spark, f"{d.rstrip('/')}/events.parquet", DURATION, EXPECTED)


_CH_WIN = """w as (select subject_id, channel, time_bucket(interval '5 days', instr_time, timestamp '1970-01-01 00:00:00') as window_start,
             instr_time, value from v_events),
d as (select subject_id, channel, window_start,
             value - lag(value) over (partition by subject_id, channel, window_start order by instr_time) as dv from w)"""


@register("window_series_channels", f"""with {_CH_WIN},
a as (select subject_id, channel, window_start, count(*) as n, sum(abs(dv)) as s from d group by 1, 2, 3)
select subject_id, channel, window_start, window_start + interval '5 days' as window_end,
       cast(n as bigint) as num_datapoints,
       case when n >= {W.GATE * EXPECTED} then cast(round(s / (n - 1), 6) as float) end as indicator
from a""")
def window_series_channels(spark, d):
    """SER-01 with the intended keys: per subject, channel and window (thin per channel, so
    most windows stay below the gate; the rows are kept with a NULL result)."""
    return W.window_series(v_events(spark, d), DURATION, EXPECTED, keys=("subject_id", "channel"))


@register("series_drawdown", """with w as (select subject_id, time_bucket(interval '5 days', instr_time, timestamp '1970-01-01 00:00:00') as window_start,
             instr_time, value from v_events),
f as (select subject_id, window_start, max(value) over (partition by subject_id, window_start
             order by instr_time, value rows between unbounded preceding and current row) - value as fall from w)
select subject_id, window_start, window_start + interval '5 days' as window_end, count(*) as num_datapoints,
       case when count(*) >= """ + str(W.GATE * EXPECTED) + """ then cast(max(fall) as float) end as indicator
from f group by subject_id, window_start""")
def series_drawdown(spark, d):
    """UDF-02: a caller's Python reducer (the largest fall from an earlier high) per subject and window."""
    return R.window_reduce(v_events(spark, d), DURATION, EXPECTED, R.Drawdown())


@register("window_values", """with w as (select subject_id, time_bucket(interval '5 days', instr_time, timestamp '1970-01-01 00:00:00') as window_start,
             instr_time, value from v_events),
n as (select *, row_number() over (partition by subject_id, window_start order by instr_time, value) - 1 as i from w)
select subject_id, window_start, cast(i // 8 as bigint) as segment, cast(i % 8 as integer) as position, value from n""")
def window_values(spark, d):
    """SER-01: the sorted value list of every window, in segments of 8 values, one row a value."""
    out = R.window_values(v_events(spark, d), DURATION, segment=8)
    return out.select("subject_id", "window_start", "segment", F.posexplode("values").alias("position", "value"))
