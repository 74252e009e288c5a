"""The FIXTURES.md views as SQL text (runs unchanged in Spark SQL and DuckDB).

Used by the oracle: ``with_views("select ... from v_signal")`` prefixes the CTEs a query
needs, so DuckDB runs it directly on the driver's base tables.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "v_catalog": """
select source || '/' || lang || '/' || lpad(cast(doc_id as string), 6, '0')
       || case doc_id % 4 when 0 then '.mp3' when 1 then '.wav' when 2 then '.m4a' else '.txt' end
       || case when doc_id % 10 = 6 then '.bak' else '' end as s3_key,
       source as album, lang as artist, nullif(lang, 'en') as genre,
       'Title ' || cast(doc_id as string) as title,
       n_chars as filesize, cast(22050 as bigint) as samplerate
from documents""",
    "v_signal": """
select vec_id + 1 as song_id, cast(22050 as int) as sr, embedding as samples from embeddings""",
    "v_audio": """
select user_id as song_id,
       cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) as timeseries,
       value as intensity
from events""",
    "v_facts": """
select cast(n_nationkey as string) as code, r_name as state, n_name as county,
       cast(year(o_orderdate) as bigint) as year, cast(count(*) as bigint) as deaths,
       case when n_nationkey % 7 = 3 then 'Missing'
            when count(*) % 5 = 0 then cast(count(*) * 2 as string) || ' (UnReliable)'
            else cast(count(*) * 2 as string) end as rate
from orders join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by n_nationkey, r_name, n_name, year(o_orderdate)""",
    "v_hover": """
select n_name || '<br>' || r_name || '<br>' ||
       case n_nationkey % 3 when 0 then cast(n_nationkey as string)
            when 1 then cast(1000 + n_nationkey as string)
            else cast(10000 + n_nationkey as string) end as hover
from nation join region on n_regionkey = r_regionkey
where r_name in ('ASIA', 'EUROPE')""",
    "v_events": """
select user_id as subject_id, event_type as channel, ts as instr_time, value from events""",
    "v_positions": """
select event_id, cast(event_id % 1156 as double) + case event_id % 4 when 1 then 0.5 when 3 then 0.75 else 0.0 end as s
from events""",
}


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs of every view it names."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", body)]
    if not used:
        return body.strip()
    ctes = ",\n".join(f"{v} as ({VIEW_SQL[v].strip()})" for v in used)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
