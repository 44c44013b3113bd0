"""DuckDB reference SQL for the correctness gate.

``adapter_cte()`` is the DuckDB text of ``clipstat.sources.adapter`` (the same
mapping of the test tables to channel / videos / comments); each oracle query
is that prefix plus a plain SQL body over ``videos``, ``channel`` and
``comments``.  Result columns carry the same names and types as the Spark
queries: DuckDB's ``sum`` of integers is HUGEINT, so sums are cast to BIGINT.
"""

from __future__ import annotations

from clipstat.functions.dims import CATEGORY_NAMES, DURATION_BUCKETS, UNKNOWN_CATEGORY
from clipstat.sources.adapter import AS_OF


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def category_case(col: str = "category_id") -> str:
    whens = " ".join(f"when {_q(k)} then {_q(v)}" for k, v in CATEGORY_NAMES.items())
    return f"coalesce(case {col} {whens} end, {_q(UNKNOWN_CATEGORY)})"


DURATION_SECONDS = """(coalesce(try_cast(regexp_extract(duration,'([0-9]+)D',1) as int),0)*86400
 + coalesce(try_cast(regexp_extract(duration,'T.*?([0-9]+)H',1) as int),0)*3600
 + coalesce(try_cast(regexp_extract(duration,'T.*?([0-9]+)M',1) as int),0)*60
 + coalesce(try_cast(regexp_extract(duration,'T.*?([0-9]+)S',1) as int),0))"""

ENGAGEMENT = """(cast(coalesce(like_count,0)+coalesce(comment_count,0) as double)
 / cast(coalesce(nullif(view_count,0),1) as double) * 100)"""


def adapter_cte() -> str:
    return f"""
with video_base as (
  select concat('v_', cast(o_orderkey as varchar)) as video_id,
         concat('UC', cast(o_custkey as varchar)) as channel_id,
         case when o_orderkey % 2 = 0 then upper(p_name) else p_name end as title,
         case when o_orderkey % 7 = 0 then null else concat(o_orderpriority, ' guide') end as description,
         cast(o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as timestamp) as published_at,
         c_name as channel_title,
         cast(c_nationkey + 1 as varchar) as category_id,
         string_split(lower(p_name), ' ') as tags,
         case when o_orderkey % 97 = 0 then null
              when o_orderkey % 50 = 0 then 'P0D'
              else concat('PT',
                case when d >= 3600 then concat(cast(d // 3600 as varchar), 'H') else '' end,
                case when d % 3600 >= 60 then concat(cast((d % 3600) // 60 as varchar), 'M') else '' end,
                case when d % 60 > 0 then concat(cast(d % 60 as varchar), 'S') else '' end) end as duration,
         case when o_orderkey % 103 = 0 then null
              when o_orderkey % 101 = 0 then 0
              else cast(floor(o_totalprice) as bigint) end as view_count,
         likes as like_count,
         cast(0 as bigint) as favorite_count,
         n as comment_count
  from (select *, (o_orderkey * 37) % 7200 as d from orders) o
  join customer on c_custkey = o_custkey
  join part on p_partkey = o_orderkey % (select count(*) from part)
  left join (select l_orderkey, cast(sum(l_quantity) as bigint) as likes, count(*) as n
             from lineitem group by l_orderkey) l on l_orderkey = o_orderkey
),
videos as materialized (  -- materialized: DuckDB 2.0 raises an internal error when filters are pushed into it

  select *,
         cast({DURATION_SECONDS} as int) as duration_seconds,
         {category_case()} as category_name,
         {ENGAGEMENT} as engagement_rate,
         cast(published_at as date) as publish_date,
         cast(date_diff('day', cast(published_at as date), date '{AS_OF}') as int) as days_since_published
  from video_base
),
channel as (
  select concat('UC', cast(c_custkey as varchar)) as channel_id,
         c_name as channel_title,
         c_mktsegment as channel_description,
         concat('@', lower(replace(c_name, '#', ''))) as custom_url,
         v_first as published_at,
         n_name as country,
         cast(coalesce(v_views, 0) as bigint) as view_count,
         cast(floor(abs(c_acctbal) * 10) as bigint) as subscriber_count,
         cast(coalesce(v_count, 0) as int) as video_count,
         concat('UU', cast(c_custkey as varchar)) as uploads_playlist_id
  from customer
  left join nation on n_nationkey = c_nationkey
  left join (select channel_id as v_channel, sum(view_count) as v_views, count(*) as v_count,
                    min(published_at) as v_first
             from videos group by channel_id) pc
    on pc.v_channel = concat('UC', cast(c_custkey as varchar))
),
comments_raw as (
  select concat(cast(l_orderkey as varchar), '.', cast(l_linenumber as varchar)) as comment_id,
         concat('v_', cast(l_orderkey as varchar)) as video_id,
         s_name as author_name,
         concat('UC', cast(l_suppkey as varchar)) as author_channel_id,
         concat('status ', l_returnflag, l_linestatus) as text,
         cast(l_shipdate as timestamp) as published_at,
         cast(l_shipdate as timestamp) as updated_at,
         cast(l_quantity as int) as like_count
  from lineitem join supplier on s_suppkey = l_suppkey
),
comments as (
  select comment_id, video_id, author_name, author_channel_id, text, published_at, updated_at, like_count
  from (select *, row_number() over (partition by comment_id
          order by updated_at desc nulls last, video_id desc nulls last, author_name desc nulls last,
                   author_channel_id desc nulls last, text desc nulls last,
                   published_at desc nulls last, like_count desc nulls last) as _rn
        from comments_raw) x
  where _rn = 1
)
"""


AVG5 = """count(*) as video_count,
       round(avg(view_count), 2) as avg_views,
       round(avg(like_count), 2) as avg_likes,
       round(avg(comment_count), 2) as avg_comments,
       round(avg(engagement_rate), 2) as avg_engagement"""

LEFT_BUCKET = """case when duration_seconds < 60 then '< 1 min'
            when duration_seconds < 300 then '1-5 mins'
            when duration_seconds < 600 then '5-10 mins'
            when duration_seconds < 1200 then '10-20 mins'
            else '> 20 mins' end"""

RIGHT_BUCKET = """case when duration_seconds <= 0 then null
            when duration_seconds <= 60 then '< 1 min'
            when duration_seconds <= 300 then '1-5 mins'
            when duration_seconds <= 600 then '5-10 mins'
            when duration_seconds <= 1200 then '10-20 mins'
            when duration_seconds is not null then '> 20 mins' end"""

BUCKET_LABELS = "(values " + ", ".join(f"({_q(b)})" for b in DURATION_BUCKETS) + ") as b(duration_category)"


def with_adapter(body: str) -> str:
    return adapter_cte() + body


def human_number_sql(expr: str, tidy: bool = False) -> str:
    """DuckDB text of ``columns.human_number`` (printf rounds the exact binary value half-even)."""
    v = f"cast({expr} as double)"
    small = (f"case when {v} = floor({v}) then cast(cast(floor({v}) as bigint) as varchar) "
             f"else printf('%.1f', {v}) end") if tidy else f"cast({expr} as varchar)"
    return (f"case when {expr} is null then '0' when {expr} < 1000 then {small} "
            f"when {expr} < 1000000 then printf('%.1fK', {v} / 1000) "
            f"when {expr} < 1000000000 then printf('%.1fM', {v} / 1000000) "
            f"else printf('%.1fB', {v} / 1000000000) end")


def short_title_sql(col: str = "title") -> str:
    return (f"case when {col} is null then 'Unknown' when length({col}) > 40 "
            f"then concat(substr({col}, 1, 40), '...') else {col} end")
