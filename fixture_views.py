"""Views that give the driver's tables the shapes of the raw tables.

The texts run in Spark and in DuckDB (``chr(92)`` is a backslash, which the two escape differently in text); ``{part}`` and the like stand for the driver's tables.
Part plays the person, orders the title and its rating, lineitem the credit, events the run log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "name_basics": """
select concat('nm', lpad(cast(p_partkey as string), 7, '0')) as nconst,
  concat(p_name, ' ', cast(p_partkey as string)) as primaryName,
  case when p_partkey % 11 = 0 then concat(chr(92), 'N') else cast(1940 + p_partkey % 80 as string) end as birthYear,
  case when p_partkey % 3 = 0 then '2015' else concat(chr(92), 'N') end as deathYear,
  case when p_partkey % 7 = 0 then concat(chr(92), 'N') else concat('actor, ', lower(p_type)) end as primaryProfession,
  case when p_partkey % 5 = 0 then concat(chr(92), 'N') else concat('tt', lpad(cast(p_partkey as string), 9, '0'), ',tt', lpad(cast(p_partkey + 1 as string), 9, '0')) end as knownForTitles
from {part}""",
    "title_basics": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst,
  lower(o_orderpriority) as titleType,
  concat('Title ', cast(o_orderkey as string)) as primaryTitle,
  concat('Title ', cast(o_orderkey as string)) as originalTitle,
  case when o_orderkey % 19 = 0 then null when o_orderstatus = 'P' then 1 else 0 end as isAdult,
  case when o_orderkey % 13 = 0 then concat(chr(92), 'N') else cast(1950 + o_orderkey % 80 as string) end as startYear,
  case when o_orderkey % 4 = 0 then cast(1951 + o_orderkey % 80 as string) else concat(chr(92), 'N') end as endYear,
  case when o_orderkey % 17 = 0 then concat(chr(92), 'N') else cast(60 + o_orderkey % 90 as string) end as runtimeMinutes,
  case when o_orderkey % 9 = 0 then concat(chr(92), 'N') else concat('Drama, ', lower(o_orderpriority)) end as genres
from {orders}""",
    "title_ratings": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst,
  cast(100 + o_orderkey % 901 as double) / 100 as averageRating,
  cast(floor(o_totalprice / 20) as int) as numVotes
from {orders} where o_orderkey % 10 <> 0""",
    "title_principals": """
select concat('tt', lpad(cast(l_orderkey as string), 9, '0')) as tconst,
  l_linenumber as ordering,
  concat('nm', lpad(cast(l_partkey as string), 7, '0')) as nconst,
  case l_linenumber % 4 when 0 then 'actor' when 1 then 'actress' when 2 then 'director' else 'writer' end as category,
  concat(chr(92), 'N') as job,
  case when l_linenumber % 3 = 0 then concat(chr(92), 'N') when l_linenumber = 5 then '["Self","Host, The"]' else concat('["', l_returnflag, '","Role ', cast(l_linenumber as string), '"]') end as characters
from {lineitem}""",
    "title_akas": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as titleId, n as ordering,
  concat('Also ', cast(o_orderkey as string)) as title, case when n = '2' then concat(chr(92), 'N') else o_orderstatus end as region
from {orders}, (select '1' as n union all select '2' as n) d""",
    "title_crew": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst, concat('nm', cast(o_orderkey % 97 as string)) as directors,
  concat(chr(92), 'N') as writers
from {orders}""",
    "title_episode": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst, concat('tt', lpad(cast(o_orderkey + 1 as string), 9, '0')) as parentTconst,
  cast(o_orderkey % 9 as string) as seasonNumber
from {orders} where o_orderkey % 6 = 0""",
    # The second day: titles that changed and moved to another year, and new ones; credits that moved, some of them doubled.
    "title_basics_2": """
select concat(case when o_orderkey % 10 = 0 then 'xx' else 'tt' end, lpad(cast(o_orderkey as string), 9, '0')) as tconst,
  lower(o_orderpriority) as titleType,
  concat('Title ', cast(o_orderkey as string)) as primaryTitle,
  concat('Title ', cast(o_orderkey as string)) as originalTitle,
  0 as isAdult,
  case when o_orderkey % 14 = 0 then concat(chr(92), 'N') else cast(1951 + o_orderkey % 80 as string) end as startYear,
  concat(chr(92), 'N') as endYear, '75' as runtimeMinutes, 'Drama' as genres
from {orders} where o_orderkey % 2 = 0""",
    "title_principals_2": """
select concat('tt', lpad(cast(l_orderkey as string), 9, '0')) as tconst,
  l_linenumber + 10 * n as ordering,
  concat('nm', lpad(cast(l_partkey as string), 7, '0')) as nconst,
  case when l_linenumber = 1 then 'self' else 'actor' end as category,
  concat(chr(92), 'N') as job, concat(chr(92), 'N') as characters
from {lineitem}, (select 0 as n union all select 1 as n) d where l_linenumber <= 3 and (n = 0 or l_linenumber = 2)""",
    # Ratings of the second day: changed ones, and some that fall to few votes, which takes them back.
    "title_ratings_2": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst,
  cast(100 + o_orderkey * 7 % 901 as double) / 100 as averageRating,
  cast(case when o_orderkey % 3 = 0 then 500 else 20000 end as int) as numVotes
from {orders} where o_orderkey % 5 = 1""",
    "run_log": """
select event_type as stage, concat('t', cast(user_id % 7 as string)) as table_name, cast(ts as date) as date,
  case when value > 20 then 'unsuccessful' else 'success' end as status
from {events}""",
    "upsert_target": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst, cast(60 + o_orderkey % 90 as int) as runtime, date '2024-01-30' as today_date
from {orders} where o_orderkey % 3 <> 0""",
    "upsert_source": """
select concat('tt', lpad(cast(o_orderkey as string), 9, '0')) as tconst, cast(200 + o_orderkey % 90 as int) as runtime, date '2024-01-31' as today_date
from {orders} where o_orderkey % 2 = 0""",
    "refresh_specs": """
select distinct event_type as stage, concat('t', cast(user_id % 7 as string)) as table_name from {events}
union all select 'landing_zone' as stage, 't9' as table_name""",
}
# The columns that the views use; a stated schema saves Spark a look into the files.
DRIVER_TABLES = {
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a frame over the driver's parquet files."""
    text = VIEWS[name]
    used = {
        table: spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")
        for table, schema in DRIVER_TABLES.items()
        if f"{{{table}}}" in text
    }
    return spark.sql(text, **used)


def with_views(body: str, *names: str) -> str:
    """DuckDB text: the named views, then ``body``, which may itself start with ``with``."""
    texts = {name: VIEWS[name].format(**{t: t for t in DRIVER_TABLES}) for name in names}
    views = ",\n".join(f"{name} as ({text})" for name, text in texts.items())
    body = body.strip()
    return f"with {views},\n{body[5:]}" if body.lower().startswith("with ") else f"with {views}\n{body}"
