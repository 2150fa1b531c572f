"""

Queries read the driver's tables in the shapes of ``fixture_views``. Arrays, decimals and dates are
handed over as joined text, doubles and ISO text, in which both engines' clients agree; the operators
themselves keep the types. Joined text begins with the number of elements.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import ArrayType, ByteType, DateType, DecimalType, IntegerType, ShortType  # noqa: E402

from fixture_views import view, with_views  # noqa: E402
from marquee.operators.changes import indicators  # noqa: E402
from marquee.operators.cleansed import dim_names, dim_titles, fact_principals  # noqa: E402
from marquee.operators.kpis import (  # noqa: E402
    person_kpis,
    principal_kpis,
    role_kpis,
    role_rows,
    serving_kpis,
    top_people,
)
from marquee.operators.landing import (  # noqa: E402
    cast_losses,
    first_rows,
    land_table,
    needs_refresh,
    one_per_key,
    upsert,
)
from marquee.operators.runlog import (  # noqa: E402
    latest_success,
    latest_success_of,
    run_log_append,
    serving_run_log,
    status_on_date,
)
from marquee.plans.daily import Batch, raw_paths, run_batch  # noqa: E402
from marquee.plans.incremental import refresh_fact, refresh_person_sums  # noqa: E402
from marquee.sources.files import read_source, scan_table, scan_tsv, scan_tsv_reconciled  # noqa: E402
from marquee.sources.paths import scratch_path  # noqa: E402
from marquee.sources.tables import (  # noqa: E402
    append_table,
    compact_table,
    evenly,
    overwrite_table,
    replace_partition,
    upsert_table,
)
from marquee.specs import (  # noqa: E402
    AGGREGATED,
    CLEANSED,
    FACT,
    FACT_SCHEMA,
    KPIS,
    LANDING,
    NAME_BASICS,
    PERSON_SUMS,
    RUN_LOG_SCHEMA,
    TITLE_BASICS,
    TITLE_PRINCIPALS,
    TITLE_RATINGS,
)

try:  # these operators and the pipeline may be left out of an installation
    import corpus_pipeline  # noqa: E402
    from marquee.llm import queries as llm  # noqa: E402
except ImportError:  # also if a library is missing that only they use
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
BATCH_DATE = date(2024, 1, 31)


def _portable(df: DataFrame) -> DataFrame:
    def column(name, kind):
        if isinstance(kind, ArrayType):
            return F.concat(F.size(name).cast("string"), F.lit(" "), F.array_join(name, "|")).alias(name)
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double").alias(name)
        if isinstance(kind, DateType):
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return df.select(*[column(f.name, f.dataType) for f in df.schema])


# Building blocks of the queries.


def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    return land_table(view(spark, sf, "title_ratings"), TITLE_RATINGS, BATCH_DATE)


def _fact(spark: SparkSession, sf: str, **options) -> DataFrame:
    return fact_principals(
        view(spark, sf, "title_basics"), _ratings(spark, sf), view(spark, sf, "title_principals"), **options
    )


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return dim_names(view(spark, sf, "name_basics"))


def _role_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return role_kpis(_names(spark, sf), _fact(spark, sf))


def _write_raw(df: DataFrame, path: str) -> None:
    """A frame as raw text: gzip, tab separated, with header, unquoted."""
    df.write.options(sep="\t", header=True, nullValue="\\N", quote="", compression="gzip").csv(path)


# Sources and sinks: written to a scratch table and read back.


def _scan_tsv_gz(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "title_basics.tsv.gz")
    _write_raw(view(spark, sf, "title_basics"), path)
    return scan_tsv(spark, path, TITLE_BASICS.schema)


def _scan_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "title_ratings")
    overwrite_table(view(spark, sf, "title_ratings"), path)
    return scan_table(spark, path, TITLE_RATINGS.schema)


def _scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_source(spark, f"{sf}/orders.parquet", "parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _write_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The second overwrite reads the table that it replaces."""
    path = scratch_path(spark, "title_ratings")
    overwrite_table(view(spark, sf, "title_ratings"), path)
    overwrite_table(scan_table(spark, path).withColumn("numVotes", F.col("numVotes") + 1), path)
    return scan_table(spark, path, TITLE_RATINGS.schema)


def _write_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioned by birth year, which is NULL for some."""
    path = scratch_path(spark, "name_basics")
    landed = land_table(view(spark, sf, "name_basics"), NAME_BASICS, BATCH_DATE)
    overwrite_table(evenly(landed, "birthYear"), path, "birthYear")
    return scan_table(spark, path, landed.schema)


def _replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The new rows of the partition are made from its old ones, read from the same table."""
    path = scratch_path(spark, "run_log")
    overwrite_table(view(spark, sf, "run_log"), path, "table_name")
    stored = scan_table(spark, path, RUN_LOG_SCHEMA).filter(F.col("table_name") == "t1")
    replace_partition(stored.withColumn("status", F.lit("replaced")), path, "table_name", "t1")
    return scan_table(spark, path, RUN_LOG_SCHEMA)


def _upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """Matched rows move to another partition, which empties some of the old ones."""
    path = scratch_path(spark, "titles")
    target = view(spark, sf, "upsert_target")
    overwrite_table(evenly(target, "runtime"), path, "runtime")
    upsert_table(view(spark, sf, "upsert_source"), path, ["tconst"], "runtime")
    return scan_table(spark, path, target.schema)


def _run_log_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "run_log")
    overwrite_table(view(spark, sf, "run_log"), path, "table_name")
    added = view(spark, sf, "refresh_specs").select(
        "stage", "table_name", F.lit(BATCH_DATE).alias("date"), F.lit("success").alias("status")
    )
    append_table(added, path, "table_name")
    again = added.withColumn("status", F.lit("unsuccessful"))
    return run_log_append(scan_table(spark, path, RUN_LOG_SCHEMA), again)


# Landing.


def _upsert_table_files(spark: SparkSession, sf: str) -> DataFrame:
    """Titles lie in files by key; only files with a title of the source are rewritten."""
    path = scratch_path(spark, "titles")
    target = view(spark, sf, "upsert_target")
    overwrite_table(target.repartitionByRange(8, "tconst"), path)
    upsert_table(view(spark, sf, "upsert_source"), path, ["tconst"])
    return scan_table(spark, path, target.schema)


def _append_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that is appended again replaces its first attempt; then all files are packed."""
    path = scratch_path(spark, "run_log")
    log = view(spark, sf, "run_log")
    for attempt in ("unsuccessful", "success"):
        append_table(log.filter("table_name <> 't1'").withColumn("status", F.lit(attempt)), path, "table_name", "others")
        append_table(log.filter("table_name = 't1'"), path, "table_name", f"t1 {attempt}")
    compact_table(spark, path, "table_name", 1)
    return scan_table(spark, path, RUN_LOG_SCHEMA)


def _land_principals_sample(spark: SparkSession, sf: str) -> DataFrame:
    order = ["tconst", "ordering", "nconst", "category", "characters"]
    sample = first_rows(view(spark, sf, "title_principals"), 1000, order)
    return land_table(sample, TITLE_PRINCIPALS, BATCH_DATE)


def _upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Old and new rows come from one stored table of credits, which is unique by its key."""
    keys = ["tconst", "nconst"]
    credits = view(spark, sf, "title_principals").drop("job")
    path = scratch_path(spark, "unique_credits")
    overwrite_table(one_per_key(credits, keys, ["ordering", "category", "characters"], keep="first"), path)
    unique = scan_table(spark, path)
    columns = [*keys, "category"]
    target = unique.filter(F.col("ordering") % 3 != 0).select(*columns)
    source = unique.filter(F.col("ordering") % 2 == 0).withColumn("category", F.concat("category", F.lit("*")))
    return upsert(target, source.select(*columns), keys)


def _upsert_last(spark: SparkSession, sf: str) -> DataFrame:
    """Source rows are the credits themselves, several per key; the last one of a key wins."""
    credits = view(spark, sf, "title_principals").select("tconst", "nconst", "ordering", "category")
    target = credits.select("tconst", "nconst").distinct().select(
        "*", F.lit(0).alias("ordering"), F.lit("old").alias("category")
    )
    source = credits.filter(F.col("category") != "writer")
    return upsert(target, source, ["tconst", "nconst"], on_duplicate="last", order_by=["ordering", "category"])


def _needs_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Without t3, and with t4 only before the batch date, so that all three actions occur."""
    day = date(2024, 1, 30)
    name = F.col("table_name")
    run_log = view(spark, sf, "run_log").filter((name != "t3") & ((name != "t4") | (F.col("date") < F.lit(day))))
    return needs_refresh(run_log, view(spark, sf, "refresh_specs"), day)


def _land_drifted_header(spark: SparkSession, sf: str) -> DataFrame:
    """Raw titles with the columns in another order, one that is unknown, and without one of those that may be missing."""
    path = scratch_path(spark, "title_basics.tsv.gz")
    drifted = ["runtimeMinutes", F.concat("tconst", F.lit("!")).alias("note"), "STARTYEAR", "genres", "primaryTitle", "titleType", "tconst", "isAdult", "originalTitle"]
    _write_raw(view(spark, sf, "title_basics").select(*[F.col(c).alias(c) if isinstance(c, str) else c for c in drifted]), path)
    raw, _ = scan_tsv_reconciled(spark, path, TITLE_BASICS.schema, TITLE_BASICS.required)
    return land_table(raw, TITLE_BASICS, BATCH_DATE)


# The whole batch.


def _write_all_raw(spark: SparkSession, sf: str, inputs: dict[str, str], **other: str) -> None:
    """Raw text of all tables, written side by side: one alone has too few tasks, and too uneven ones, for all cores."""
    frames = [(view(spark, sf, other.get(name, name)), path) for name, path in inputs.items()]
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        list(pool.map(lambda frame: _write_raw(*frame), frames))


def _run_over(spark: SparkSession, sf: str, root: str, day: date, **other: str) -> None:
    """Raw text of all seven tables, and one run of the batch over it; ``other`` names other views for some."""
    inputs = {name: f"{path}-{day}" for name, path in raw_paths(root).items()}
    _write_all_raw(spark, sf, inputs, **other)
    run_batch(spark, inputs, root, day)


def _full_run(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lakehouse")
    _run_over(spark, sf, root, BATCH_DATE)
    return scan_table(spark, f"{root}/{AGGREGATED}/{KPIS}")


class _BrokenOff(Batch):
    """A run that ends before the fact table is made."""

    def _fact(self) -> None:
        raise InterruptedError("broken off")


def _resumed_run(spark: SparkSession, sf: str) -> DataFrame:
    """The second attempt finds the seven landed tables and both dimensions finished."""
    root = scratch_path(spark, "lakehouse")
    inputs = raw_paths(root)
    _write_all_raw(spark, sf, inputs)
    try:
        _BrokenOff(spark, inputs, root, BATCH_DATE, run_id="daily").run()
    except InterruptedError:
        pass
    run_batch(spark, inputs, root, BATCH_DATE, run_id="daily")
    return scan_table(spark, f"{root}/{AGGREGATED}/{KPIS}")


def _land_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two days over all tables; what the titles and credits, which the second day changed, have in the end."""
    root = scratch_path(spark, "lakehouse")
    _run_over(spark, sf, root, date(2024, 1, 30))
    _run_over(spark, sf, root, BATCH_DATE, title_basics="title_basics_2", title_principals="title_principals_2")
    titles = scan_table(spark, f"{root}/{LANDING}/title_basics", TITLE_BASICS.landed_schema)
    credits = scan_table(spark, f"{root}/{LANDING}/title_principals", TITLE_PRINCIPALS.landed_schema)
    return titles.select("tconst", F.lit(None).cast("string").alias("nconst"), F.col("startYear").cast("string").alias("value"), "today_date").unionByName(
        credits.select("tconst", "nconst", F.concat_ws(" ", "category", F.col("ordering").cast("string")).alias("value"), "today_date")
    )


def _upsert_table_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Credits, partitioned by category, with a key of two columns whose rows are replaced as a group."""
    path = scratch_path(spark, "credits")
    credits = lambda name: view(spark, sf, name).select("tconst", "nconst", F.col("ordering").cast("int"), "category")
    overwrite_table(credits("title_principals"), path, "category")
    upsert_table(credits("title_principals_2"), path, ["tconst", "nconst"], "category", on_duplicate="all")
    return scan_table(spark, path, credits("title_principals").schema)


def _two_days(spark: SparkSession, sf: str, *refreshes: Callable[[SparkSession, str], str]) -> str:
    """Titles, ratings and credits landed on two days, with what is made from them refreshed after each."""
    root = scratch_path(spark, "lakehouse")
    for day, suffix in ((date(2024, 1, 30), ""), (BATCH_DATE, "_2")):
        for spec in (TITLE_BASICS, TITLE_RATINGS, TITLE_PRINCIPALS):
            path, raw = f"{root}/{LANDING}/{spec.name}", view(spark, sf, spec.name + suffix)
            typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.schema])
            landed = typed.withColumn("today_date", F.lit(day))
            lasting = F.lit(True) if spec.min_votes is None else F.col("numVotes") > spec.min_votes
            if suffix:
                upsert_table(landed, path, list(spec.primary_key), spec.partition_by, spec.on_duplicate, keep=lasting)
            else:
                overwrite_table(evenly(landed.filter(lasting), spec.partition_by), path, spec.partition_by)
        for refresh in refreshes:
            refresh(spark, root)
    return root


def _fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The second day corrects the fact table by the titles that changed."""
    root = _two_days(spark, sf, refresh_fact)
    return scan_table(spark, f"{root}/{CLEANSED}/{FACT}", FACT_SCHEMA)


def _kpis_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The second day corrects the sums of the persons whose credits changed."""
    root = _two_days(spark, sf, refresh_fact, refresh_person_sums)
    return role_rows(_names(spark, sf), indicators(scan_table(spark, f"{root}/{AGGREGATED}/{PERSON_SUMS}")))


def entry(spark: SparkSession) -> DataFrame:
    """People by average rating, actors and actresses, from the raw tables at sf0.001."""
    return top_people(_role_kpis(spark, SMOKE_DIR), "both")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return lakehouse_queries() | ({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {})


def lakehouse_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    frames = {
        "scan_tsv_gz": _scan_tsv_gz,
        "scan_table": _scan_table,
        "scan_parquet": _scan_parquet,
        "write_overwrite": _write_overwrite,
        "write_partitioned": _write_partitioned,
        "replace_partition": _replace_partition,
        "upsert_table": _upsert_table,
        "land_table": lambda s, d: land_table(view(s, d, "title_basics"), TITLE_BASICS, BATCH_DATE),
        "land_ratings": _ratings,
        "land_drifted_header": _land_drifted_header,
        "cast_losses": lambda s, d: cast_losses(
            view(s, d, "title_basics"),
            {"startYear": IntegerType(), "endYear": ShortType(), "runtimeMinutes": ByteType(), "titleType": IntegerType()},
        ),
        "land_principals_sample": _land_principals_sample,
        "upsert": lambda s, d: upsert(view(s, d, "upsert_target"), view(s, d, "upsert_source"), ["tconst"]),
        "upsert_composite_key": _upsert_composite_key,
        "upsert_last": _upsert_last,
        "needs_refresh": _needs_refresh,
        "dim_names": _names,
        "dim_titles": lambda s, d: dim_titles(view(s, d, "title_basics")),
        "fact_principals": _fact,
        "fact_principals_json": lambda s, d: _fact(s, d, parse="json"),
        "fact_principals_balanced": lambda s, d: _fact(s, d, rows_per_share=2),
        "person_kpis": lambda s, d: person_kpis(_names(s, d), _fact(s, d)),
        "role_kpis": _role_kpis,
        "principal_kpis": lambda s, d: principal_kpis(_names(s, d), _fact(s, d)),
        "serving_kpis": lambda s, d: serving_kpis(principal_kpis(_names(s, d), _fact(s, d))),
        "top_people": lambda s, d: top_people(_role_kpis(s, d), "actor"),
        "top_people_both": lambda s, d: top_people(_role_kpis(s, d), "both"),
        "run_log_append": _run_log_append,
        "latest_success": lambda s, d: latest_success(view(s, d, "run_log")),
        "latest_success_of": lambda s, d: latest_success_of(view(s, d, "run_log"), "click", "t1"),
        "status_on_date": lambda s, d: status_on_date(view(s, d, "run_log"), date(2024, 1, 15)),
        "publish_run_log": lambda s, d: serving_run_log(view(s, d, "run_log")),
        "full_run": _full_run,
        "resumed_run": _resumed_run,
        "land_incremental": _land_incremental,
        "upsert_table_composite": _upsert_table_composite,
        "upsert_table_files": _upsert_table_files,
        "append_batches": _append_batches,
        "fact_incremental": _fact_incremental,
        "kpis_incremental": _kpis_incremental,
    }
    return {name: lambda s, d, frame=frame: _portable(frame(s, d)) for name, frame in frames.items()}


_KPI_VIEWS = ("name_basics", "title_basics", "title_ratings", "title_principals")
_TOTALS = r"""
n as (select nconst, primaryName as name from name_basics where try_cast(birthYear as int) > 1960 and try_cast(birthYear as int) < 2010),
f as (select b.tconst, try_cast(b.runtimeMinutes as int) as rt, r.rating, p.nconst, p.category as role
      from title_basics b
      left join (select tconst, cast(averageRating as decimal(10,1)) as rating from title_ratings where numVotes > 10000) r on b.tconst = r.tconst
      join title_principals p on b.tconst = p.tconst and p.category in ('actor', 'actress')
      where try_cast(b.startYear as int) > 1960 and try_cast(b.startYear as int) < 2020),
g as (select nconst, cast(cast(avg(rating) as decimal(14,5)) as double) as average_rating, cast(sum(rt) as bigint) as total_run_time_minutes,
      count(role) as total_titles_as_principal from f group by nconst),
principal_kpis as (select n.nconst, f.role, n.name, g.average_rating, g.total_run_time_minutes, g.total_titles_as_principal
      from n join f on n.nconst = f.nconst join g on n.nconst = g.nconst)"""
_FACT = r"""
select b.tconst, try_cast(b.runtimeMinutes as int) as run_time_minutes, cast(r.rating as double) as rating, r.num_votes, p.nconst, p.role, p.characters
from title_basics b
left join (select tconst, cast(averageRating as decimal(10,1)) as rating, numVotes as num_votes from title_ratings where numVotes > 10000) r on b.tconst = r.tconst
left join (select tconst, nconst, category as role, (len({characters}) || ' ' || array_to_string({characters}, '|')) as characters
           from title_principals where category in ('actor', 'actress')) p on b.tconst = p.tconst
where try_cast(b.startYear as int) > 1960 and try_cast(b.startYear as int) < 2020"""
_COMMA = r"string_split_regex(trim(regexp_replace(nullif(characters, '\N'), '[\[\]\"]', '', 'g')), '\s*,\s*')"
_JSON = r"cast(cast(nullif(characters, '\N') as json) as varchar[])"


# The raw tables as they are after the second day, under shorter names.
_SECOND_DAY = r"""
tb as (select tconst, startYear, runtimeMinutes from title_basics anti join title_basics_2 using (tconst)
  union all select tconst, startYear, runtimeMinutes from title_basics_2),
tr as (select tconst, averageRating, numVotes from title_ratings anti join title_ratings_2 using (tconst)
  union all select tconst, averageRating, numVotes from title_ratings_2),
tp as (select tconst, nconst, category, characters from title_principals anti join title_principals_2 using (tconst, nconst)
  union all select tconst, nconst, category, characters from title_principals_2)"""


def _second_day_oracle(body: str) -> str:
    for name, short in (("title_basics", "tb"), ("title_ratings", "tr"), ("title_principals", "tp")):
        body = body.replace(name, short)
    both = [f"{name}{suffix}" for name in _KPI_VIEWS[1:] for suffix in ("", "_2")]
    body = body.strip().removeprefix("with ")
    return with_views(f"with {_SECOND_DAY}{',' if ' as (' in body[:20] else ''} {body}", "name_basics", *both)


def _kpi_oracle(body: str) -> str:
    return with_views(f"with {_TOTALS}\n{body}", *_KPI_VIEWS)


def oracle_sql() -> dict[str, str]:
    """DuckDB text for every query."""
    log = "select stage, table_name, cast(date as varchar) as date, status"
    return (llm.ORACLES if llm else {}) | {
        "scan_tsv_gz": with_views(
            r"""
select tconst, titleType, primaryTitle, originalTitle, isAdult, try_cast(startYear as int) as startYear,
  try_cast(endYear as smallint) as endYear, try_cast(runtimeMinutes as int) as runtimeMinutes, nullif(genres, '\N') as genres
from title_basics""",
            "title_basics",
        ),
        "scan_table": with_views("select tconst, averageRating, numVotes from title_ratings", "title_ratings"),
        "scan_parquet": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
        "write_overwrite": with_views(
            "select tconst, averageRating, numVotes + 1 as numVotes from title_ratings", "title_ratings"
        ),
        "write_partitioned": with_views(
            """
select nconst, primaryName, try_cast(birthYear as int) as birthYear, deathYear, primaryProfession, knownForTitles, '2024-01-31' as today_date
from name_basics""",
            "name_basics",
        ),
        "replace_partition": with_views(
            f"""
{log} from run_log where table_name <> 't1'
union all select stage, table_name, cast(date as varchar) as date, 'replaced' as status from run_log where table_name = 't1'""",
            "run_log",
        ),
        "upsert_table": with_views(_UPSERT, "upsert_target", "upsert_source"),
        "upsert_table_files": with_views(_UPSERT, "upsert_target", "upsert_source"),
        "append_batches": with_views(
            f"""
select stage, table_name, cast(date as varchar) as date, 'success' as status from run_log where table_name <> 't1'
union all {log} from run_log where table_name = 't1'
union all {log} from run_log where table_name = 't1'""",
            "run_log",
        ),
        "land_table": with_views(
            """
select tconst, titleType, primaryTitle, originalTitle, isAdult, try_cast(startYear as int) as startYear, endYear, runtimeMinutes, genres,
  '2024-01-31' as today_date
from title_basics""",
            "title_basics",
        ),
        "land_drifted_header": with_views(
            r"""
select tconst, titleType, primaryTitle, originalTitle, isAdult, try_cast(startYear as int) as startYear, cast(null as smallint) as endYear,
  try_cast(runtimeMinutes as int) as runtimeMinutes, nullif(genres, '\N') as genres, '2024-01-31' as today_date
from title_basics""",
            "title_basics",
        ),
        "cast_losses": with_views(
            "\nunion all ".join(
                f"select '{column}' as column_name, count(nullif({column}, '\\N')) as n_values, "
                f"count(case when try_cast({column} as {kind}) is null then nullif({column}, '\\N') end) as n_lost from title_basics"
                for column, kind in (("startYear", "int"), ("endYear", "smallint"), ("runtimeMinutes", "tinyint"), ("titleType", "int"))
            ),
            "title_basics",
        ),
        "land_ratings": with_views(
            "select tconst, averageRating, numVotes, '2024-01-31' as today_date from title_ratings where numVotes > 10000",
            "title_ratings",
        ),
        "land_principals_sample": with_views(
            """
select tconst, ordering, nconst, category, job, characters, '2024-01-31' as today_date
from title_principals order by tconst, ordering, nconst, category, characters limit 1000""",
            "title_principals",
        ),
        "upsert": with_views(_UPSERT, "upsert_target", "upsert_source"),
        "upsert_composite_key": with_views(
            """
with c as (select tconst, nconst, ordering, category, characters,
    row_number() over (partition by tconst, nconst order by ordering, category, characters) as rn from title_principals),
t as (select tconst, nconst, category from c where rn = 1 and ordering % 3 <> 0),
s as (select tconst, nconst, concat(category, '*') as category from c where rn = 1 and ordering % 2 = 0)
select t.tconst, t.nconst, t.category from t
where not exists (select 1 from s where s.tconst = t.tconst and s.nconst = t.nconst)
union all select tconst, nconst, category from s""",
            "title_principals",
        ),
        "upsert_last": with_views(
            """
with s as (select tconst, nconst, ordering, category,
    row_number() over (partition by tconst, nconst order by ordering desc, category desc) as rn
  from title_principals where category <> 'writer')
select tconst, nconst, cast(ordering as int) as ordering, category from s where rn = 1
union all select distinct tconst, nconst, 0 as ordering, 'old' as category from title_principals p
where not exists (select 1 from s where s.tconst = p.tconst and s.nconst = p.nconst)""",
            "title_principals",
        ),
        "needs_refresh": with_views(
            """
select s.stage, s.table_name, cast(l.latest_date as varchar) as latest_date,
  case when l.latest_date is null then 'load' when l.latest_date <> date '2024-01-30' then 'upsert' else 'skip' end as action
from refresh_specs s left join (select stage, table_name, max(date) as latest_date from run_log
  where status = 'success' and table_name <> 't3' and (table_name <> 't4' or date < date '2024-01-30') group by stage, table_name) l
on s.stage = l.stage and s.table_name = l.table_name""",
            "run_log",
            "refresh_specs",
        ),
        "dim_names": with_views(
            r"""
select nconst, primaryName as name,
  (len(string_split_regex(trim(nullif(primaryProfession, '\N')), '\s*,\s*')) || ' ' || array_to_string(string_split_regex(trim(nullif(primaryProfession, '\N')), '\s*,\s*'), '|')) as profession,
  (len(string_split_regex(trim(nullif(knownForTitles, '\N')), '\s*,\s*')) || ' ' || array_to_string(string_split_regex(trim(nullif(knownForTitles, '\N')), '\s*,\s*'), '|')) as known_for_titles,
  case when try_cast(deathYear as smallint) is not null then false else true end as is_alive
from name_basics where try_cast(birthYear as int) > 1960 and try_cast(birthYear as int) < 2010""",
            "name_basics",
        ),
        "dim_titles": with_views(
            r"""
select tconst, titleType as type, primaryTitle as primary_title, originalTitle as original_title,
  case when isAdult = 0 then false else true end as is_adult,
  try_cast(startYear as smallint) as start_year, try_cast(endYear as smallint) as end_year,
  (len(string_split_regex(trim(nullif(genres, '\N')), '\s*,\s*')) || ' ' || array_to_string(string_split_regex(trim(nullif(genres, '\N')), '\s*,\s*'), '|')) as genres
from title_basics where try_cast(startYear as int) > 1960 and try_cast(startYear as int) < 2020""",
            "title_basics",
        ),
        "fact_principals": with_views(
            _FACT.format(characters=_COMMA), "title_basics", "title_ratings", "title_principals"
        ),
        "fact_principals_json": with_views(
            _FACT.format(characters=_JSON), "title_basics", "title_ratings", "title_principals"
        ),
        "fact_principals_balanced": with_views(
            _FACT.format(characters=_COMMA), "title_basics", "title_ratings", "title_principals"
        ),
        "person_kpis": _kpi_oracle(
            """
select n.nconst, g.average_rating, g.total_run_time_minutes, coalesce(g.total_titles_as_principal, 0) as total_titles_as_principal
from n left join g on n.nconst = g.nconst"""
        ),
        "role_kpis": _kpi_oracle(f"select {_KPI_COLUMNS}, count(*) as credits from principal_kpis group by {_KPI_COLUMNS}"),
        "principal_kpis": _kpi_oracle(f"select {_KPI_COLUMNS} from principal_kpis"),
        "serving_kpis": _kpi_oracle(f"select distinct {_KPI_COLUMNS} from principal_kpis"),
        "top_people": _kpi_oracle(f"select distinct {_KPI_COLUMNS} from principal_kpis where role = 'actor'"),
        "top_people_both": _kpi_oracle(
            """
select nconst, min(role) as role, name, average_rating, total_run_time_minutes, total_titles_as_principal
from principal_kpis group by nconst, name, average_rating, total_run_time_minutes, total_titles_as_principal"""
        ),
        "run_log_append": with_views(
            f"""
{log} from run_log
union all select stage, table_name, '2024-01-31' as date, 'success' as status from refresh_specs
union all select stage, table_name, '2024-01-31' as date, 'unsuccessful' as status from refresh_specs""",
            "run_log",
            "refresh_specs",
        ),
        "latest_success": with_views(
            "select stage, table_name, cast(max(date) as varchar) as latest_date from run_log where status = 'success' group by stage, table_name",
            "run_log",
        ),
        "latest_success_of": with_views(
            "select cast(max(date) as varchar) as latest_date from run_log where stage = 'click' and table_name = 't1' and status = 'success'",
            "run_log",
        ),
        "status_on_date": with_views(f"{log} from run_log where date = date '2024-01-15'", "run_log"),
        "publish_run_log": with_views(
            "select distinct stage, table_name, cast(date as varchar) as date, status from run_log", "run_log"
        ),
        "full_run": _kpi_oracle(f"select {_KPI_COLUMNS} from principal_kpis"),
        "resumed_run": _kpi_oracle(f"select {_KPI_COLUMNS} from principal_kpis"),
        "land_incremental": with_views(
            r"""
select t.tconst, cast(null as varchar) as nconst, cast(try_cast(t.startYear as int) as varchar) as value, '2024-01-30' as today_date
from title_basics t anti join title_basics_2 using (tconst)
union all select tconst, null as nconst, cast(try_cast(startYear as int) as varchar) as value, '2024-01-31' as today_date from title_basics_2
union all select t.tconst, t.nconst, concat(t.category, ' ', t.ordering) as value, '2024-01-30' as today_date
from title_principals t anti join title_principals_2 using (tconst, nconst)
union all select tconst, nconst, concat(category, ' ', ordering) as value, '2024-01-31' as today_date from title_principals_2""",
            "title_basics",
            "title_basics_2",
            "title_principals",
            "title_principals_2",
        ),
        "fact_incremental": _second_day_oracle(_FACT.format(characters=_COMMA)),
        "kpis_incremental": _second_day_oracle(
            f"with {_TOTALS}\nselect {_KPI_COLUMNS}, count(*) as credits from principal_kpis group by {_KPI_COLUMNS}"
        ),
        "upsert_table_composite": with_views(
            """
select t.tconst, t.nconst, cast(t.ordering as int) as ordering, t.category
from title_principals t anti join title_principals_2 using (tconst, nconst)
union all select tconst, nconst, cast(ordering as int) as ordering, category from title_principals_2""",
            "title_principals",
            "title_principals_2",
        ),
    }


_KPI_COLUMNS = "nconst, role, name, average_rating, total_run_time_minutes, total_titles_as_principal"
_UPSERT = """
select t.tconst, t.runtime, cast(t.today_date as varchar) as today_date from upsert_target t
where not exists (select 1 from upsert_source s where s.tconst = t.tconst)
union all select tconst, runtime, cast(today_date as varchar) as today_date from upsert_source"""
