"""What the physical plans must look like to hold at scale."""

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from marquee.operators.cleansed import dim_names, dim_titles, fact_principals
from marquee.operators.kpis import principal_kpis, role_kpis, serving_kpis, top_people
from marquee.operators.landing import upsert
from marquee.operators.runlog import latest_success, status_on_date
from marquee.sources.files import scan_table
from marquee.sources.tables import _is_one_of, overwrite_table
from marquee.specs import (
    FACT_SCHEMA,
    NAME_BASICS,
    RUN_LOG_SCHEMA,
    TITLE_BASICS,
    TITLE_PRINCIPALS,
    TITLE_RATINGS,
)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture
def shuffled(spark):
    """As if no table were small enough to broadcast unasked."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")

    def stored(spec, rows):
        path = str(root / spec.name)
        overwrite_table(spark.createDataFrame(rows, spec.landed_schema), path, spec.partition_by)
        return scan_table(spark, path, spec.landed_schema)

    day = date(2024, 1, 31)
    names = stored(NAME_BASICS, [("nm1", "Ann", 1970, None, None, None, day)])
    titles = stored(TITLE_BASICS, [("tt1", "movie", "A", "A", 0, 2000, None, 90, None, day)])
    principals = stored(TITLE_PRINCIPALS, [("tt1", n, "nm1", "actor", None, None, day) for n in range(5)])
    ratings = stored(TITLE_RATINGS, [("tt1", 7.5, 20000, day)])
    fact_path = str(root / "fact")
    overwrite_table(fact_principals(titles, ratings, principals), fact_path, "role")
    return {
        "names": names,
        "titles": titles,
        "principals": principals,
        "ratings": ratings,
        "fact": scan_table(spark, fact_path, FACT_SCHEMA),
    }


def test_dimensions_are_narrow_and_pruned_by_year(landed):
    for frame, year in ((dim_names(landed["names"]), "birthYear"), (dim_titles(landed["titles"]), "startYear")):
        text = plan(frame)
        assert exchanges(text) == []
        assert re.search(rf"PartitionFilters: \[[^\]]*{year}#\d+ > 1960", text)


def test_fact_shuffles_each_input_once(landed, shuffled):
    text = plan(fact_principals(landed["titles"], landed["ratings"], landed["principals"]))
    assert len(re.findall(r"hashpartitioning\(tconst#\d+, _share#\d+", text)) == 3
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert re.search(r"PartitionFilters: \[category#\d+ IN \(actor,actress\)\]", text)
    assert re.search(r"PartitionFilters: \[[^\]]*startYear#\d+ > 1960", text)


def test_balanced_fact_adds_only_the_count_of_heavy_keys(landed, shuffled):
    text = plan(fact_principals(landed["titles"], landed["ratings"], landed["principals"], rows_per_share=10))
    on_key_and_share = re.findall(r"hashpartitioning\(tconst#\d+, _share#\d+", text)
    counted = re.findall(r"hashpartitioning\(tconst#\d+, \d+\)", text)
    assert len(on_key_and_share) == 3
    assert len(counted) == 3  # the same count for each input: run once and reused
    assert "TakeOrdered" not in text and "Limit" not in text


def test_heavy_keys_are_counted_once(landed, shuffled):
    frame = fact_principals(landed["titles"], landed["ratings"], landed["principals"], rows_per_share=2)
    assert len(frame.collect()) == 5
    final = plan(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"partial_count", final)) == 1
    assert len(re.findall(r"ReusedExchange", final)) == 2


def test_kpis_shuffle_totals_not_credits(landed, shuffled):
    text = plan(principal_kpis(landed["names"].select("nconst", F.col("primaryName").alias("name")), landed["fact"]))
    assert len(exchanges(text)) == 3  # totals and names on the person, then the rows to repeat
    assert "partial_avg" in text and "Window" not in text
    assert re.search(r"PartitionFilters: \[[^\]]*role#\d+ IN \(actor,actress\)", text)
    assert re.search(r"ReadSchema: struct<run_time_minutes:int,rating:decimal\(10,1\),nconst:string>", text)


def test_kpis_of_a_balanced_fact_need_only_matched_credits(landed, shuffled):
    fact = fact_principals(landed["titles"], landed["ratings"], landed["principals"], rows_per_share=10)
    text = plan(role_kpis(landed["names"].select("nconst", F.col("primaryName").alias("name")), fact))
    assert "Union" not in text
    assert re.search(r"SortMergeJoin \[tconst#\d+, _share#\d+\], \[tconst#\d+, _share#\d+\], Inner", text)
    assert "characters" not in text


def test_kpi_reports_use_hash_aggregation(landed, shuffled):
    names = landed["names"].select("nconst", F.col("primaryName").alias("name"))
    kpis = role_kpis(names, landed["fact"])
    for frame in (kpis, serving_kpis(kpis), top_people(kpis, "both"), top_people(kpis, "actor")):
        assert "SortAggregate" not in plan(frame)
    assert "rangepartitioning" in plan(top_people(kpis, "both"))


def test_small_upsert_does_not_shuffle_the_target(landed):
    target = landed["ratings"]
    text = plan(upsert(target, target.filter("tconst = 'tt1'"), ["tconst"]))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", text)
    scan_to_join = text[: text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in scan_to_join


def test_hot_key_of_the_target_is_cut(spark, shuffled):
    """A third of the target shares one key; AQE's thresholds are lowered to the size of the test."""
    ids = spark.range(0, 600_000, 1, 16)
    target = ids.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    source = spark.range(1, 300_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    with settings(
        spark,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB",
    ):
        result = upsert(target, source, ["k"])
        kept = [row["k"] for row in result.collect() if row["v"] != "new"]
        assert len(kept) == 400_000 and kept.count(0) == 200_000
        assert re.search(r"SortMergeJoin\(skew=true\).*LeftAnti", plan(result).split("== Initial Plan ==")[0])


def test_rows_without_key_are_found_by_statistics(landed):
    text = plan(upsert(landed["ratings"], landed["ratings"], ["tconst"]))
    assert "PushedFilters: [IsNull(tconst)]" in text


def test_upsert_prunes_partitions(landed):
    for values in (["actor"], ["actor", None], [None]):
        for condition in (_is_one_of("category", values), ~_is_one_of("category", values)):
            text = plan(landed["principals"].filter(condition))
            assert re.search(r"PartitionFilters: \[[^\]]*category#", text), text
            assert "Filter" not in text.split("FileScan")[0]


def test_run_log_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    overwrite_table(spark.createDataFrame([("s", "t", date(2024, 1, 1), "success")], RUN_LOG_SCHEMA), path, "table_name")
    log = scan_table(spark, path, RUN_LOG_SCHEMA)
    assert "EqualTo(date,2024-01-01)" in plan(status_on_date(log, date(2024, 1, 1)))
    assert "EqualTo(status,success)" in plan(latest_success(log))
    assert "partial_max" in plan(latest_success(log))
