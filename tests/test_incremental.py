from datetime import date

import pytest
from pyspark.sql import functions as F

from marquee.operators.changes import added_up, changed_keys, indicators, person_sums
from marquee.operators.cleansed import fact_principals
from marquee.operators.kpis import person_kpis, role_kpis, role_rows
from marquee.plans import incremental
from marquee.plans.incremental import CORRECTED, REBUILT, refresh_fact, refresh_person_sums
from marquee.sources import versions
from marquee.sources.files import scan_table
from marquee.sources.tables import compact_table, overwrite_table, upsert_table
from marquee.specs import FACT_SCHEMA, TITLE_BASICS, TITLE_PRINCIPALS, TITLE_RATINGS

D1, D2 = date(2024, 1, 30), date(2024, 1, 31)
SPECS = (TITLE_BASICS, TITLE_RATINGS, TITLE_PRINCIPALS)


def title(key, year=2000, minutes=90, day=D1):
    return (key, "movie", "A", "A", 0, year, None, minutes, "Drama", day)


def credit(key, person, role="actor", number=1, characters='["X"]', day=D1):
    return (key, number, person, role, None, characters, day)


FIRST = {
    "title_basics": [title("t1"), title("t2"), title("t3"), title("t4", minutes=None), title(None)],
    "title_ratings": [("t1", 7.5, 20000, D1), ("t2", 6.5, 20000, D1), (None, 5.0, 20000, D1)],
    "title_principals": [
        credit("t1", "p1"), credit("t1", "p1", number=2), credit("t1", "p2", "actress"), credit("t2", "p1"),
        credit("t3", "p3"), credit("t3", "p4", "writer"), credit("t4", "p5"), credit("t2", None), credit(None, "p1"),
    ],
}


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path)
    for spec in SPECS:
        frame = spark.createDataFrame(FIRST[spec.name], spec.landed_schema)
        overwrite_table(frame.repartitionByRange(3, "tconst"), f"{root}/landing_zone/{spec.name}", spec.partition_by)
    return root


def land(spark, root, spec, rows, keep=None):
    frame = spark.createDataFrame(rows, spec.landed_schema)
    upsert_table(frame, f"{root}/landing_zone/{spec.name}", list(spec.primary_key), spec.partition_by, "all", keep=keep)


def anew(spark, root):
    return fact_principals(*[scan_table(spark, f"{root}/landing_zone/{s.name}", s.landed_schema) for s in SPECS])


def fact_of(spark, root):
    return scan_table(spark, f"{root}/cleansed_zone/fact_title_principals", FACT_SCHEMA)


def sums_of(spark, root):
    return scan_table(spark, f"{root}/aggregated_zone/person_sums")


def refresh(spark, root):
    return refresh_fact(spark, root), refresh_person_sums(spark, root)


def assert_as_if_anew(spark, root, rows):
    fact = anew(spark, root)
    assert rows(fact_of(spark, root)) == rows(fact.select(*FACT_SCHEMA.names))
    assert rows(sums_of(spark, root)) == rows(person_sums(fact))


CHANGES = {
    "nothing but the date": lambda s, r: land(s, r, TITLE_BASICS, [title("t1", day=D2), title("t3", day=D2)]),
    "run time": lambda s, r: land(s, r, TITLE_BASICS, [title("t1", minutes=30, day=D2)]),
    "title leaves the years": lambda s, r: land(s, r, TITLE_BASICS, [title("t1", year=1900, day=D2)]),
    "new title and credit": lambda s, r: (
        land(s, r, TITLE_BASICS, [title("t9", day=D2)]), land(s, r, TITLE_PRINCIPALS, [credit("t9", "p9", day=D2)])),
    "rating taken back": lambda s, r: land(s, r, TITLE_RATINGS, [("t1", 7.5, 10, D2)], F.col("numVotes") > 10000),
    "new rating": lambda s, r: land(s, r, TITLE_RATINGS, [("t3", 3.3, 30000, D2)]),
    "one copy of a credit less": lambda s, r: land(s, r, TITLE_PRINCIPALS, [credit("t1", "p1", day=D2)]),
    "last credit of a person": lambda s, r: land(s, r, TITLE_PRINCIPALS, [credit("t3", "p3", "writer", day=D2)]),
    "role and characters": lambda s, r: land(s, r, TITLE_PRINCIPALS, [credit("t1", "p2", "actor", 1, None, D2)]),
    "rows without a key": lambda s, r: (
        land(s, r, TITLE_BASICS, [title(None, day=D2)]), land(s, r, TITLE_PRINCIPALS, [credit(None, "p1", day=D2)])),
}


@pytest.mark.parametrize(
    "changes",
    [
        ["nothing but the date"],
        ["title leaves the years", "new rating", "rows without a key"],
        ["rating taken back", "one copy of a credit less", "new title and credit"],
        ["run time", "last credit of a person", "role and characters"],
    ],
)
def test_corrected_equals_rebuilt(spark, lake, rows, changes):
    assert refresh(spark, lake) == (REBUILT, REBUILT)
    assert_as_if_anew(spark, lake, rows)
    for change in changes:
        CHANGES[change](spark, lake)
    assert refresh(spark, lake) == (CORRECTED, CORRECTED)
    assert_as_if_anew(spark, lake, rows)


def test_several_days_and_packed_sources(spark, lake, rows):
    refresh(spark, lake)
    for change in CHANGES.values():
        change(spark, lake)
    compact_table(spark, f"{lake}/landing_zone/title_basics", "startYear", 1)
    assert refresh(spark, lake) == (CORRECTED, CORRECTED)
    assert refresh(spark, lake) == (CORRECTED, CORRECTED)  # nothing left to do
    assert_as_if_anew(spark, lake, rows)


def test_only_changed_titles_are_made_anew(spark, lake, monkeypatch):
    refresh(spark, lake)
    CHANGES["run time"](spark, lake)
    seen = []
    original = incremental.fact_principals

    def watched(titles, ratings, principals):
        seen.extend(r["tconst"] for r in titles.collect())
        return original(titles, ratings, principals)

    monkeypatch.setattr(incremental, "fact_principals", watched)
    refresh_fact(spark, lake)
    assert sorted(seen, key=str) == [None, "t1"]


@pytest.mark.parametrize("step", ["written", "publish", "release"])
def test_broken_off_and_repeated(spark, lake, rows, monkeypatch, step):
    refresh(spark, lake)
    CHANGES["one copy of a credit less"](spark, lake)

    def broken(*_, **__):
        raise KeyboardInterrupt

    for job in (refresh_fact, refresh_person_sums):
        with monkeypatch.context() as patched:
            patched.setattr(versions, step, broken)
            with pytest.raises(KeyboardInterrupt):
                job(spark, lake)
        job(spark, lake)
    assert_as_if_anew(spark, lake, rows)
    CHANGES["rating taken back"](spark, lake)
    assert refresh(spark, lake) == (CORRECTED, CORRECTED)
    assert_as_if_anew(spark, lake, rows)


def test_rebuilt_if_a_source_has_no_versions_or_lost_one(spark, lake, rows):
    refresh(spark, lake)
    ratings = f"{lake}/landing_zone/title_ratings"
    versions.release(spark, ratings, "fact_title_principals", but=-1)
    CHANGES["new rating"](spark, lake)
    assert refresh_fact(spark, lake) == REBUILT
    assert refresh_person_sums(spark, lake) == CORRECTED  # by all of the fact table's files
    assert_as_if_anew(spark, lake, rows)


def test_held_files_go_when_released(spark, lake):
    refresh(spark, lake)
    path = f"{lake}/landing_zone/title_basics"
    first = set(versions.current(spark, path).files)
    CHANGES["run time"](spark, lake)
    held = versions.at(spark, path, 1)
    assert held is not None and set(held.files) == first
    refresh(spark, lake)
    CHANGES["title leaves the years"](spark, lake)
    assert versions.at(spark, path, 1) is None


def test_changed_keys_see_copies_and_the_place_of_nulls(spark, rows):
    schema = "k string, a string, b string"
    before = [("same", "x", None), ("copies", "x", "y"), ("moved", "x", None), ("gone", "x", "y"), (None, "x", "y")]
    after = [("same", "x", None), ("copies", "x", "y"), ("copies", "x", "y"), ("moved", None, "x"), ("new", None, None)]
    changed = changed_keys(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), "k")
    assert rows(changed) == [("copies",), ("gone",), ("moved",), ("new",)]
    empty = spark.createDataFrame([], schema)
    assert rows(changed_keys(empty, empty, "k")) == []


def test_indicators_equal_those_of_the_fact(spark, lake, rows):
    fact = anew(spark, lake)
    names = spark.createDataFrame([(f"p{i}", f"P{i}") for i in range(1, 6)], "nconst string, name string")
    halves = [fact.filter("tconst <= 't1'"), fact.filter("tconst > 't1'")]
    sums = added_up(*[person_sums(half) for half in halves])
    assert rows(role_rows(names, indicators(sums))) == rows(role_kpis(names, fact))
    known = person_kpis(names, fact).filter("total_titles_as_principal > 0")
    assert rows(indicators(sums).select(*known.columns)) == rows(known)
    assert rows(added_up(person_sums(fact), person_sums(fact, -1))) == []


def test_sums_and_changes_use_no_wide_decimals(spark, lake):
    fact = anew(spark, lake)
    sums, changes = (df._jdf.queryExecution().optimizedPlan().toString() for df in (person_sums(fact), changed_keys(fact, fact, "tconst")))
    assert "sum(rating" not in sums and "decimal(20,0)" not in changes


def test_sums_of_ratings_are_exact(spark):
    fact = spark.createDataFrame([("p", "actor", r, 1) for r in ("0.1", "0.2", "9.9", None)], "nconst string, role string, r string, run_time_minutes int")
    fact = fact.withColumn("rating", F.col("r").cast("decimal(10,1)"))
    for sign in (1, -1):
        row = person_sums(fact, sign).first()
        assert str(row.rating_sum) == ("10.2" if sign == 1 else "-10.2") and row.rated == 3 * sign
    assert person_sums(fact).schema["rating_sum"].dataType.simpleString() == "decimal(20,1)"
