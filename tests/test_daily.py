import gzip
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

from marquee.operators.kpis import top_people
from marquee.plans import daily
from marquee.plans.daily import raw_paths, read_landed, read_run_log, run_batch
from marquee.sources.files import scan_table
from marquee.specs import FACT_SCHEMA, KPIS, NAME_BASICS, SERVED_RUN_LOG, TABLES, TITLE_BASICS, TITLE_PRINCIPALS

D1, D2 = date(2024, 1, 30), date(2024, 1, 31)
RAW = {
    "name_basics": [
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
        "nm1 Ann 1970 \\N actor,writer tt1,tt2",
        "nm2 Bob 1980 2015 \\N \\N",
        "nm3 Cid \\N \\N \\N \\N",
    ],
    "title_basics": [
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres",
        "tt1 movie A A 0 2000 \\N 90 Drama",
        "tt2 movie B B 0 2001 \\N \\N \\N",
        "tt3 movie C C 1 1950 \\N 60 Drama",
    ],
    "title_principals": [
        "tconst ordering nconst category job characters",
        'tt1 1 nm1 actor \\N ["A"]',
        'tt1 2 nm1 actor \\N ["B"]',
        "tt2 1 nm2 actress \\N \\N",
        "tt2 2 nm3 director \\N \\N",
    ],
    "title_ratings": ["tconst averageRating numVotes", "tt1 7.5 20000", "tt2 9.0 10000"],
    "title_akas": ["titleId ordering title", "tt1 1 A", "tt1 2 B"],
    "title_crew": ["tconst directors", "tt1 nm3"],
    "title_episode": ["tconst parentTconst", "tt9 tt1"],
}


def write_raw(root, **changed):
    for name, lines in {**RAW, **changed}.items():
        path = Path(root) / "cache" / f"{name}.tsv.gz"
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt", encoding="utf-8") as file:
            file.write("".join(line.replace(" ", "\t") + "\n" for line in lines))


class Store:
    """Keeps what is published, in place of a database."""

    def __init__(self):
        self.tables = {}

    def __call__(self, frame, table):
        self.tables[table] = [tuple(row) for row in frame.collect()]


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root)
    store = Store()

    def run(day):
        run_batch(spark, raw_paths(root), root, day, publish=store)

    return root, store, run


def log_of(spark, root, day):
    return {tuple(r) for r in read_run_log(spark, root).collect() if r["date"] == day}


STAGES = {
    *{("cache", name) for name in TABLES},
    *{("landing_zone", name) for name in TABLES},
    ("cleansed_dim_names", "dim_names"),
    ("cleansed_dim_titles", "dim_titles"),
    ("cleansed_fact_title_principals", "fact_title_principals"),
    ("aggregated_zone", "actors_actress_kpis"),
}


def test_first_run(spark, lake, rows):
    root, store, run = lake
    run(D1)
    assert log_of(spark, root, D1) == {(*stage, D1, "success") for stage in STAGES}
    assert set(store.tables[SERVED_RUN_LOG]) == log_of(spark, root, D1)

    assert rows(read_landed(spark, root, NAME_BASICS).select("nconst", "birthYear", "deathYear", "today_date")) == [
        ("nm1", 1970, None, D1),
        ("nm2", 1980, 2015, D1),
        ("nm3", None, None, D1),
    ]
    assert rows(scan_table(spark, f"{root}/landing_zone/title_akas").select("titleId", "ordering")) == [("tt1", 1), ("tt1", 2)]
    assert read_landed(spark, root, TABLES["title_ratings"]).count() == 1
    assert rows(scan_table(spark, f"{root}/cleansed_zone/fact_title_principals", FACT_SCHEMA)) == [
        ("tt1", 90, Decimal("7.5"), 20000, "nm1", "actor", ["A"]),
        ("tt1", 90, Decimal("7.5"), 20000, "nm1", "actor", ["B"]),
        ("tt2", None, None, None, "nm2", "actress", None),
    ]
    ann = ("nm1", "actor", "Ann", Decimal("7.50000"), 180, 2)
    bob = ("nm2", "actress", "Bob", None, None, 1)
    kpis = scan_table(spark, f"{root}/aggregated_zone/actors_actress_kpis")
    assert rows(kpis) == [ann, ann, bob]
    assert [tuple(r) for r in top_people(kpis, "both").collect()] == [ann, bob]
    assert sorted(store.tables[KPIS]) == [ann, bob]


def test_second_run_of_the_day_skips_landing(spark, lake, monkeypatch):
    root, store, run = lake
    run(D1)

    def unexpected(*arguments):
        raise AssertionError("landed again")

    monkeypatch.setattr(daily, "scan_tsv_checked", unexpected)
    run(D1)
    assert log_of(spark, root, D1) == {(*stage, D1, "success") for stage in STAGES}
    assert read_run_log(spark, root).count() == 2 * len(STAGES)
    assert len(store.tables[SERVED_RUN_LOG]) == len(STAGES)


def test_next_day_upserts(spark, lake, rows):
    root, store, run = lake
    run(D1)
    write_raw(
        root,
        title_basics=[RAW["title_basics"][0], "tt2 movie B2 B2 0 2002 \\N 50 Drama", "tt4 movie D D 0 2003 \\N 30 \\N"],
        title_principals=[RAW["title_principals"][0], 'tt1 1 nm1 actress \\N ["Z"]'],
        title_akas=[RAW["title_akas"][0], "tt1 2 7", "tt1 3 8"],
    )
    run(D2)
    titles = read_landed(spark, root, TITLE_BASICS).select("tconst", "primaryTitle", "startYear", "today_date")
    assert rows(titles) == [
        ("tt1", "A", 2000, D1),
        ("tt2", "B2", 2002, D2),
        ("tt3", "C", 1950, D1),
        ("tt4", "D", 2003, D2),
    ]
    akas = scan_table(spark, f"{root}/landing_zone/title_akas").drop("today_date")
    assert rows(akas) == [("tt1", 1, "A"), ("tt1", 2, "7"), ("tt1", 3, "8")]  # title stays text
    credits = read_landed(spark, root, TITLE_PRINCIPALS).select("tconst", "nconst", "category", "characters")
    assert rows(credits) == [
        ("tt1", "nm1", "actress", '["Z"]'),
        ("tt2", "nm2", "actress", None),
        ("tt2", "nm3", "director", None),
    ]
    assert ("nm1", "actress", "Ann", Decimal("7.50000"), 90, 1) in store.tables[KPIS]
    assert log_of(spark, root, D1) and log_of(spark, root, D2)


def test_failing_stage_is_logged_and_the_log_published(spark, lake):
    root, store, run = lake
    write_raw(root, title_ratings=["wrong header here", "tt1 7.5 20000"])
    with pytest.raises(Exception, match="CSV header"):
        run(D1)
    log = log_of(spark, root, D1)
    assert ("landing_zone", "title_ratings", D1, "unsuccessful") in log
    assert ("landing_zone", "name_basics", D1, "success") in log
    assert not [row for row in log if row[0].startswith("cleansed")]
    assert set(store.tables[SERVED_RUN_LOG]) == log
    assert KPIS not in store.tables

    write_raw(root)
    run(D1)
    assert {(*stage, D1, "success") for stage in STAGES} <= log_of(spark, root, D1)


def test_missing_input_is_a_failed_stage(spark, lake):
    root, store, run = lake
    inputs = {**raw_paths(root), "title_crew": f"{root}/cache/nothing.tsv.gz"}
    with pytest.raises(FileNotFoundError, match="title_crew"):
        run_batch(spark, inputs, root, D1, publish=store)
    log = log_of(spark, root, D1)
    assert ("cache", "title_crew", D1, "unsuccessful") in log
    assert {row[0] for row in log} == {"cache"}
    assert set(store.tables[SERVED_RUN_LOG]) == log


def test_log_is_empty_before_the_first_run(spark, tmp_path):
    assert read_run_log(spark, str(tmp_path)).count() == 0


def test_bad_lines_are_kept_aside(spark, lake, rows):
    root, store, run = lake
    many = [f"tt{i} parent{i} {i}" for i in range(300)]
    write_raw(root, title_episode=["tconst parentTconst seasonNumber", *many, "short line", "tt9 tt1 2 surplus"])
    run(D1)
    episodes = f"{root}/landing_zone/title_episode"
    assert scan_table(spark, episodes).count() == 300
    rejected = scan_table(spark, f"{root}/rejected/title_episode")
    assert rows(rejected) == [(D1, "short\tline"), (D1, "tt9\ttt1\t2\tsurplus")]
    write_raw(root, title_episode=["tconst parentTconst seasonNumber", "tt1 new 2b", *many[2:]])  # no number: stays text
    run(D2)
    assert rows(scan_table(spark, episodes).filter("tconst = 'tt1'").select("parentTconst", "seasonNumber")) == [("new", "2b")]


def test_too_many_bad_lines_fail_the_stage(spark, lake):
    root, store, run = lake
    write_raw(root, title_ratings=["tconst averageRating numVotes", "tt1 7.5 20000", "tt2 nine 30000"])
    with pytest.raises(ValueError, match="1 of 2 lines of title_ratings do not fit"):
        run(D1)
    assert ("landing_zone", "title_ratings", D1, "unsuccessful") in log_of(spark, root, D1)
    assert [r.line for r in scan_table(spark, f"{root}/rejected/title_ratings").collect()] == ["tt2\tnine\t30000"]


def test_first_load_refuses_a_repeated_key(spark, lake):
    root, store, run = lake
    write_raw(root, title_basics=[*RAW["title_basics"], RAW["title_basics"][1]], title_crew=["tconst directors", "tt1 a", "tt1 b"])
    with pytest.raises(BaseExceptionGroup) as raised:
        run(D1)
    assert sorted(str(e) for e in raised.value.exceptions) == ["several source rows for key tt1"] * 2


def test_rating_that_falls_below_the_threshold_goes(spark, lake, rows):
    root, store, run = lake
    run(D1)
    write_raw(root, title_ratings=["tconst averageRating numVotes", "tt1 7.5 9000", "tt3 8.0 10001"])
    run(D2)
    assert rows(read_landed(spark, root, TABLES["title_ratings"]).select("tconst", "today_date")) == [("tt3", D2)]
