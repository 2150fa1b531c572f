from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.operators.cleansed import dim_names, dim_titles, fact_principals

N = "\\N"
NAMES = "nconst string, primaryName string, birthYear string, deathYear string, primaryProfession string, knownForTitles string"
TITLES = (
    "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, "
    "startYear string, endYear string, runtimeMinutes string, genres string"
)
RATINGS = "tconst string, averageRating double, numVotes int"
PRINCIPALS = "tconst string, ordering int, nconst string, category string, job string, characters string"


def title(tconst, year="2000", runtime="90", adult="0", end=N, genres="Drama"):
    return (tconst, "movie", "A", "B", adult, year, end, runtime, genres)


def test_dim_names_from_text(spark):
    df = spark.createDataFrame(
        [
            ("nm1", "Ann", "1970", N, "actor, writer", "tt1,tt2"),
            ("nm2", "Bob", "1970", "2015", N, N),
            ("nm3", "Cid", "1960", N, N, N),
            ("nm4", "Dee", "2010", N, N, N),
            ("nm5", "Eve", N, N, N, N),
            ("nm6", "Fay", None, N, N, N),
            ("nm7", "Gus", "1970.5", N, N, N),
        ],
        NAMES,
    )
    result = dim_names(df)
    assert result.columns == ["nconst", "name", "profession", "known_for_titles", "is_alive"]
    assert [tuple(r) for r in result.orderBy("nconst").collect()] == [
        ("nm1", "Ann", ["actor", "writer"], ["tt1", "tt2"], True),
        ("nm2", "Bob", None, None, False),
    ]


def test_dim_names_keeps_batch_date_and_typed_columns(spark):
    df = spark.createDataFrame(
        [("nm1", "Ann", 1970, None, None, "", date(2024, 1, 31))],
        "nconst string, primaryName string, birthYear int, deathYear smallint, primaryProfession string, "
        "knownForTitles string, today_date date",
    )
    assert dim_names(df).first().asDict() == {
        "nconst": "nm1",
        "name": "Ann",
        "profession": None,
        "known_for_titles": [""],
        "today_date": date(2024, 1, 31),
        "is_alive": True,
    }


def test_dim_titles(spark):
    df = spark.createDataFrame(
        [
            title("tt1", end="2005", genres="Drama, Comedy"),
            title("tt2", adult="1", genres=N),
            title("tt3", adult=None),
            title("tt4", year="1960"),
            title("tt5", year="2020"),
            title("tt6", year=N),
            title("tt7", end="40000"),
        ],
        TITLES,
    )
    result = dim_titles(df)
    types = {f.name: f.dataType.simpleString() for f in result.schema}
    assert types == {
        "tconst": "string",
        "type": "string",
        "primary_title": "string",
        "original_title": "string",
        "is_adult": "boolean",
        "start_year": "smallint",
        "end_year": "smallint",
        "genres": "array<string>",
    }
    found = {r["tconst"]: (r["is_adult"], r["start_year"], r["end_year"], r["genres"]) for r in result.collect()}
    assert found == {
        "tt1": (False, 2000, 2005, ["Drama", "Comedy"]),
        "tt2": (True, 2000, None, None),
        "tt3": (True, 2000, None, ["Drama"]),
        "tt7": (False, 2000, None, ["Drama"]),
    }


@pytest.fixture
def raw(spark):
    titles = spark.createDataFrame([title("tt1"), title("tt2", runtime=N), title("tt3"), title("tt4", year="1950")], TITLES)
    ratings = spark.createDataFrame([("tt1", 6.25, 20000), ("tt4", 9.0, 20000), ("tt9", 9.0, 20000)], RATINGS)
    principals = spark.createDataFrame(
        [
            ("tt1", 1, "nm1", "actor", N, '["A","B"]'),
            ("tt1", 2, "nm2", "actress", N, N),
            ("tt1", 3, "nm3", "director", N, N),
            ("tt2", 1, "nm1", "actor", N, None),
            ("tt3", 1, "nm3", "writer", N, N),
            ("tt4", 1, "nm1", "actor", N, N),
            (None, 1, "nm1", "actor", N, N),
        ],
        PRINCIPALS,
    )
    return titles, ratings, principals


FACT_ROWS = {
    ("tt1", 90, Decimal("6.3"), 20000, "nm1", "actor", ("A", "B")),
    ("tt1", 90, Decimal("6.3"), 20000, "nm2", "actress", None),
    ("tt2", None, None, None, "nm1", "actor", None),
    ("tt3", 90, None, None, None, None, None),
}


def as_set(frame):
    found = [(*row[:-1], tuple(row[-1]) if row[-1] else None) for row in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("rows_per_share", [1_000_000, 1, 2, 1000])
def test_fact_principals(raw, rows_per_share):
    result = fact_principals(*raw, rows_per_share=rows_per_share)
    assert result.columns == ["tconst", "run_time_minutes", "rating", "num_votes", "nconst", "role", "characters"]
    assert as_set(result) == FACT_ROWS


def test_fact_principals_parses_json(spark, raw):
    titles, ratings, principals = raw
    principals = principals.withColumn("characters", F.lit('["Self","Host, The"]'))
    characters = {tuple(r["characters"]) for r in fact_principals(titles, ratings, principals, parse="json").dropna().collect()}
    assert characters == {("Self", "Host, The")}
    assert len(fact_principals(titles, ratings, principals).dropna().first()["characters"]) == 3
