from collections import Counter
from decimal import Decimal

import pytest

from marquee.operators.kpis import person_kpis, principal_kpis, role_kpis, serving_kpis, top_people

FACT = "tconst string, run_time_minutes int, rating decimal(10,1), num_votes int, nconst string, role string, characters array<string>"


def credit(tconst, nconst, role, runtime, rating):
    return (tconst, runtime, Decimal(rating) if rating else None, 1, nconst, role, None)


@pytest.fixture
def names(spark):
    return spark.createDataFrame([("nm1", "Ann"), ("nm2", "Bob"), ("nm3", "Cid"), ("nm4", "Dee")], "nconst string, name string")


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            credit("tt1", "nm1", "actor", 100, "7.1"),
            credit("tt2", "nm1", "actress", 50, "7.2"),
            credit("tt3", "nm1", "actor", None, "7.2"),
            credit("tt1", "nm2", "actress", 100, None),
            credit("tt1", "nm4", "actor", 10, "9.0"),
            credit("tt1", "nm4", "actor", 10, "9.0"),
            credit("tt1", "nm9", "actor", 10, "9.0"),
            credit("tt1", "nm3", "director", 10, "9.0"),
            credit("tt4", None, None, 10, "9.0"),
        ],
        FACT,
    )


ANN = ("Ann", Decimal("7.16667"), 150, 3)
BOB = ("Bob", None, 100, 1)
DEE = ("Dee", Decimal("9.00000"), 20, 2)


def test_person_kpis(names, fact, rows):
    assert rows(person_kpis(names, fact)) == [
        ("nm1", *ANN[1:]),
        ("nm2", *BOB[1:]),
        ("nm3", None, None, 0),
        ("nm4", *DEE[1:]),
    ]


def test_types(names, fact):
    types = {f.name: f.dataType.simpleString() for f in principal_kpis(names, fact).schema}
    assert types == {
        "nconst": "string",
        "role": "string",
        "name": "string",
        "average_rating": "decimal(14,5)",
        "total_run_time_minutes": "bigint",
        "total_titles_as_principal": "bigint",
    }


def test_role_kpis_span_both_roles(names, fact, rows):
    assert rows(role_kpis(names, fact)) == [
        ("nm1", "actor", *ANN, 2),
        ("nm1", "actress", *ANN, 1),
        ("nm2", "actress", *BOB, 1),
        ("nm4", "actor", *DEE, 2),
    ]


@pytest.mark.parametrize("copies_per_row", [1, 2, 100_000])
def test_principal_kpis_has_a_row_per_credit(names, fact, copies_per_row):
    found = Counter(map(tuple, principal_kpis(names, fact, copies_per_row).collect()))
    assert found == {
        ("nm1", "actor", *ANN): 2,
        ("nm1", "actress", *ANN): 1,
        ("nm2", "actress", *BOB): 1,
        ("nm4", "actor", *DEE): 2,
    }


def test_principal_kpis_equals_join_back(spark, names, fact):
    names.createOrReplaceTempView("n")
    fact.createOrReplaceTempView("f")
    expected = spark.sql(
        """
        with j as (select * from n join f using (nconst) where role in ('actor', 'actress')),
        g as (select nconst, avg(rating) average_rating, sum(run_time_minutes) total, count(role) titles from j group by nconst)
        select nconst, role, name, cast(average_rating as decimal(14,5)), total, titles from j join g using (nconst)
        """
    )
    assert Counter(map(tuple, principal_kpis(names, fact).collect())) == Counter(map(tuple, expected.collect()))


def test_copies_of_one_person_are_spread(spark, names):
    credits = spark.range(8000).selectExpr("'nm1' nconst", "'actor' role", "1 run_time_minutes", "cast(1 as decimal(10,1)) rating")
    result = principal_kpis(names, credits, copies_per_row=10)
    assert result.count() == 8000
    sizes = [r["count"] for r in result.selectExpr("spark_partition_id() p").groupBy("p").count().collect()]
    assert max(sizes) < 2000


def test_top_people_of_one_role(names, fact):
    kpis = principal_kpis(names, fact)
    expected = [("nm4", "actor", *DEE), ("nm1", "actor", *ANN)]
    assert [tuple(r) for r in top_people(kpis, "actor").collect()] == expected
    assert [tuple(r) for r in top_people(role_kpis(names, fact), "Actor").collect()] == expected
    actresses = [tuple(r) for r in top_people(kpis, "ACTRESS").collect()]
    assert actresses == [("nm1", "actress", *ANN), ("nm2", "actress", *BOB)]  # the unrated come last


def test_top_people_of_both_roles(names, fact):
    found = [tuple(r) for r in top_people(principal_kpis(names, fact), "both").collect()]
    assert found == [("nm4", "actor", *DEE), ("nm1", "actor", *ANN), ("nm2", "actress", *BOB)]


def test_top_people_rejects_other_roles(names, fact):
    with pytest.raises(ValueError, match="director"):
        top_people(role_kpis(names, fact), "director")


def test_serving_kpis(names, fact, rows):
    assert len(rows(serving_kpis(principal_kpis(names, fact)))) == 4
