"""Raw headers that are not as expected, and values that casts lose."""

from datetime import date

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from marquee.operators.landing import cast_losses
from marquee.plans.daily import read_landed
from marquee.sources.files import Drift, drift, reconciled_schema, scan_table, scan_tsv_reconciled
from marquee.specs import NAME_BASICS, TITLE_BASICS
from test_daily import D1, D2, RAW, lake, write_raw  # noqa: F401

SCHEMA = StructType([StructField("k", StringType()), StructField("n", IntegerType()), StructField("s", StringType())])


def text(names):
    return StructType([StructField(name, StringType()) for name in names.split()])


@pytest.mark.parametrize(
    "header, expected",
    [
        ("k n s", Drift((), (), False)),
        ("K N S", Drift((), (), False)),
        ("s k n", Drift((), (), True)),
        ("k x n s", Drift((), ("x",), False)),
        ("s k", Drift(("n",), (), True)),
        ("n y k", Drift(("s",), ("y",), True)),
        ("x y", Drift(("k", "n", "s"), ("x", "y"), False)),
    ],
)
def test_drift(header, expected):
    assert drift(text(header), SCHEMA) == expected


def test_reconciled_schema():
    read = reconciled_schema(text("x N k"), SCHEMA, ["k"])
    assert [(f.name, f.dataType) for f in read] == [("x", StringType()), ("N", IntegerType()), ("k", StringType())]
    assert reconciled_schema(StructType([]), SCHEMA, ["k"]) == SCHEMA
    with pytest.raises(ValueError, match="lacks k, n"):
        reconciled_schema(text("s"), SCHEMA, ["k", "n"])
    with pytest.raises(ValueError, match="_bad_line"):
        reconciled_schema(text("k n s _bad_line"), SCHEMA)


def test_scan(spark, tmp_path, rows):
    path = tmp_path / "raw.tsv"
    path.write_text("extra.a\tn\tk\nx\t1\ta\n\\N\t\\N\tb\n")
    frame, change = scan_tsv_reconciled(spark, str(path), SCHEMA, ["k"])
    assert change == Drift(("s",), ("extra.a",), True)
    assert frame.schema == SCHEMA
    assert rows(frame) == [("a", 1, None), ("b", None, None)]


def test_scan_of_an_empty_file(spark, tmp_path):
    (tmp_path / "raw.tsv").write_text("")
    frame, change = scan_tsv_reconciled(spark, str(tmp_path / "raw.tsv"), SCHEMA, ["k"])
    assert (frame.schema, frame.count(), change) == (SCHEMA, 0, Drift((), (), False))


def test_part_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("k\tn\ts\na\t1\tx\n")
    (tmp_path / "b.tsv").write_text("n\tk\ts\n1\tb\tx\n")
    frame, _ = scan_tsv_reconciled(spark, str(tmp_path), SCHEMA, ["k"])
    with pytest.raises(Exception, match="CSV header"):
        frame.collect()


def notes(spark, root, name):
    return sorted((tuple(r) for r in scan_table(spark, f"{root}/landing_notes/{name}").collect()), key=repr)


def test_batch_lands_a_drifted_header(spark, lake, rows):  # noqa: F811
    root, store, run = lake
    titles = [
        "genres note tconst startYear titleType primaryTitle originalTitle isAdult endYear",
        "Drama x tt1 2000 movie A A 0 \\N",
        "\\N y tt2 2001 movie B B 0 \\N",
    ]
    write_raw(root, title_basics=titles)
    run(D1)
    assert rows(read_landed(spark, root, TITLE_BASICS).select("tconst", "startYear", "runtimeMinutes", "genres")) == [
        ("tt1", 2000, None, "Drama"),
        ("tt2", 2001, None, None),
    ]
    expected = [(D1, "title_basics", "left out", "note", None), (D1, "title_basics", "missing", "runtimeMinutes", None), (D1, "title_basics", "other order", None, None)]
    assert notes(spark, root, "title_basics") == expected
    # A later file as expected has nothing to note; a text table is compared with what is stored.
    write_raw(root, title_akas=["title ordering titleId more", "Z 1 tt1 m"])
    run(D2)
    assert notes(spark, root, "title_basics") == expected
    assert rows(scan_table(spark, f"{root}/landing_zone/title_akas").drop("today_date")) == [("tt1", 1, "Z"), ("tt1", 2, "B")]
    assert notes(spark, root, "title_akas") == [(D2, "title_akas", "left out", "more", None), (D2, "title_akas", "other order", None, None)]


def test_missing_key_fails_the_stage(spark, lake):  # noqa: F811
    root, store, run = lake
    write_raw(root, title_crew=["title directors", "tt1 nm3"])
    with pytest.raises(ValueError, match="lacks tconst"):
        run(D1)


def test_bad_lines_of_a_drifted_file(spark, lake, rows):  # noqa: F811
    root, store, run = lake
    people = [f"\\N nm{i} P 1970 \\N actor" for i in range(300)]
    header = "knownForTitles nconst primaryName birthYear deathYear primaryProfession"
    write_raw(root, name_basics=[header, *people, "\\N nm900 P soon \\N actor", "short"])
    run(D1)
    assert read_landed(spark, root, NAME_BASICS).count() == 300
    assert [r.line.split("\t")[0] for r in scan_table(spark, f"{root}/rejected/name_basics").orderBy("line").collect()] == ["\\N", "short"]


def test_a_column_of_junk_fails_its_stage(spark, lake):  # noqa: F811
    root, store, run = lake
    write_raw(root, title_akas=[RAW["title_akas"][0], "tt1 one A", "tt1 two B", "tt2 3 C"])
    with pytest.raises(ValueError, match="2 of 3 values of ordering in title_akas are no int"):
        run(D1)
    assert notes(spark, root, "title_akas") == [(D1, "title_akas", "lost in cast", "ordering", 2)]
    write_raw(root)
    run(D1)  # a repeated attempt takes the note back
    assert notes(spark, root, "title_akas") == []


def test_few_lost_values_are_noted(spark, lake):  # noqa: F811
    root, store, run = lake
    write_raw(root, title_akas=[RAW["title_akas"][0], *[f"tt{i} 1 A" for i in range(300)], "tt1 x B", "tt2 \\N C"])
    run(D1)
    assert notes(spark, root, "title_akas") == [(D1, "title_akas", "lost in cast", "ordering", 1)]
    assert scan_table(spark, f"{root}/landing_zone/title_akas").count() == 302


def test_cast_losses(spark, rows):
    df = spark.createDataFrame([("1", "a"), ("x", None), ("\\N", "3"), (None, "4")], "`a b` string, c string")
    casts = {"c": IntegerType(), "a b": IntegerType()}
    assert rows(cast_losses(df.withColumnRenamed("a b", "a"), {"a": IntegerType(), "c": IntegerType()})) == [("a", 2, 1), ("c", 3, 1)]
    assert rows(cast_losses(df.limit(0), {"c": casts["c"]})) == [("c", 0, 0)]
    assert date(2024, 1, 30) == D1
