"""Replacement of stored tables in one step, upserts by file, and appended batches."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee.sources import paths, versions
from marquee.sources.files import scan_table
from marquee.sources.tables import append_table, compact_table, overwrite_table, replace_partition, upsert_table

SCHEMA = "k int, p string, v string"
OLD = [(1, "a", "old"), (2, "a", "old"), (3, "b", "old"), (4, None, "old")]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def table(spark, path):
    overwrite_table(spark.createDataFrame(OLD, SCHEMA), path, "p")
    return path


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


class Killed(BaseException):
    """The driver dies here."""


ACTIONS = {
    "overwrite": (lambda s, p: overwrite_table(frame(s, (9, "c", "new")), p, "p"), [(9, "c", "new")]),
    "replace": (lambda s, p: replace_partition(frame(s, (9, "a", "new")), p, "p", "a"), [(9, "a", "new"), *OLD[2:]]),
    "upsert": (lambda s, p: upsert_table(frame(s, (3, "a", "new")), p, ["k"], "p"), [*OLD[:2], (3, "a", "new"), OLD[3]]),
    "append": (lambda s, p: append_table(frame(s, (9, "c", "new")), p, "p"), [*OLD, (9, "c", "new")]),
}


@pytest.mark.parametrize("action", ACTIONS)
def test_a_driver_that_dies_at_any_step_leaves_old_or_new_rows(spark, table, rows, monkeypatch, action):
    """Killed before and after every step that touches the store; the next access has all old or all new rows."""
    act, new = ACTIONS[action]
    expect = [sorted(OLD, key=repr), sorted(new, key=repr)]
    seen = set()
    for step in range(40):
        left = [step]

        def counted(f):
            def run(*args):
                if left[0] == 0:
                    raise Killed
                left[0] -= 1
                return f(*args)

            return run

        with monkeypatch.context() as patch:
            for name in ("create_text", "delete_file", "delete"):
                patch.setattr(paths, name, counted(getattr(paths, name)))
            patch.setattr(versions, "written", counted(versions.written))
            try:
                act(spark, table)
                done = True
            except Killed:
                done = False
        found = rows(scan_table(spark, table, spark.createDataFrame([], SCHEMA).schema))
        assert found in expect
        seen.add(expect.index(found))
        overwrite_table(spark.createDataFrame(OLD, SCHEMA), table, "p")
        assert files(table) == set(versions.current(spark, table).files)  # nothing is left of the broken attempt
        if done:
            break
    assert done and seen == {0, 1}


def test_an_unfinished_version_does_not_count(spark, table, rows):
    version = versions.current(spark, table)
    for text in ("", json.dumps(version.schema.jsonValue()), json.dumps(version.schema.jsonValue()) + "\n[\"p=a/x.parq"):
        number = versions.current(spark, table).number + 1
        Path(table, f"_version-{number:010d}").write_text(text)
        assert rows(scan_table(spark, table, spark.createDataFrame([], SCHEMA).schema)) == sorted(OLD, key=repr)
        overwrite_table(spark.createDataFrame(OLD, SCHEMA), table, "p")
        assert rows(scan_table(spark, table)) == sorted(OLD, key=repr)


def test_of_two_replacements_of_one_version_the_second_is_refused(spark, table, rows):
    replaced = versions.stored(spark, table)
    overwrite_table(frame(spark, (7, "x", "first")), table, "p")
    with pytest.raises(RuntimeError, match="another run"):
        versions.publish(spark, table, replaced, replaced.schema, {})
    assert rows(scan_table(spark, table)) == [(7, "x", "first")]


def test_a_reader_keeps_its_version(spark, path, rows):
    before = spark.conf.get(versions.KEPT, "0")
    spark.conf.set(versions.KEPT, "1")
    try:
        overwrite_table(spark.range(3), path)
        reader = scan_table(spark, path)
        overwrite_table(spark.range(5), path)
        assert reader.count() == 3 and scan_table(spark, path).count() == 5
        overwrite_table(spark.range(7), path)  # now the first version goes
        kept = set(versions.current(spark, path).files)
        assert kept < files(path) and scan_table(spark, path).count() == 7
        assert len([p for p in Path(path).iterdir() if p.name.startswith("_version")]) == 2
    finally:
        spark.conf.set(versions.KEPT, before)
    overwrite_table(spark.range(1), path)
    assert files(path) == set(versions.current(spark, path).files)


def test_a_plain_folder_is_taken_over(spark, path, rows):
    frame(spark, *OLD).write.partitionBy("p").parquet(path)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert rows(scan_table(spark, path, schema)) == sorted(OLD, key=repr)
    append_table(frame(spark, (9, "c", "new")), path, "p")
    assert rows(scan_table(spark, path, schema)) == sorted([*OLD, (9, "c", "new")], key=repr)
    assert versions.current(spark, path).number == 1


def test_an_upsert_rewrites_only_files_with_matched_keys(spark, path, rows):
    overwrite_table(spark.range(0, 1000, 1, 10).select(F.col("id").alias("k"), F.lit("old").alias("v")), path)
    before = files(path)
    assert len(before) == 10
    new = spark.createDataFrame([(5, "new"), (250, "new"), (2000, "new")], "k long, v string")
    read = []
    original = versions.read

    def spy(spark, path, version, schema=None, files=None):
        read.append(files)
        return original(spark, path, version, schema, files)

    versions.read = spy
    try:
        upsert_table(new, path, ["k"])
    finally:
        versions.read = original
    assert len(before - files(path)) == 2 and len(before & files(path)) == 8
    assert [len(some) for some in read if some is not None] == [2]  # in full
    got = dict(rows(scan_table(spark, path)))
    assert len(got) == 1001 and {k for k, v in got.items() if v == "new"} == {5, 250, 2000}


def test_the_search_for_files_reads_keys_alone(spark, path):
    overwrite_table(spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit("y").alias("w")), path)
    version = versions.current(spark, path)
    located = versions.read(spark, path, version).select("k", F.col("_metadata.file_path"))
    assert "ReadSchema: struct<k:bigint>" in located._jdf.queryExecution().executedPlan().toString()


def test_files_under_odd_names(spark, path, rows):
    df = spark.createDataFrame([(1, "a b%c/d=e", "old"), (2, "é {x}[y]*?", "old"), (3, "", "old")], SCHEMA)
    overwrite_table(df, path, "p")
    upsert_table(frame(spark, (1, "a b%c/d=e", "new"), (2, "z", "new")), path, ["k"], "p")
    assert rows(scan_table(spark, path, df.schema)) == sorted([(1, "a b%c/d=e", "new"), (2, "z", "new"), (3, None, "old")], key=repr)


def test_a_repeated_batch_replaces_itself(spark, path, rows):
    for batch, value in (("one", "x"), ("two", "y"), ("one", "z"), ("", "n"), ("", "n")):
        append_table(frame(spark, (1, "a", value)), path, "p", batch)
    assert rows(scan_table(spark, path)) == [(1, "a", "n"), (1, "a", "n"), (1, "a", "y"), (1, "a", "z")]
    assert compact_table(spark, path, "p", 3) and not compact_table(spark, path, "p", 3)
    assert len(files(path)) == 1
    assert rows(scan_table(spark, path)) == [(1, "a", "n"), (1, "a", "n"), (1, "a", "y"), (1, "a", "z")]


def test_a_table_without_rows(spark, path, rows):
    overwrite_table(frame(spark), path, "p")
    assert rows(scan_table(spark, path)) == [] and scan_table(spark, path).columns == ["k", "p", "v"]
    replace_partition(frame(spark), path, "p", "a")
    upsert_table(frame(spark, (1, "a", "x")), path, ["k"], "p")
    assert rows(scan_table(spark, path)) == [(1, "a", "x")]
