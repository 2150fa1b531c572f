"""The batch queries write the raw text of their tables side by side."""

from threading import Barrier

import pytest

import __spark_entry__ as entry
from marquee.specs import TABLES


@pytest.mark.parametrize("query", [entry._full_run, entry._resumed_run])
def test_all_raw_tables_are_under_way_at_once(spark, monkeypatch, query):
    together, written = Barrier(len(TABLES), timeout=30), []

    def write(df, path):
        together.wait()
        written.append((path.rsplit("/", 1)[-1].split(".")[0], tuple(df.columns)))

    class Nothing:
        def __init__(self, *args, **kwargs): ...

        def run(self): ...

    monkeypatch.setattr(entry, "_write_raw", write)
    monkeypatch.setattr(entry, "_BrokenOff", Nothing)
    monkeypatch.setattr(entry, "run_batch", Nothing)
    monkeypatch.setattr(entry, "scan_table", Nothing)
    query(spark, "/root/testdata/sf0.001")
    assert dict(written) == {name: tuple(entry.view(spark, "/root/testdata/sf0.001", name).columns) for name in TABLES}


def test_a_table_that_cannot_be_written_fails_the_query(spark, monkeypatch):
    def write(df, path):
        if "title_crew" in path:
            raise OSError("full")

    monkeypatch.setattr(entry, "_write_raw", write)
    with pytest.raises(OSError, match="full"):
        entry._full_run(spark, "/root/testdata/sf0.001")
