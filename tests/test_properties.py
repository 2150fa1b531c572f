"""Operators against plain Python on random small tables."""

import tempfile
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators.landing import one_per_key, upsert
from marquee.operators.skew import balanced_left_join
from marquee.sources.files import scan_table
from marquee.sources.tables import overwrite_table, upsert_table

SCHEMA = "k int, p string, v int"
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(1, 6))
parts = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
row_lists = st.lists(st.tuples(keys, parts, st.integers(0, 3)), max_size=12)


def bag(frame):
    return Counter(map(tuple, frame.collect()))


def replaced(target, source):
    """Rows of all keys in the source are replaced by the source rows; NULL matches nothing."""
    new_keys = {row[0] for row in source} - {None}
    return [row for row in target if row[0] not in new_keys] + list(source)


@few
@given(target=row_lists, source=row_lists)
def test_upsert(spark, target, source):
    old, new = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    assert bag(upsert(old, new, ["k"], "all")) == Counter(replaced(target, source))


@few
@given(rows=row_lists)
def test_one_per_key(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    best = {}
    for k, p, v in rows:
        if k is not None:
            best[k] = max(best.get(k, (-1, "")), (v, p or ""))
    expected = Counter((k, p or None, v) for k, (v, p) in best.items())
    expected.update(row for row in rows if row[0] is None)
    assert bag(one_per_key(frame, ["k"], ["v"])) == expected


@few
@given(first=row_lists, batches=st.lists(row_lists, min_size=1, max_size=2))
def test_stored_table_follows_its_batches(spark, first, batches):
    path = f"{tempfile.mkdtemp(prefix='run-')}/table"
    frame = spark.createDataFrame(first, SCHEMA)
    overwrite_table(frame, path, "p")
    expected = first
    for batch in batches:
        upsert_table(spark.createDataFrame(batch, SCHEMA), path, ["k"], "p", on_duplicate="all")
        expected = replaced(expected, batch)
        assert bag(scan_table(spark, path, frame.schema)) == Counter(expected)


@few
@given(left=row_lists, right=row_lists, rows_per_share=st.integers(1, 4))
def test_balanced_join(spark, left, right, rows_per_share):
    lefts = [spark.createDataFrame([(r[0], r[2]) for r in left], "k int, a int")]
    frame = spark.createDataFrame([(r[0], r[2]) for r in right], "k int, b int")
    expected = Counter()
    for k, _, a in left:
        matches = [b for other, _, b in right if k is not None and other == k]
        expected.update((k, a, b) for b in matches or [None])
    assert bag(balanced_left_join(lefts, frame, "k", rows_per_share)) == expected
