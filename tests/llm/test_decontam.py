import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm.decontam import align, contaminated, without_contaminated


@pytest.fixture
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def texts(seed, n, words=40):
    rng = random.Random(seed)
    return [" ".join(rng.choices([f"v{i}" for i in range(3000)], k=words)) for _ in range(n)]


def test_copies_and_edits_are_found_and_clean_ones_left(documents, benchmark):
    items, clean = texts(1, 8, 30), texts(2, 30, 200)
    rows = [(i, text) for i, text in enumerate(clean)]
    rows.append((100, f"{clean[0]} {items[0]} {clean[1]}"))
    words = items[1].split()
    words[5], words[14], words[23] = "x", "y", "z"
    rows.append((101, f"{clean[2]} {' '.join(words)}"))
    words = items[2].split()
    rows.append((102, f"{' '.join(words[:14])} in between {' '.join(words[14:])} {clean[3]}"))
    rows.append((103, items[3].upper().replace(" ", ", ")))
    rows.append((104, f"{clean[4]} {items[4][:40]}"))  # a few words are no copy
    got = {(r.doc_id, r.item_id): r for r in contaminated(documents(rows), benchmark(list(enumerate(items)))).collect()}
    assert set(got) == {(100, 0), (101, 1), (102, 2), (103, 3)}
    assert got[100, 0].score == 1.0 and (got[100, 0].start, got[100, 0].end) == (200, 230)
    assert 0.7 < got[101, 1].score < 1.0


def test_planted_in_a_third_of_the_rows(documents, benchmark):
    items, clean = texts(3, 2, 25), texts(4, 90, 60)
    rows = [(i, f"{text} {items[0]}" if i % 3 == 0 else text) for i, text in enumerate(clean)]
    got = contaminated(documents(rows), benchmark([(7, items[0]), (8, items[1])]))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, 7) for i in range(0, 90, 3)]
    left = without_contaminated(documents(rows), benchmark([(7, items[0])]))
    assert left.columns == documents([]).columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(90) if i % 3]


def test_a_long_part_of_a_longer_item(documents, benchmark):
    item, other, clean = *texts(6, 2, 250), texts(7, 1, 300)[0]
    common = " ".join(f"w{k}" for k in "0001002003011")  # every seed of these words is frequent
    part = item.split()[90:190]
    rows = [(1, f"{clean} {' '.join(part)} {clean}"), (2, f"{clean} {' '.join(part[:10])}"), (3, f"{clean} {common}")]
    rows += [(k, " ".join(random.Random(k).choices(["w0", "w1", "w2", "w3"], k=400))) for k in range(11, 14)]
    got = {r.doc_id: r for r in contaminated(documents(rows), benchmark([(1, item), (2, f"{other} {common}")])).where("doc_id < 10").collect()}
    assert set(got) == {1, 3}
    assert (got[1].item_id, got[1].score, got[1].start, got[1].end) == (1, 0.4, 300, 400)


def test_capitals_of_any_language(documents, benchmark):
    letters = "éèóñçöêüäßíδς"
    items = [" ".join(f"{letters[(i + k) % 13]}a{letters[k % 13]}{'bcdfghjklm'[k // 3]}" for k in range(30)) for i in range(3)]
    rows = [(1, items[0].upper()), (2, items[1].title()), (3, items[2])]
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(documents(rows), benchmark(list(enumerate(items))), score_least=0.9).collect()}
    assert got == {(1, 0): 1.0, (2, 1): 1.0, (3, 2): 1.0}


def test_bytes_that_are_no_text(spark, documents, benchmark):
    docs = documents([(1, "")]).withColumn("text", F.expr("cast(concat(x'FFC3', cast(' É B C D E ' as binary), x'E9') as string)"))
    assert [(r.doc_id, r.score) for r in contaminated(docs, benchmark([(1, "é b c d e")])).collect()] == [(1, 1.0)]


def test_odd_rows(documents, benchmark, odd):
    item = "the same id once more"
    got = contaminated(documents([*odd, (None, item)]), benchmark([(1, item), (1, item), (2, None), (3, ""), (4, "one"), (None, "x y z w")]))
    assert sorted(((r.doc_id is None, r.doc_id, r.item_id) for r in got.collect()), key=repr) == [(False, 6, 1), (False, 7, 1), (True, None, 1)]


def test_empty(documents, benchmark):
    assert contaminated(documents([]), benchmark([(1, "a b c d e")])).collect() == []
    assert contaminated(documents([(1, "a b c d e")]), benchmark([])).collect() == []


def test_alignment_against_the_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(0, 12)).astype(np.uint64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
        assert align(a, b)[0] == table.max()
