import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import substrings
from marquee.llm.substrings import UPPER_DEPTH, WINDOW_DEPTH, Tree, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def by_hand(texts, window):
    """(words, removed, kept text) of every text."""
    split = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(frame, rows, window, **options):
    got = without_repeats(frame, window=window, **options).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr) == sorted(
        ((i, *r) for (i, _), r in zip(rows, by_hand([t for _, t in rows], window))), key=repr
    )
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["repeats"]) == r["n_removed"]
    return got


def passages(rng, n, words=8):
    vocabulary = [f"w{i}" for i in range(words)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_odd_rows(documents, odd):
    check(documents(odd), odd, 35)
    check(documents(odd), odd, 1)


def test_case_and_separators_count(documents):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text.upper()), (3, text.replace(" ", "\t\n")), (4, text.replace(" ", " ")), (5, text.replace(" ", "\x1c")), (6, text.replace("w0", "w\x00")), (7, text.replace("w0", "w\x01"))]
    got = {r["doc_id"]: r["n_removed"] for r in check(documents(rows), rows, 35)}
    assert got == {1: 40, 2: 0, 3: 40, 4: 0, 5: 0, 6: 39, 7: 39}


@pytest.mark.parametrize("window", [2, 5, 13, 35])
def test_random_texts_in_small_groups(documents, window):
    """Few words, so that every prefix is frequent and groups go down to whole windows."""
    rng = random.Random(window)
    rows = list(enumerate(passages(rng, 80, words=2 if window < 13 else 3)))
    shared = " ".join(f"s{i}" for i in range(50))
    rows += [(1000 + i, f"{passages(rng, 1)[0]} {shared} {passages(rng, 1)[0]}") for i in range(40)]
    check(documents(rows).repartition(5), rows, window, group_suffixes=40)


def test_a_third_of_all_rows_equal(documents, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH_WORDS", 300)
    rng = random.Random(1)
    hot = " ".join(rng.choice("abcdefgh") for _ in range(70))
    rows = [(i, hot) for i in range(100)] + [(100 + i, t) for i, t in enumerate(passages(rng, 200))]
    rng.shuffle(rows)
    plans = []
    planned = substrings.planned
    monkeypatch.setattr(substrings, "planned", lambda *a: plans.append(planned(*a)) or plans[-1])
    check(documents(rows, plain=True).repartition(6), rows, 35, group_suffixes=60)
    assert len(plans[0].everywhere)  # its windows are too frequent for a group and never shuffled


def test_tables_of_the_driver(sample):
    docs = sample("documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = check(docs, rows, 35, group_suffixes=5000)
    assert sum(r["n_removed"] for r in got) > 0


def test_empty_table(documents):
    assert without_repeats(documents([])).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40))
def test_leaves_below_nodes(values):
    paths = np.array([v << 48 | v % 2 for v in values], np.uint64)
    count = Counter(paths.tolist())
    tree = Tree.of(paths)
    assert tree.leaves_below(WINDOW_DEPTH).tolist() == [count[p] > 1 for p in paths.tolist()]
    assert tree.leaves_below(UPPER_DEPTH).tolist() == [count[p] > 1 for p in paths.tolist()]
    assert len(tree.nodes(WINDOW_DEPTH)) == sum(n > 1 for n in count.values())
