import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marquee.llm import lexical
from marquee.llm.lexical import answer, best_of, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    counted = [(i, c) for i, c in counted if c]
    n, tokens = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    queries: dict = {}
    for item, text in items:
        if item is not None:
            queries.setdefault(item, Counter()).update(terms(text))
    rows = []
    for item, query in queries.items():
        scored = []
        for doc, have in counted:
            m = 25 + (75 * sum(have.values()) * n) // tokens
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * have[t]) // (1000 * have[t] + 8 * m)) for t, r in query.items() if t in have)
            if score > 0:
                scored.append((-score, doc))
        rows += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def found(docs, items, **options):
    return sorted(tuple(r) for r in ranked_search(docs, items, **options).collect())


def make_items(spark, pairs):
    return spark.createDataFrame([(*p, 1, 2) for p in pairs], "item_id long, text string, score long, rank long")


def test_odd_rows_repeats_and_clashing_names(spark, documents, odd):
    items = [(1, "the same ID once"), (2, None), (3, ""), (4, "The THE word x 漢😀 é"), (None, "the"), (5, "once"), (5, "more more"), (6, "!!! ?")]
    got = found(documents(odd), make_items(spark, items))
    assert got == by_hand(odd, items)
    assert [r[2] for r in got if r[0] == 5] == [6, 7]


def test_one_word_in_a_third_of_all_rows_and_ties(spark, documents):
    rng = random.Random(3)
    rows = [(i, "the same copy") for i in range(0, 600, 2)]
    rows += [(i, " ".join(rng.choice("the same rare odd alpha beta gamma delta".split()) for _ in range(rng.randint(1, 30)))) for i in range(1, 1200, 2)]
    rng.shuffle(rows)
    items = [(1, "the same copy"), (2, "rare odd alpha"), (3, "copy copy delta"), (4, "absent")]
    assert found(documents(rows, plain=True).repartition(7), make_items(spark, items)) == by_hand(rows, items)


@pytest.mark.parametrize("postings", [40, 3000])
def test_small_shards_give_the_same(spark, sample, monkeypatch, postings):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    docs, items = sample("documents"), sample("benchmark")
    expected = by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], k=3)
    assert found(docs, items, k=3) == expected


def test_portions_of_items_give_the_same(spark, sample, monkeypatch):
    docs, items = sample("documents"), sample("benchmark")
    whole = found(docs, items)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 2000)
    assert found(docs, items) == whole


def test_empty_tables(spark, documents):
    nothing, some = documents([]), make_items(spark, [(1, "a")])
    assert found(nothing, some) == []
    assert found(documents([(1, "a")]), make_items(spark, [])) == []
    assert found(documents([(1, None)]), some) == []


def test_accumulators_are_limited_and_scores_stay_exact():
    rng = np.random.default_rng(5)
    n, k = 2000, 10
    rare = rng.choice(n, 60, replace=False)
    query = [(np.sort(rare), np.full(60, 5000) + np.arange(60), 5059), (np.arange(n), rng.integers(1, 50, n), 49), (np.arange(0, n, 2), rng.integers(1, 30, n // 2), 29)]
    docs, scores, made = answer(query, n, k, -1)
    assert made == 60  # the frequent terms made none
    full = np.zeros(n, np.int64)
    for owner, added, _ in query:
        full[owner] += added
    expected = best_of(np.arange(n), full, k)
    assert [a.tolist() for a in best_of(docs, scores, k)] == [a.tolist() for a in expected]


def test_a_bound_that_ties_with_the_kth_score_does_not_end_it():
    query = [(np.array([5]), np.array([7]), 7), (np.array([1]), np.array([7]), 7)]
    docs, scores, _ = answer(query, 6, 1, -1)
    assert best_of(docs, scores, 1)[0].tolist() == [1]
