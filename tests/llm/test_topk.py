import numpy as np
import pytest

from marquee.llm.topk import Tree, search, Best, top_k


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, data string, block long")


def brute(rows, asked, k, scale=64.0):
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    ints = lambda v: [int(np.floor(scale * float(np.float32(x)))) for x in v]
    found = {}
    for q, v in {r[0]: r[1] for r in rows if r[0] in asked and usable(r[1])}.items():
        best = {}
        for r in rows:
            if r[0] is not None and r[0] != q and usable(r[1]) and len(r[1]) == len(v):
                best[r[0]] = max(best.get(r[0], -(2**70)), sum(a * b for a, b in zip(ints(v), ints(r[1]))))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            found[q, rank] = (i, s)
    return found


@pytest.mark.parametrize("shard_rows,block_rows", [(7, 3), (200, 50)])
def test_against_brute_force(spark, shard_rows, block_rows):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=5)], None, None) for i in range(150)]
    rows += [(i, rows[3][1], None, None) for i in range(150, 220)]  # many copies: ties
    rows += [(300, None, None, None), (320, [1.0, None, 0.0, 0.0, 0.0], None, None), (340, [float("nan")] * 5, None, None), (360, [1.0, 2.0], None, None), (None, [1.0] * 5, None, None), (380, [], None, None)]
    df = frame(spark, rows)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k(df, df.where("vec_id % 20 = 0"), k=6, shard_rows=shard_rows, block_rows=block_rows).collect()}
    assert got == brute(rows, set(range(0, 400, 20)), 6)


def test_repeated_ids_count_once(spark):
    df = frame(spark, [(0, [1.0], None, None), (1, [1.0], None, None), (1, [2.0], None, None), (1, [2.0], None, None), (2, [1.5], None, None)])
    got = [(r["rank"], r.vec_id, r.score) for r in top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 64 * 128), (2, 2, 64 * 96)]


def test_unusable_rows_of_a_usable_id_hide_nothing(spark):
    nan = float("nan")
    for bad in ([nan, 1.0], [None, 9.0], [1e30, 0.0], None, [3.0]):
        df = frame(spark, [(20, [1.0, 2.0], None, None), (20, bad, None, None), (1, [1.0, 1.0], None, None)])
        assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, df.where("vec_id = 20")).collect()] == [(20, 1, 1, 64 * 64 * 3)]


def test_scores_beyond_64_bits_end_nothing(spark):
    df = frame(spark, [(0, [2.0**50], None, None), (1, [2.0**50], None, None), (2, [-(2.0**50)], None, None)])
    assert [(r.vec_id, r.score) for r in top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()] == [(1, 2**63 - 1), (2, 1 - 2**63)]


def test_empty(spark):
    df = frame(spark, [])
    assert top_k(df, df).collect() == []


def test_large_components_are_exact(spark):
    df = frame(spark, [(0, [2.0**30, 1.0], None, None), (1, [2.0**20, 0.5], None, None), (2, [2.0**20, 0.25], None, None)])
    got = [(r.vec_id, r.score) for r in top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 2**36 * 2**26 + 64 * 32), (2, 2**36 * 2**26 + 64 * 16)]


def test_boxes_save_leaves():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-50, 50, (4096, 3))
    tree = Tree.build(np.arange(4096), vectors)
    assert Tree.unpacked(tree.packed()).vectors.tolist() == tree.vectors.tolist()
    best = [Best(5)]
    assert search(tree, np.array([-1]), np.array([[10, -3, 2]]), best) < 16  # of 64 leaves
    assert best[0].scores.tolist() == sorted((vectors @ [10, -3, 2]).tolist(), reverse=True)[:5]


def test_queries_read_a_leaf_together(monkeypatch):
    """Lists are offered what may change them, once for some leaves: far less often than leaves are read."""
    rng = np.random.default_rng(4)
    vectors = rng.integers(-50, 50, (2048, 40))
    tree, asked, offers = Tree.build(np.arange(2048), vectors), vectors[::20], []
    monkeypatch.setattr(Best, "offer", lambda self, s, i, offer=Best.offer: (offers.append(1), offer(self, s, i)))
    best = [Best(5) for _ in asked]
    read = search(tree, np.arange(0, 2048, 20), asked, best)
    assert 2.5 * len(offers) < read
    for i, query in enumerate(asked):
        scores = vectors @ query
        scores[20 * i] = -(10**9)
        assert best[i].ids.tolist() == sorted(range(2048), key=lambda r: (-scores[r], r))[:5]
