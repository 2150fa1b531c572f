import numpy as np
import pytest

from marquee.llm.whitening import Rows, bidiagonal, blocks_of, whitened

CLASHING = "x int, n int, component string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", "b") for r in rows], f"vec_id long, embedding array<double>, {CLASHING}")


def by_hand(rows, components=4, scale=256):
    """Eigenvalues, components' coordinates up to sign, and deviations by row."""
    usable = [(i, [int(np.floor(scale * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in usable}), float)
    mean = fit.mean(0)
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    order = np.argsort(-values)[:components]
    order = [o for o in order if values[o] > 1e-9 * max(1e-300, values.max())]
    coordinates = (np.array([v for _, v in usable]) - mean) @ vectors[:, order] / np.sqrt(values[order])
    total = [sum(int(v[d]) for v in {tuple(v) for _, v in usable}) for d in range(fit.shape[1])]
    deviations = [sum((len(fit) * a - s) ** 2 for a, s in zip(v, total)) for _, v in usable]
    return len(fit), values[order] / values.sum(), [i for i, _ in usable], coordinates, deviations


def compare(found, rows, components=4):
    n, explained, ids, coordinates, deviations = by_hand(rows, components)
    got = found.collect()
    assert len(got) == len(ids) * len(explained)
    key = lambda r: (repr(r[0]), round(r[1], 6), r[2])
    for c in range(len(explained)):
        own = [r for r in got if r["component"] == c + 1]
        assert {r["n"] for r in own} == {n}
        assert all(abs(r["explained"] / explained[c] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in own)
        here = sorted(((r["vec_id"], abs(r["whitened"]), r["deviation"]) for r in own), key=key)
        there = sorted(((i, abs(w), d) for i, w, d in zip(ids, coordinates[:, c], deviations)), key=key)
        assert [(h[0], h[2]) for h in here] == [(t[0], t[2]) for t in there]
        np.testing.assert_allclose([h[1] for h in here], [t[1] for t in there], atol=1e-8)
        signs = {i: w for i, w in zip(ids, coordinates[:, c])}
        if len(signs) == len(ids):  # one sign for all rows
            same = [np.sign(r["whitened"] * signs[r["vec_id"]]) for r in own if abs(r["whitened"]) > 1e-6]
            assert len(set(same)) == 1


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, d)) * np.linspace(2, 0.5, d))]


@pytest.mark.parametrize("n,d", [(50, 7), (5, 20), (200, 3), (40, 1)])
def test_against_eigenvectors(spark, n, d):
    rows = vectors(n, d)
    compare(whitened(frame(spark, rows)), rows)


def test_odd_rows_copies_and_clashing_names(spark):
    rows = vectors(30, 5) + [(100, None), (101, [None] * 5), (102, [1.0, 2.0, None, 4.0, 5.0]), (103, [1.0, float("nan"), 0.0, 0.0, 0.0]), (104, [float("inf")] * 5), (None, [0.5] * 5), (105, [-0.0] * 5)]
    hot = [(200 + i % 3, [0.25, -0.5, 1.0, 0.0, 2.0]) for i in range(20)]
    compare(whitened(frame(spark, rows + hot)), rows + hot)


def test_other_lengths_and_huge_entries_have_no_result(spark):
    rows = vectors(30, 5)
    odd = [(900, []), (901, [1.0, 2.0]), (902, [1e30, 0.0, 0.0, 0.0, 0.0])]
    compare(whitened(frame(spark, rows + odd)), rows)


def test_a_deviation_beyond_64_bits_is_null(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [-(2.0**40), 3.0])]
    got = whitened(frame(spark, rows)).collect()
    by_id = {r["vec_id"]: r["deviation"] for r in got}
    assert by_id[1] is None and by_id[2] == (3 * 256 - 4 * 256) ** 2


def test_without_variance_nothing(spark):
    assert whitened(frame(spark, [])).collect() == []
    assert whitened(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitened(frame(spark, [(1, None), (2, [])])).collect() == []


def test_far_from_zero(spark):
    rows = [(i, (np.array(v) + 1e6).tolist()) for i, v in vectors(60, 4, seed=3)]
    got = whitened(frame(spark, rows)).collect()
    assert max(r["identity_error"] for r in got) < 1e-9


def fit_list(spark, x):
    packed = spark.createDataFrame([(v.astype("<i8").tobytes(),) for v in x], "x binary")
    return Rows.of(blocks_of(packed), x.shape[1])


def test_equal_eigenvalues_are_all_found(spark):
    x = np.concatenate([8 * np.eye(6, dtype=int), -8 * np.eye(6, dtype=int)])
    found = bidiagonal(fit_list(spark, x), 4)
    np.testing.assert_allclose(found.values, np.full(4, 64 * 2 / 12))
    np.testing.assert_allclose(found.vectors.T @ found.vectors, np.eye(4), atol=1e-10)


def test_it_ends_early_in_many_dimensions(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.standard_normal((80, 40)) * np.array([300, 200, 120, 80, *[3] * 36])).astype(int)
    rows, passes = fit_list(spark, x), []
    summed = Rows.summed
    Rows.summed = lambda self, f: passes.append(1) or summed(self, f)
    try:
        found = bidiagonal(rows, 4, all_steps=8)
    finally:
        Rows.summed = summed
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:4]
    np.testing.assert_allclose(found.values, values, rtol=1e-9)
    assert len(passes) < 40
