import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import quality
from marquee.llm.quality import feature_rows, features_in, fit_pairs, good_documents, quality_scores, train_quality
from marquee.llm.toxicity import Rows, fit_chain, hashed, predict_chain, toxicity_scores, train_toxicity

part = lambda i, n: zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r.doc_id: r for r in quality_scores(docs, labels).collect()}


def test_quality_on_held_out_rows(scored):
    docs, labels, got = scored
    assert len(got) == docs.count() and all(r.held_out == (part(i, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in labels.collect() if part(r.doc_id, 3) == 1}
    assert np.mean([got[i].predicted == q for i, q in truth.items()]) > 0.98


def test_quality_does_not_learn_held_out_labels(spark, documents):
    texts = [(i, "plain words in a row here" if i % 2 else "###### !!! $$$ %%%") for i in range(60)]
    labels = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and part(i, 3) == 1)) for i in range(60)], "doc_id long, quality int")
    a, b = ({r.doc_id: r.score for r in quality_scores(documents(texts), labels(f)).collect()} for f in (False, True))
    assert a == b and a[1] > a[0]


def test_quality_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame([(3, 1), (4, 0), (3, None), (None, 1), (4, 0)], "doc_id long, quality int")
    assert len(quality_scores(documents(odd), labels).collect()) == len(odd)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(documents(odd), none).collect()} == {0.5}
    assert quality_scores(documents([]), none).collect() == []
    assert good_documents(documents(odd), none).count() == len(odd)


def test_pairs_put_good_rows_above_bad_ones():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (200, 4)), rng.normal(-1, 1, (100, 4))
    ranking = fit_pairs(good, bad)
    assert ranking.scores(good).mean() > 0.9 > 0.1 > ranking.scores(bad).mean()
    assert np.mean(np.concatenate([ranking.scores(good), ranking.scores(bad)]) >= 0.5) == pytest.approx(2 / 3, abs=0.01)


def test_toxicity_on_held_out_rows(spark, sample):
    docs, labels = sample("documents", "sf0.1"), sample("labels", "sf0.1")
    known = [r for r in labels.collect()]
    train = spark.createDataFrame([(r.doc_id, r.toxic) for r in known if part(r.doc_id, 3) != 1], "doc_id long, toxic int")
    got = {r.doc_id: r.p_toxic >= 0.5 for r in toxicity_scores(docs, train_toxicity(docs, train, ["toxic"]), ["toxic"]).collect()}
    held = [r for r in known if part(r.doc_id, 3) == 1]
    assert np.mean([got[r.doc_id] for r in held if r.toxic]) > 0.75
    assert np.mean([got[r.doc_id] for r in held if not r.toxic]) < 0.01


def test_later_models_use_earlier_chances():
    rng = np.random.default_rng(3)
    first = rng.integers(0, 2, 400)
    rows = Rows.of([np.array([10 + f, 100 + k % 7], "<u4") for k, f in enumerate(first)])
    labels = np.stack([first, first], 1).astype(float)
    chain = fit_chain(rows, labels, np.arange(400) % 3)
    assert chain[1].earlier[0] > 0
    assert ((predict_chain(chain, rows)[1] > 0.5) == first).all()


def test_toxicity_words_have_no_case_in_any_language():
    texts = ["éa größe ñandú", "ΟΔΟΣ", "x"]
    small, large = (dict(hashed(pa.array([change(t) for t in texts]))) for change in (str.lower, str.upper))
    assert all(np.array_equal(a, b) for a, b in zip(small[0], large[0]))


def test_toxicity_odd_rows(spark, documents, odd):
    for rows in ([(3, 1), (4, 0), (3, None), (None, 1)], [], [(3, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = toxicity_scores(documents(odd), train_toxicity(documents(odd), labels, ["toxic"]), ["toxic"]).collect()
        assert len(got) == len(odd) and all(0 <= r.p_toxic <= 1 for r in got)
    assert toxicity_scores(documents([]), train_toxicity(documents([]), labels, ["toxic"]), ["toxic"]).collect() == []


def test_weights_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.5, 1, (70, 3)), rng.normal(-0.5, 1, (50, 3))
    ranking = fit_pairs(good, bad)
    x = ((good[:, None] - bad[None]) / ranking.scale).reshape(-1, 3)
    lost = 1 / (1 + np.exp(x @ ranking.weights))
    assert np.abs(1e-3 * ranking.weights - lost @ x / len(x)).max() < 2e-4


def test_quality_learns_from_every_labelled_row(spark):
    docs = spark.range(24_000).selectExpr("id as doc_id", "if(id % 3 = 0, '## !', repeat('word ', int(1 + id % 7))) as text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 > 0 and doc_id % 7 > 0) as quality")
    ranking = train_quality(feature_rows(docs, "doc_id", "text"), labels)
    known = features_in(pa.array([r.text for r in docs.select("text").collect()]))
    scores = ((known - ranking.center) / ranking.scale) @ ranking.weights
    bad = labels.where("quality = 0").count()
    assert ranking.center == pytest.approx(known.mean(0, dtype=float))
    assert ranking.threshold == pytest.approx(np.quantile(scores, bad / 24_000))


def test_a_value_is_found_by_its_rank_among_many(spark, monkeypatch):
    monkeypatch.setattr(quality, "VALUES_AT_ONCE", 10)
    values = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(3001)) / 7).alias("v")).cache()
    ordered = sorted(r.v for r in values.collect())
    assert [quality.value_at(values, rank) for rank in (0, 2500, 4999)] == [ordered[r] for r in (0, 2500, 4999)]
