from pyspark.sql import functions as F

from marquee.llm.quality import good_documents, quality_scores
from marquee.llm.shared import labelled_texts


def test_repeated_ids_and_labels_bring_one_row_each(spark, documents):
    docs = documents([(i % 5 if i % 3 else 0, f"text {i}") for i in range(300)] + [(None, "x"), (7, None)])
    labels = spark.createDataFrame([(0, 1)] * 100 + [(0, 0), (1, 0), (2, None), (None, 1), (7, 1), (99, 1)], "doc_id long, quality int")
    got = sorted((r.key, r.quality) for r in labelled_texts(docs, labels, ["quality"], 50, "doc_id", "text").collect())
    assert got == [(0, 1), (1, 0), (7, 1)]


def test_the_bound_is_exact_and_the_choice_the_same_each_time(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    chosen = [{r.key for r in labelled_texts(docs.repartition(n), labels.repartition(n), ["quality"], 700, "doc_id", "text").collect()} for n in (2, 9)]
    assert len(chosen[0]) == 700 and chosen[0] == chosen[1]


def test_a_share_of_the_hashes_holds_at_every_size(spark):
    """Of 10**11 labels, 20,000 are still found: the share is not cut to whole millionths."""
    share = 2.0 * 21_000 / 10**11
    limit = -(2.0**63) + share * 2.0**64
    assert limit > -(2.0**63) and limit + 2.0**63 > 1e12


def test_good_documents_judges_rows_by_their_own_text(spark, sample, documents, odd):
    labels = sample("labels")
    docs = sample("documents")
    rows = [(1, r.text) for r in docs.limit(60).collect()] + odd
    frame = documents(rows)
    kept = sorted(((r.doc_id, r.text) for r in good_documents(frame, labels).collect()), key=repr)
    scored = quality_scores(frame.select(F.col("text").alias("doc"), "doc_id", "text"), labels)
    assert len(kept) == scored.where("predicted = 1").count()
    assert good_documents(documents([]), labels).collect() == []
    assert set(good_documents(frame, labels).columns) == set(frame.columns)
