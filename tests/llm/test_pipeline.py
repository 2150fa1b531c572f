import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from marquee.llm.bpe import parse_ranks
from marquee.llm.decontam import contaminated
from marquee.llm.jaccard import jaccard_components
from marquee.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_scores(docs, labels).collect() if r.predicted}
    steps = dict(corpus_pipeline.STAGES)
    docs = steps["quality"](spark, docs, SF)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == good
    groups = {r.doc_id: r.component_id for r in jaccard_components(docs, words=5, num=80).collect()}
    docs = steps["jaccard"](spark, docs, SF)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(groups.values())
    held = {r.doc_id for r in contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    before = {r.doc_id for r in docs.collect()}
    docs = steps["decontamination"](spark, docs, SF)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == before - held
    before = {r.doc_id: r.text for r in docs.collect()}
    docs = steps["secrets"](spark, docs, SF)
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(after) == set(before)
    assert all(r.n_chars == len(r.text) and (r.text == before[i] or "[secret]" in r.text) for i, r in after.items())
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=parse_ranks(f.read()), special_tokens={})
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(result) == set(after)
    for i, r in result.items():
        ids = library.encode_ordinary(after[i].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(after[i].text.encode()).hexdigest()


def test_all_operators_are_registered():
    from marquee.llm.queries import QUERIES

    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_odd_rows_go_through_all_stages(spark, documents, odd, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in ([*odd, *odd], []):
        docs = documents(rows)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = {(r.doc_id, r.text) for r in docs.collect()}
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns, name
            assert {(r.doc_id, r.text) for r in docs.collect()} <= before, name
        found = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        left = [(r.doc_id, r.text or "") for r in docs.collect()]
        assert sorted((str(r.doc_id), r.decoded_sha256) for r in found) == sorted((str(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in left)
        spoken = [i for i, t in left if t.split()]
        assert len(spoken) == len({t for _, t in left if t.split()})
