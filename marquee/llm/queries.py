"""The registered queries of the operators, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bpe import bpe_tokens
from marquee.llm.decontam import contaminated
from marquee.llm.jaccard import jaccard_components
from marquee.llm.lexical import ranked_search
from marquee.llm.ngramlm import lm_scores
from marquee.llm.quality import quality_scores
from marquee.llm.secrets import secret_spans, train_char_models
from marquee.llm.substrings import without_repeats
from marquee.llm.tokenfiles import read_token_files, write_token_files
from marquee.llm.topk import top_k
from marquee.llm.toxicity import toxicity_scores, train_toxicity
from marquee.llm.urls import judge_urls, labelled_urls, train_url_model
from marquee.llm.whitening import whitened
from marquee.sources.paths import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_token_files(spark, folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances that a document is toxic, and toxic junk; predicted is 1 for toxic ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labels = labels.select("doc_id", "toxic", (F.col("toxic") * (1 - F.col("quality"))).alias("toxic_junk"))
    categories = ["toxic", "toxic_junk"]
    scores = toxicity_scores(docs, train_toxicity(docs, labels, categories), categories)
    return scores.select("doc_id", F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"), "p_toxic_junk")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return tokens.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_spans(docs, train_char_models(docs))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), train_url_model(labelled_urls(spark)))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_lm_scores": op5_lm_scores,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_secret_scan": op9_secret_scan,
    "op10_url_filter": op10_url_filter,
    "op11_ranked_search": op11_ranked_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op1_exact_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as u from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.u, c.u), lambda p: cast(p[1] * p[2] as bigint))) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.u) = len(q.u) where q.vec_id % 20 = 0),
r as (select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 20""",
    "op2_ngram_jaccard": r"""
with recursive w as (select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents where doc_id is not null),
s as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as g from w),
u as (select doc_id, len(g) as n, unnest(g) as shingle from s),
links as (select a.doc_id as a, b.doc_id as b from u a join u b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select doc_id as a, doc_id as b from s union select reach.a, links.b from reach join links on reach.b = links.a)
select s.doc_id, cast(len(s.g) as bigint) as n_shingles, r.component_id
from s join (select a, min(b) as component_id from reach group by a) r on r.a = s.doc_id""",
    "op11_ranked_search": r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws, row_number() over () as r from documents where doc_id is not null and text is not null),
d1 as (select doc_id, r, cast(len(ws) as bigint) as n, ws from d where len(ws) > 0),
g as (select cast(count(*) as bigint) as big_n, cast(sum(n) as bigint) as big_l from d1),
u as (select r, unnest(ws) as term from d1),
p as (select r, term, count(*) as tf from u group by r, term),
f as (select term, count(*) as df from p group by term),
w as (select term, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double)) as bigint) as w from f, g),
i as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark where item_id is not null and text is not null),
q as (select item_id, term, count(*) as reps from i group by item_id, term),
s as (select q.item_id, p.r, cast(sum(q.reps * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + ((75 * d1.n * g.big_n) // g.big_l))))) as bigint) as score
  from q join p on p.term = q.term join w on w.term = q.term join d1 on d1.r = p.r, g group by q.item_id, p.r),
k as (select s.item_id, d1.doc_id, s.score, row_number() over (partition by s.item_id order by s.score desc, d1.doc_id) as rank
  from s join d1 on d1.r = s.r where s.score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from k where rank <= 10""",
    "op12_substring_dedup": r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select r, unnest(range(1, len(ws) - 33)) as i from d),
w as (select s.r, s.i, array_to_string(d.ws[s.i:s.i + 34], ' ') as t from s join d on d.r = s.r),
m as (select r, i from (select r, i, count(*) over (partition by t) as n from w) where n > 1),
c as (select distinct r, unnest(range(i, i + 35)) as p from m),
a as (select d.r, p.p, d.ws[p.p] as word from d, lateral (select unnest(range(1, len(d.ws) + 1)) as p) p),
k as (select a.r, string_agg(a.word, ' ' order by a.p) as kept, count(*) as n_kept from a anti join c on c.r = a.r and c.p = a.p group by a.r)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(len(d.ws) - coalesce(k.n_kept, 0) as bigint) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k on k.r = d.r""",
}
