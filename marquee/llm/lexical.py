"""Ranked lexical search (operator 11): term-at-a-time with a limit on accumulators.

The documents are indexed in shards: each has its documents' lengths and the postings of its terms, sorted by term. A
shard answers a query by one term after the other, the rarest first. A document gets an accumulator when a
term is met in it. Once the highest scores that the remaining terms can add (each term's highest in the shard,
times its repeats) stay below the k-th partial score, no more accumulators are made: a document without one can't
be among the k best. The remaining terms still go to those that there are, so that their scores are
exact. A task carries the k best of every query from shard to shard, whose k-th score also counts as a partial one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.shared import parts_of, staged
from marquee.llm.words import Splitter

# What separates terms (all of ASCII but digits and letters), and the numbers of the score.
TERM_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
WEIGHT_SCALE, TF_SCALE, TF_PART, LENGTH_PART, LENGTH_PERCENT = 1000, 1_000_000_000, 1000, 8, 75

ITEM_BYTES = 32 << 20  # of queries that are sent to the workers at once; more are taken in several passes
SHARD_POSTINGS = 500_000
MERGE_PARTS = 64  # a query's lists meet in so many parts first


def term_lists(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of each text's terms, repeats included."""
    out: list[np.ndarray] = []
    for chunk in Splitter(TERM_SEPARATORS).chunks(pa.array(texts, pa.string())):
        out += [chunk.hashes[a:b] for a, b in zip(chunk.offsets, chunk.offsets[1:])]
    return out


def index_shards(docs: DataFrame, vocabulary: np.ndarray, *, id_col: str, text_col: str) -> DataFrame:
    """The shards of an index of the terms in vocabulary (sorted hashes), a row each.

    Columns: n_docs and n_terms (documents with terms, and all their terms), terms and df (places in vocabulary and
    documents of each term of the shard), and as packed arrays ids, lengths (of documents), owners, tfs (of
    postings, by term). Rows without an id are left out.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(TERM_SEPARATORS)
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        documents = entries = 0

        def shard() -> pa.RecordBatch:
            place, owner, tf = (np.concatenate(c) for c in zip(*postings))
            order = np.argsort(place, kind="stable")
            terms, df = np.unique(place, return_counts=True)
            sizes = np.concatenate(lengths)
            row = [documents, int(sizes.sum()), terms.tolist(), df.tolist()]
            row += [a.tobytes() for a in (np.concatenate(ids), sizes, owner[order].astype("<u4"), tf[order].astype("<u4"))]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 4]
            names = ["n_docs", "n_terms", "terms", "df", "ids", "lengths", "owners", "tfs"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in parts_of(batches):
            for words in split.chunks(batch.column(1)):
                size = np.diff(words.offsets)
                own = batch.column(0)[words.first : words.first + len(size)].to_numpy(zero_copy_only=False)
                having = np.flatnonzero(size)
                number = np.full(len(size), -1)
                number[having] = np.arange(len(having))
                at = np.searchsorted(known.value, words.hashes)
                hit = np.flatnonzero(known.value[np.minimum(at, len(known.value) - 1)] == words.hashes) if len(known.value) else np.zeros(0, np.int64)
                text = number[np.searchsorted(words.offsets, hit, "right") - 1]
                key, tf = np.unique(at[hit] * max(1, len(having)) + text, return_counts=True)
                place, text = np.divmod(key, max(1, len(having)))
                ids.append(own[having].astype("<i8"))
                lengths.append(size[having].astype("<i8"))
                postings.append((place, text + documents, tf))
                documents, entries = documents + len(having), entries + len(key)
                if entries >= SHARD_POSTINGS:
                    yield shard()
                    ids, lengths, postings, documents, entries = [], [], [], 0, 0
        if documents:
            yield shard()

    schema = "n_docs long, n_terms long, terms array<int>, df array<int>, ids binary, lengths binary, owners binary, tfs binary"
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")).mapInArrow(scan, schema)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """A weight per term from its document frequency."""
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """What a term of weight 1 adds to a document's score."""
    m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * length * documents) // tokens
    return (TF_SCALE * tf) // (TF_PART * tf + LENGTH_PART * m)


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th highest, or -1 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -1


def answer(query: list[tuple[np.ndarray, np.ndarray, int]], documents: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents of a shard that may be among the k best, with their exact scores, and how many accumulators were made.

    query has for each term, the rarest first, its documents, what it adds to each, and the most that it adds.
    floor is a score that k other documents have.
    """
    score, made, creating = np.zeros(documents, np.int64), np.zeros(documents, bool), True
    left = np.cumsum([most for _, _, most in query][::-1])[::-1].tolist()
    for (owner, added, _), bound in zip(query, left):
        # Equal scores are told apart by id, so a bound that is only reached does not end it.
        if creating and (bound < floor or bound < kth(score[made], k)):
            creating = False
        if creating:
            score[owner] += added
            made[owner] = True
        else:
            kept = made[owner]
            score[owner[kept]] += added[kept]
    found = np.flatnonzero(made & (score > 0))
    return found, score[found], int(made.sum())


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > k:
        enough = scores >= kth(scores, k)
        ids, scores = ids[enough], scores[enough]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_shards(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, df: np.ndarray, documents: int, tokens: int, k: int) -> DataFrame:
    """For each query (places of terms, repeats) the k best of every task: query, doc, score."""
    by_rarity = []
    for places, repeats in queries:
        order = np.lexsort((places, df[places]))
        by_rarity.append((places[order], repeats[order]))
    sent = index.sparkSession.sparkContext.broadcast((by_rarity, weight))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, heavy = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        for batch in batches:
            for row in range(batch.num_rows):
                terms, counts = (batch.column(c)[row].values.to_numpy() for c in ("terms", "df"))
                ids, lengths, owners, tfs = (np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in (("ids", "<i8"), ("lengths", "<i8"), ("owners", "<u4"), ("tfs", "<u4")))
                if not len(terms):
                    continue
                added = impacts(tfs.astype(np.int64), lengths[owners], documents, tokens) * np.repeat(heavy[terms], counts)
                edge = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                most = np.maximum.reduceat(added, edge[:-1])
                for q, (places, repeats) in enumerate(asked):
                    at = np.minimum(np.searchsorted(terms, places), len(terms) - 1)
                    here = np.flatnonzero(terms[at] == places)
                    query = [(owners[edge[t] : edge[t + 1]], added[edge[t] : edge[t + 1]] * n, int(most[t] * n)) for t, n in zip(at[here], repeats[here])]
                    floor = int(best[q][1][-1]) if len(best[q][1]) == k else -1
                    found, scores, _ = answer(query, len(ids), k, floor)
                    best[q] = best_of(np.concatenate([best[q][0], ids[found]]), np.concatenate([best[q][1], scores]), k)
            pa.default_memory_pool().release_unused()
        number = np.repeat(np.arange(len(best)), [len(ids) for ids, _ in best])
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*best)] if best else [np.zeros(0, np.int64)] * 2
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), *map(pa.array, columns)], names=["query", "doc", "score"])

    return index.mapInArrow(scan, "query long, doc long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k documents of the highest score above 0 for each item: item_col, rank (from 1), id_col (as long), score.

    Terms are runs of ASCII digits and letters and of all other characters beyond ASCII, with A-Z lower-cased, compared by
    64-bit hashes. Equal scores go by id; rows of equal ids are ranked one by one. Texts of equal item ids are one query. Null and empty
    texts have no terms: such documents count nowhere, such items have no rows. Rows without an id, of docs or items, are left out;
    other columns too. The driver sees the items, in portions of ITEM_BYTES, and in how many documents their terms are.
    """
    spark = docs.sparkSession
    asked = items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("body"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    portions = int(-(-size // ITEM_BYTES)) or 1
    kind, result = items.schema[item_col].dataType.simpleString(), None
    for portion in range(portions):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(portions)) == portion).toArrow()
        texts = term_lists(own.column("body").to_pylist())
        of_item: dict = {}
        for item, terms in zip(own.column("item").to_pylist(), texts):
            of_item.setdefault(item, []).append(terms)
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *texts]))
        queries = [np.unique(np.searchsorted(vocabulary, np.concatenate(terms)), return_counts=True) for terms in of_item.values()]
        index = staged(index_shards(docs, vocabulary, id_col=id_col, text_col=text_col), "lexical-index")
        documents, tokens = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for term, n in index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df")).collect():
            df[term] = n
        found = search_shards(index, queries, weights(df, documents), df, documents, tokens, k)
        names = spark.createDataFrame([*enumerate(of_item)], f"query long, item {kind}")
        found = found.join(F.broadcast(names), "query").drop("query")
        result = found if result is None else result.unionByName(found)
    by_score = [F.desc("score"), F.asc("doc")]
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part")
    for keys in (["item", "part"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score)).alias("rank")
        result = result.select("item", "doc", "score", *([part] if "part" in keys else [])).select("item", "doc", "score", rank).where(F.col("rank") <= k)
    return result.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
