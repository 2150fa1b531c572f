"""Benchmark decontamination (operator 4).

Runs of SEED_WORDS words of the test items are seeds. A pass over the whole corpus finds every seed and cuts out the
passage around it; the same pass counts the items' words. A seed is rare if, by the frequency of its words
among all words of the corpus, chance puts it into fewer than one of 10,000 documents. Passages with a rare seed of an item,
or with as many seeds as a run of RUN_LEAST words has, are aligned with that item by Smith-Waterman on words, so that
edited copies score by what is left of the item. A part counts by its share of the item or by its own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import KEY, parts_of, row_key, staged, with_ids
from marquee.llm.toxicity import PUNCTUATION
from marquee.llm.words import SEPARATORS, Splitter, grams

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, 1
SCORE_LEAST = 0.5  # of the score of the whole item
RUN_LEAST = 13  # aligned words that are enough, however long the item
RARE = 1e-4  # chance of a seed in a document
ITEM_BYTES = 32 << 20  # of items that are sent to the workers at once; more are taken in several passes


class Items(NamedTuple):
    ids: list
    words: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes of all their words
    seeds: np.ndarray  # sorted hashes of runs of words
    seed_words: np.ndarray  # a row of places in the vocabulary for each seed
    item_of: np.ndarray  # item of each occurrence, by seed
    item_from: np.ndarray  # where a seed's occurrences begin

    @classmethod
    def of(cls, ids: list, texts: list[str], n: int) -> Items:
        words: list[np.ndarray] = []
        for chunk in Splitter(SEPARATORS + PUNCTUATION, unicode=True).chunks(pa.array(texts, pa.string())):
            words += [chunk.hashes[a:b] for a, b in zip(chunk.offsets, chunk.offsets[1:])]
        some = [np.zeros(0, np.uint64), *words]
        vocabulary = np.unique(np.concatenate(some))
        runs = np.concatenate([grams(w, n) for w in some])
        item = np.repeat(np.arange(-1, len(words)), [max(0, len(w) - n + 1) for w in some])
        places = [np.searchsorted(vocabulary, w) for w in some]
        shown = np.concatenate([np.lib.stride_tricks.sliding_window_view(p, n) if len(p) >= n else np.zeros((0, n), np.int64) for p in places])
        order = np.argsort(runs, kind="stable")
        seeds, first = np.unique(runs[order], return_index=True)
        return cls(ids, words, vocabulary, seeds, shown[order][first], item[order], np.append(first, len(order)))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Highest local alignment score, and where in the passage it ends."""
    shift = GAP * np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] - GAP)
        row = np.maximum.accumulate(np.maximum(new, 0) + shift) - shift  # gaps in the item
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _near(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted values, or -1."""
    if not len(values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, -1)


def _passages(docs: DataFrame, items, n: int, id_col: str, text_col: str) -> DataFrame:
    """Passages around seeds (doc, item, seeds, start, words), and counts of words (place in the vocabulary from 1, 0 for all others; n)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {kind}, item int, seeds array<int>, start long, words binary, word int, n long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*items.value)
        split, counts, type_of_id = Splitter(SEPARATORS + PUNCTUATION, unicode=True), np.zeros(len(known.vocabulary) + 1, np.int64), None
        names = ["doc", "item", "seeds", "start", "words", "word", "n"]
        for batch in parts_of(batches):
            type_of_id = batch.column(0).type
            for words in split.chunks(batch.column(1)):
                counts += np.bincount(_near(known.vocabulary, words.hashes) + 1, minlength=len(counts))
                seed = _near(known.seeds, grams(words.hashes, n))
                at = np.flatnonzero(seed >= 0)
                text = np.searchsorted(words.offsets, at, "right") - 1
                inside = at + n <= words.offsets[text + 1]
                at, text = at[inside], text[inside]
                seed = seed[at]
                times = known.item_from[seed + 1] - known.item_from[seed]
                hit = np.repeat(np.arange(len(at)), times)
                item = known.item_of[np.repeat(known.item_from[seed], times) + np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)]
                order = np.lexsort((at[hit], item, text[hit]))
                hit, item = hit[order], item[order]
                reach = 2 * np.array([len(w) for w in known.words])[item] if len(item) else item
                place = at[hit]
                fresh = np.ones(len(hit), bool)  # hits of a text and item whose passages meet make one
                fresh[1:] = (text[hit][1:] != text[hit][:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > 2 * reach[1:] + n)
                edges = np.append(np.flatnonzero(fresh), len(hit))
                rows = []
                for a, b in zip(edges, edges[1:]):
                    t = text[hit[a]]
                    low = max(words.offsets[t], place[a] - reach[a])
                    high = min(words.offsets[t + 1], place[b - 1] + n + reach[a])
                    rows.append((words.first + t, item[a], np.unique(seed[hit[a:b]]).tolist(), low - words.offsets[t], words.hashes[low:high].tobytes()))
                if rows:
                    of_text, of_item, seeds, start, passage = zip(*rows)
                    nothing = pa.nulls(len(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(of_text)), pa.array(of_item, pa.int32()), pa.array(seeds, pa.list_(pa.int32())), pa.array(start, pa.int64()), pa.array(passage, pa.binary()), nothing.cast(pa.int32()), nothing.cast(pa.int64())],
                        names=names,
                    )
        if type_of_id is not None:
            met = np.flatnonzero(counts)
            nothing = pa.nulls(len(met))
            yield pa.RecordBatch.from_arrays(
                [nothing.cast(type_of_id), nothing.cast(pa.int32()), nothing.cast(pa.list_(pa.int32())), nothing.cast(pa.int64()), nothing.cast(pa.binary()), pa.array(met, pa.int32()), pa.array(counts[met])],
                names=names,
            )

    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def rare_seeds(items: Items, counts: np.ndarray, documents: int) -> np.ndarray:
    """Whether chance puts a seed into few documents; all seeds of an item that has no such seed count as well."""
    total = max(1, int(counts.sum()))
    # Each document is as many trials as it has words.
    chance = np.exp(np.log(np.maximum(counts[1:], 1) / total)[items.seed_words].sum(axis=1)) * total / max(1, documents) if len(items.seeds) else np.zeros(0)
    rare = chance <= RARE
    seed = np.repeat(np.arange(len(items.seeds)), np.diff(items.item_from))
    having = np.zeros(len(items.words), bool)
    having[items.item_of[rare[seed]]] = True
    rare[seed[~having[items.item_of]]] = True
    return rare


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed_words: int = SEED_WORDS, score_least: float = SCORE_LEAST, run_least: int = RUN_LEAST) -> DataFrame:
    """Documents that hold a test item, an edited copy or a long part of one, one row per document id and item.

    Returns id_col, item_col, score (of the alignment, as a share of the whole item's), start and end (words of
    the document) of the best passage. Enough is score_least, or a score worth run_least aligned words. Words are without case, in any language, and without punctuation; whole texts are read.
    Null texts hold nothing; rows of equal ids count as one document, also of null; items with fewer than
    seed_words words can't be told from ordinary text and are left out; items of equal id and text
    count once. Other columns are left out. The driver sees the items, in portions of ITEM_BYTES, and
    how often their words occur.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("body")).where("body is not null").distinct()
    size = tests.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    portions = int(-(-size // ITEM_BYTES)) or 1
    documents, found = docs.count(), None
    for portion in range(portions):
        own = tests.where(F.pmod(F.xxhash64("item", "body"), F.lit(portions)) == portion).toArrow()
        items = Items.of(own.column("item").to_pylist(), own.column("body").to_pylist(), seed_words)
        sent = spark.sparkContext.broadcast(tuple(items))  # plain: executors have no class of this package
        passages = staged(_passages(docs, sent, seed_words, id_col, text_col), "passages")
        counts = np.zeros(len(items.vocabulary) + 1, np.int64)
        for word, n in passages.where("word is not null").groupBy("word").agg(F.sum("n")).collect():
            counts[word] = n
        aligned = _aligned(passages, sent, rare_seeds(items, counts, documents), seed_words, score_least, run_least, own.schema.field("item").type, benchmark.schema[item_col].dataType.simpleString())
        found = aligned if found is None else found.unionByName(aligned)
    best = found.groupBy("doc", "item").agg(F.max(F.struct("score", F.negative("start").alias("start"), "end")).alias("best"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.score", F.negative("best.start").alias("start"), "best.end")


def _aligned(passages: DataFrame, items, rare: np.ndarray, n: int, score_least: float, run_least: int, item_type: pa.DataType, item_kind: str) -> DataFrame:
    kind = passages.schema["doc"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*items.value)
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in (1, 2, 3, 4)]
            for k, (item, seeds, start, passage) in enumerate(zip(*columns)):
                if not rare[seeds].any() and len(seeds) <= run_least - n:
                    continue
                own, passage = known.words[item], np.frombuffer(passage, np.uint64)
                best, end = align(own, passage)
                share = best / (MATCH * len(own))
                if share >= score_least or best >= MATCH * run_least:
                    length = align(own[::-1], passage[:end][::-1])[1]
                    rows.append((k, known.ids[item], share, start + end - length, start + end))
            if rows:
                of, ids, shares, starts, ends = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), pa.array(ids, item_type), pa.array(shares), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                    names=["doc", "item", "score", "start", "end"],
                )

    hits = passages.where("item is not null").select("doc", "item", "seeds", "start", "words")
    return hits.mapInArrow(score, f"doc {kind}, item {item_kind}, score double, start long, end long")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs without those whose text has a row in `contaminated`.

    Each row goes or stays by its own text, so a null or repeated id takes no other row along.
    """
    keyed = docs.withColumn(KEY, row_key(id_col, text_col))
    found = staged(contaminated(keyed, benchmark, id_col=KEY, text_col=text_col, **options).select(KEY), "contaminated")
    return with_ids(keyed, found, KEY, "left_anti").drop(KEY)
