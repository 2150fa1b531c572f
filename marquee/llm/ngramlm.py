"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped files (operator 5).

Counting takes two shuffles of packed arrays. Tasks count the pairs of neighbouring words in their texts and
send them, summed, to shards by a hash of the pair in which a word's pairs are spread over SPREAD shards, so that
no frequent word fills one. Each shard sums its pairs, writes them as sorted hashes with counts, and sends
what it knows about each word (as a context: total and kinds of continuation; as a word: count and
number of contexts) to the word's own shard, which writes that as sorted arrays.

Workers map the files into memory and look up the words and pairs of many texts at once, sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.quality import share_of
from marquee.llm.shared import file_system, staged
from marquee.llm.words import Splitter, mixed
from marquee.sources.paths import scratch_path

BEGIN, END = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)  # stand for the ends of a text
SHARD_TOKENS = 3_000_000  # tokens of the corpus for each shard of pairs
SPREAD = 16
FLUSH_TOKENS = 2_000_000
SCORED_BYTES = 4 << 20
# What is known of a word: count and contexts as a word; total and continuations met once, twice, more often as a context.
KNOWN = ("count", "contexts", "total", "once", "twice", "often")


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(left * np.uint64(0x2545F4914F6CDD1D) + right)


def pair_shard(left: np.ndarray, right: np.ndarray, shards: int) -> np.ndarray:
    spread = (right >> np.uint64(20)) % np.uint64(SPREAD) * np.uint64(max(1, shards // SPREAD))
    return (((left >> np.uint64(8)) + spread) % np.uint64(shards)).astype(np.int64)


def word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    return ((word >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def text_pairs(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token of each text with the one before, the end included, and the texts' new offsets."""
    texts = len(offsets) - 1
    after = offsets + np.arange(texts + 1)
    right = np.full(len(hashes) + texts, END)
    left = np.full(len(hashes) + texts, BEGIN)
    own = np.ones(len(right), bool)
    own[after[1:] - 1] = False
    right[own] = hashes
    left[1:] = right[:-1]
    left[after[:-1]] = BEGIN
    return left, right, after


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys, sorted; the values of equal keys added; and where in the input a key is first met."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values], order[first]


def packed(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _packets(shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    columns = [c[order] for c in columns]
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(shard[a]), packed(*[c[a:b] for c in columns]), int(b - a)


ROW = "kind string, shard long, n long, data binary, file string, stats array<long>"


def _row(kind: str, shard: int, n: int, data: bytes | None = None, file: str | None = None, stats: list[int] | None = None) -> dict:
    return {"kind": kind, "shard": shard, "n": n, "data": data, "file": file, "stats": stats}


_SCHEMA = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("n", pa.int64()), ("data", pa.binary()), ("file", pa.string()), ("stats", pa.list_(pa.int64()))])


def _columns(packets: list[tuple[int, memoryview]], *kinds: str) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for n, data in packets:
        at = 0
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate([*part, np.zeros(0, kind)]) for part, kind in zip(parts, kinds)]


def _written(folder: str, data: bytes) -> str:
    """A file under a name of its own, so that repeated attempts of a task don't meet."""
    fs, at = file_system(folder)
    name = f"part-{uuid4().hex}"
    with fs.open_output_stream(f"{at}/{name}") as f:
        f.write(data)
    return name


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


class Discounts(NamedTuple):
    one: float
    two: float
    more: float

    @classmethod
    def of(cls, n: list[int]) -> Discounts:
        """From how many counts are 1, 2, 3 and 4; fixed ones where a class is empty."""
        if min(n) <= 0:
            return cls(0.5, 1.0, 1.5)
        y = n[0] / (n[0] + 2 * n[1])
        return cls(*[float(np.clip(k - (k + 1) * y * n[k] / n[k - 1], 0.01 * k, k)) for k in (1, 2, 3)])

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.array([0.0, self.one, self.two, self.more])[np.minimum(counts, 3).astype(np.int64)]


class Model(NamedTuple):
    folder: str
    pair_files: list[tuple[str, int, int]]  # file, pairs, pairs of large counts, by shard
    word_files: list[tuple[str, int]]  # file, words, by shard
    tokens: int
    words: int
    pairs: int
    of_pairs: Discounts
    of_words: Discounts
    left_over: float  # share of the unigram model that goes to all words alike


def train_bigrams(docs: DataFrame, *, text_col: str = "text") -> Model:
    """Count all whole texts; null texts count as empty, which are an end alone. The driver sees one row per shard."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(SPREAD, -(-((size[0] or 0) // 6 + size[1]) // SHARD_TOKENS))
    folder = scratch_path(spark, "bigrams")
    fs, at = file_system(folder)
    fs.create_dir(at, recursive=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            left, right = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            _, n, first = summed(pair_key(left, right), np.ones(len(left), np.uint32))
            left, right = left[first], right[first]
            rows = [_row("pairs", s, k, data) for s, data, k in _packets(pair_shard(left, right, shards), left, right, n.astype("<u4"))]
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

        split = Splitter()
        for batch in batches:
            for words in split.chunks(batch.column(0)):
                waiting.append(text_pairs(words.hashes, words.offsets)[:2])
                if sum(len(w[0]) for w in waiting) >= FLUSH_TOKENS:
                    yield from flushed()
        if waiting:
            yield from flushed()

    def sum_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        packets = [(n, data.as_buffer()) for n, data in zip(table.column("n").to_pylist(), table.column("data"))]
        left, right, n = _columns(packets, "<u8", "<u8", "<u4")
        keys, n, first = summed(pair_key(left, right), n.astype(np.int64))
        left, right = left[first], right[first]
        large = np.flatnonzero(n >= 255)
        name = _written(folder, packed(keys, large.astype("<i8"), n[large], np.minimum(n, 255).astype(np.uint8)))
        rows = [_row("pairs", shard, len(keys), file=name, stats=[len(large), *_of_counts(n)])]
        known = {
            "context": (left, n, (n == 1) * 1, (n == 2) * 1, (n > 2) * 1),
            "word": (right, n, np.ones(len(n), np.int64)),
        }
        for kind, (word, *values) in known.items():
            word, *values, _ = summed(word, *values)
            for s, data, k in _packets(word_shard(word, shards), word, *values):
                rows.append(_row(kind, s, k, data))
        return pa.Table.from_pylist(rows, _SCHEMA)

    def sum_words(table: pa.Table) -> pa.Table:
        shard, kinds = table.column("shard")[0].as_py(), table.column("kind").to_pylist()
        keep = [k for k, kind in enumerate(kinds) if kind == "pairs"]
        packets = {kind: [(n, d.as_buffer()) for n, d, k in zip(table.column("n").to_pylist(), table.column("data"), kinds) if k == kind] for kind in ("context", "word")}
        word, n, contexts = _columns(packets["word"], "<u8", "<i8", "<i8")
        context, *of_context = _columns(packets["context"], "<u8", "<i8", "<i8", "<i8", "<i8")
        nothing = np.zeros(len(context), np.int64), np.zeros(len(word), np.int64)
        keys, *values, _ = summed(
            np.concatenate([word, context]),
            *[np.concatenate([v, nothing[0]]) for v in (n, contexts)],
            *[np.concatenate([nothing[1], v]) for v in of_context],
        )
        out = [table.take(keep)] if keep else []
        if len(keys):
            name = _written(folder, packed(keys, *values))
            n, contexts = values[:2]
            stats = [int(n.sum()), int((n > 0).sum()), int(contexts.sum()), *_of_counts(contexts), int((contexts > 2).sum())]
            out.append(pa.Table.from_pylist([_row("words", shard, len(keys), file=name, stats=stats)], _SCHEMA))
        return pa.concat_tables(out)

    pairs = texts.mapInArrow(count, ROW).groupBy("shard").applyInArrow(sum_pairs, ROW)
    manifest = staged(pairs.groupBy("shard").applyInArrow(sum_words, ROW).drop("data"), "bigram-manifest").collect()
    empty = ("", 0, 0)
    found = {(r.kind, r.shard): r for r in manifest}
    pair_files = [(r.file, r.n, r.stats[0]) if (r := found.get(("pairs", s))) else empty for s in range(shards)]
    word_files = [(r.file, r.n) if (r := found.get(("words", s))) else empty[:2] for s in range(shards)]
    of_pairs = np.sum([r.stats[1:] for r in manifest if r.kind == "pairs"] or [[0] * 4], axis=0)
    of_words = np.sum([r.stats for r in manifest if r.kind == "words"] or [[0] * 8], axis=0)
    tokens, words, contexts, *kinds, often = of_words.tolist()
    by_words = Discounts.of(kinds)
    left_over = (by_words.one * kinds[0] + by_words.two * kinds[1] + by_words.more * often) / contexts if contexts else 1.0
    return Model(folder, pair_files, word_files, tokens, words, contexts, Discounts.of(of_pairs.tolist()), by_words, left_over)


class Mapped:
    """The files of a model in a worker. A folder that is not on a mounted file system is read instead of mapped."""

    def __init__(self, model: Model):
        self.model = model
        self.fs, self.at = file_system(model.folder)
        self.pairs = [self._pairs(*f) for f in model.pair_files]
        self.words = [self._words(*f) for f in model.word_files]

    def _bytes(self, name: str) -> np.ndarray:
        if self.fs.type_name == "local":
            return np.memmap(f"{self.at}/{name}", np.uint8, "r")
        with self.fs.open_input_file(f"{self.at}/{name}") as f:
            return np.frombuffer(f.read(), np.uint8)

    def _pairs(self, name: str, n: int, large: int) -> tuple[np.ndarray, ...] | None:
        if not n:
            return None
        data = self._bytes(name)
        cuts = np.cumsum([0, 8 * n, 8 * large, 8 * large, n])
        return tuple(data[a:b].view(t) for a, b, t in zip(cuts, cuts[1:], ("<u8", "<i8", "<i8", "u1")))

    def _words(self, name: str, n: int) -> np.ndarray | None:
        return self._bytes(name).view("<i8").reshape(1 + len(KNOWN), n) if n else None

    def pair_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, shard = pair_key(left, right), pair_shard(left, right, len(self.pairs))
        counts = np.zeros(len(keys), np.int64)
        order = np.lexsort((keys, shard))
        edges = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b or self.pairs[s] is None:
                continue
            known, large, large_counts, small = self.pairs[s]
            asked = keys[order[a:b]]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            n = small[at].astype(np.int64)
            if len(large):
                of_large = np.minimum(np.searchsorted(large, at), len(large) - 1)
                n = np.where(n == 255, large_counts[of_large], n)
            counts[order[a:b]] = np.where(known[at] == asked, n, 0)
        return counts

    def of_words(self, words: np.ndarray) -> np.ndarray:
        """A row of KNOWN for each of the sorted words."""
        out = np.zeros((len(KNOWN), len(words)), np.int64)
        edges = np.searchsorted(word_shard(words, len(self.words)), np.arange(len(self.words) + 1))
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b or self.words[s] is None:
                continue
            known = self.words[s][0].view("<u8")
            at = np.minimum(np.searchsorted(known, words[a:b]), len(known) - 1)
            out[:, a:b] = np.where(known[at] == words[a:b], self.words[s][1:, at], 0)
        return out

    def score(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each text: number of tokens, of known tokens, base score, model's score."""
        model = self.model
        left, right, offsets = text_pairs(hashes, offsets)
        words, place = np.unique(np.concatenate([right, [BEGIN]]), return_inverse=True)
        known = dict(zip(KNOWN, self.of_words(words)))
        at = place[:-1]
        before = np.concatenate([[place[-1]], at[:-1]])
        before[offsets[:-1]] = place[-1]
        n, total = self.pair_counts(left, right), known["total"][before]
        contexts = known["contexts"]
        alone = np.maximum(contexts - model.of_words(contexts), 0) / max(1, model.pairs) + model.left_over / (model.words + 1)
        d = model.of_pairs
        kept = d.one * known["once"] + d.two * known["twice"] + d.more * known["often"]
        met = np.maximum(total, 1)
        chance = np.where(total > 0, np.maximum(n - d(n), 0) / met + kept[before] / met * alone[at], alone[at])
        base = np.log10((known["count"] + 1) / (model.tokens + model.words + 1))[at]
        per_text = lambda x: np.add.reduceat(x, offsets[:-1])
        return np.diff(offsets), per_text((known["count"] > 0)[at].astype(np.int64)), per_text(base), per_text(np.log10(chance))


def score_texts(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every whole text, one row per row of docs: id_col, n_tokens, n_known, base_score, score, perplexity.

    Tokens are words and one end. score is the model's log10 probability, base_score that of counts plus one.
    Null texts count as empty; null and repeated ids are kept; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, mapped = Splitter(), None
        split.chunk_bytes = SCORED_BYTES
        for batch in batches:
            mapped = mapped or Mapped(model)
            for words in split.chunks(batch.column(1)):
                n, n_known, base, score = mapped.score(words.hashes, words.offsets)
                ids = batch.column(0)[words.first : words.first + len(n)]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n), pa.array(n_known), pa.array(base), pa.array(score), pa.array(10 ** (-score / n))],
                    names=[id_col, "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double")


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, held_out: int = 2) -> DataFrame:
    """Learn from the documents whose part is not held out, and score all."""
    model = train_bigrams(docs.where(share_of(id_col, parts) != held_out), text_col=text_col)
    scores = score_texts(docs, model, id_col=id_col, text_col=text_col)
    return scores.withColumns({"held_out": share_of(id_col, parts) == held_out, "train_tokens": F.lit(model.tokens).cast("long")})
