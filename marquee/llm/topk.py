"""Exact top-k search by inner product (operator 1).

Each shard of the candidates has a KD-tree: nodes are split at the median of their widest dimension and keep
their tight bounding box and smallest id. A block of queries goes through the shards one after the other.
In a shard every query starts at the leaf whose box allows the highest inner product, and then reads the leaves whose box
allows one that can still change its list; queries that read the same leaf do so together, by one matrix product. The
k-th score found so far goes on to the next shard, so later shards are mostly read less.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.shared import staged

SHARD_ROWS = 8192
LEAF_ROWS = 64
LEAVES_AT_ONCE = 8
BLOCK_ROWS = 1024
LARGEST = float(2**62)
EXACT = 1 << 53  # sums of products below are exact in doubles


def scaled(column: pa.Array, scale: float) -> list[np.ndarray | None]:
    """Each vector as integers floor(scale * x), x as double; None if it or a component is null, not finite or beyond LARGEST."""
    out: list[np.ndarray | None] = []
    for vector in column:
        values = vector.values
        if values is None or values.null_count:
            out.append(None)
            continue
        values = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
        if not np.isfinite(values).all():
            out.append(None)
            continue
        if len(values) and np.abs(values).max() >= LARGEST:
            out.append(None)
            continue
        out.append(values.astype(np.int64))
    return out


class Tree:
    """Vectors in the order of the leaves, and the nodes: children of node i are 2i+1 and 2i+2."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, span: np.ndarray, least: np.ndarray):
        self.ids, self.vectors, self.low, self.high, self.span, self.least = ids, vectors, low, high, span, least

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Tree:
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF_ROWS))))
        nodes, width = 2 ** (depth + 1) - 1, vectors.shape[1]
        order = np.arange(len(ids))
        span = np.zeros((nodes, 2), np.int64)
        span[0] = 0, len(ids)
        low, high, least = np.zeros((nodes, width), np.int64), np.zeros((nodes, width), np.int64), np.zeros(nodes, np.int64)
        for node in range(nodes):
            a, b = span[node]
            own = order[a:b]
            if b > a:
                rows = vectors[own]
                low[node], high[node], least[node] = rows.min(0), rows.max(0), ids[own].min()
            if 2 * node + 2 < nodes:
                middle = (a + b) // 2
                if b - a > 1 and width:
                    widest = int((high[node] - low[node]).argmax())
                    order[a:b] = own[np.argpartition(rows[:, widest], (b - a) // 2)]
                span[2 * node + 1], span[2 * node + 2] = (a, middle), (middle, b)
        return cls(ids[order], vectors[order], low, high, span, least)

    def packed(self) -> bytes:
        most = max(np.abs(self.high).max(initial=0), np.abs(self.low).max(initial=0))
        small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
        out = io.BytesIO()
        np.savez(out, ids=self.ids, span=self.span, least=self.least, **{k: getattr(self, k).astype(small) for k in ("vectors", "low", "high")})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as kept:
            return cls(kept["ids"], kept["vectors"].astype(np.int64), kept["low"].astype(np.int64), kept["high"].astype(np.int64), kept["span"], kept["least"])


class Best:
    """The k best of one query: highest score first, ties to the smaller id; an id counts once, with its best score."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.ids) == self.k

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[: self.k]
        self.scores, self.ids = scores[first], ids[first]


def search(tree: Tree, own: np.ndarray, queries: np.ndarray, best: list[Best]) -> int:
    """Offer the tree's vectors to every query's list; returns how many leaves were read, added up over the queries.

    Every query starts at the leaf that allows it most. The others are read a few at a time, those first that allow most
    to all queries together, by one product for all queries that they may still change something for.
    """
    most = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(max(np.abs(tree.high).max(initial=0), np.abs(tree.low).max(initial=0)))) * max(1, queries.shape[1])
    kind = np.float64 if most < EXACT else object  # Python's integers, where doubles are not exact
    leaves = np.arange(len(tree.span) // 2, len(tree.span))
    leaves = leaves[tree.span[leaves, 0] < tree.span[leaves, 1]]
    q, low, high, vectors = (x.astype(kind) for x in (queries, tree.low[leaves], tree.high[leaves], tree.vectors))
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    kth, last = np.full(len(best), -np.inf, kind), np.zeros(len(best), np.int64)

    def learn(i: int) -> None:
        if best[i].full():
            kth[i], last[i] = int(best[i].scores[-1]) if kind is object else best[i].scores[-1], best[i].ids[-1]

    for i in range(len(best)):
        learn(i)
    unread, read = np.ones(bounds.shape, bool), 0

    def visit(some: np.ndarray, asking: np.ndarray) -> None:
        nonlocal read
        reach, least = bounds[np.ix_(asking, some)], tree.least[leaves[some]]
        limit = kth[asking][:, None]
        use = unread[np.ix_(asking, some)] & ((reach > limit) | (reach == limit) & (least <= last[asking][:, None])).astype(bool)
        asking, some, use = asking[use.any(1)], some[use.any(0)], use[use.any(1)][:, use.any(0)]
        if not len(asking):
            return
        read += int(use.sum())
        rows = np.concatenate([np.arange(*tree.span[leaf]) for leaf in leaves[some]])
        ids, scores = tree.ids[rows], q[asking] @ vectors[rows].T
        # What a query has read, or need not read, is left out.
        keep = np.repeat(use, [tree.span[leaf, 1] - tree.span[leaf, 0] for leaf in leaves[some]], axis=1)
        keep &= (scores >= kth[asking][:, None]).astype(bool) & (ids != own[asking][:, None])
        for j in np.flatnonzero(keep.any(1)):
            found = scores[j, keep[j]]
            if kind is object:  # a score beyond 64 bits counts as the last that they hold
                found = np.array([min(max(int(s), 1 - 2**63), 2**63 - 1) for s in found], np.int64)
            best[asking[j]].offer(found.astype(np.int64), ids[keep[j]])
            learn(asking[j])

    if not len(leaves):
        return read
    first = bounds.argmax(1)
    for leaf in np.unique(first):
        visit(np.array([leaf]), np.flatnonzero(first == leaf))
    unread[np.arange(len(best)), first] = False
    order, at, size, everyone = np.argsort(-bounds.sum(0), kind="stable"), 0, 1, np.arange(len(best))
    while at < len(order):
        visit(order[at : at + size], everyone)
        at, size = at + size, min(2 * size, LEAVES_AT_ONCE)
    return read


def _shards(rows: DataFrame, size: int, scale: float, build: bool) -> DataFrame:
    """Rows packed as shards (trees) or blocks of queries (ids and vectors), by length of the vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
        made = 0

        def made_of(width: int) -> pa.RecordBatch:
            nonlocal made
            some = waiting.pop(width)
            ids, vectors = np.array([i for i, _ in some], np.int64), np.stack([v for _, v in some])
            made += 1
            place = (TaskContext.get().partitionId() << 32) + made
            if build:
                data = Tree.build(ids, vectors).packed()
            else:
                out = io.BytesIO()
                np.savez(out, ids=ids, vectors=vectors)
                data = out.getvalue()
            return pa.RecordBatch.from_arrays([pa.array([width]), pa.array([place]), pa.array([data], pa.binary())], names=["width", "place", "data"])

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), scaled(batch.column(1), scale)):
                if i is None or vector is None:
                    continue
                waiting.setdefault(len(vector), []).append((i, vector))
                if len(waiting[len(vector)]) == size:
                    yield made_of(len(vector))
        for width in list(waiting):
            yield made_of(width)

    return rows.mapInArrow(pack, "width long, place long, data binary")


def top_k(candidates: DataFrame, queries: DataFrame, *, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k candidates of highest inner product for each query: query_id, rank (from 1), vec_id, score.

    Components count as floor(scale * x). A candidate with the query's own id is left out. Rows with a null id, a null
    vector, or a component that is null, not finite or beyond 2**62 take no part; vectors of another length than the query's
    are no candidates. Candidate rows of the same id count once, with the best score; of usable query rows of the
    same id the longest vector counts, then the greatest. Ties go to the smaller id. A score beyond 64 bits counts as the last number of 64 bits.

    A task holds a block of queries and one shard at a time. The shards are repeated for every block; the
    driver sees the blocks' numbers only.
    """
    spark = candidates.sparkSession
    pairs = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST))
    asked = pairs(queries).where("id is not null and vector is not null").where(usable)
    asked = asked.groupBy("id").agg(F.max(F.struct(F.size("vector"), "vector")).alias("most")).select("id", "most.vector")
    shards = staged(_shards(pairs(candidates), shard_rows, scale, True), "shards")
    blocks = staged(_shards(asked, block_rows, scale, False), "query-blocks")
    places: dict[int, list[int]] = {}
    for row in blocks.select("width", "place").collect():
        places.setdefault(row.width, []).append(row.place)
    schema = T.StructType.fromDDL("query_id long, rank int, vec_id long, score long")
    if not places:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(w, p) for w, p in places.items()], "width long, blocks array<long>")
    sent = shards.join(F.broadcast(listed), "width").select(F.explode("blocks").alias("block"), F.col("place").alias("step"), "data")
    sent = sent.unionByName(blocks.select(F.col("place").alias("block"), F.lit(-1).cast("long").alias("step"), "data"))

    def answered(own: np.ndarray, best: list[Best]) -> pa.RecordBatch:
        n = [len(b.ids) for b in best]
        columns = [np.repeat(own, n), np.concatenate([np.arange(1, m + 1, dtype=np.int32) for m in n]), np.concatenate([b.ids for b in best]), np.concatenate([b.scores for b in best])]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=schema.names)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors, best = np.zeros(0, np.int64), None, []
        for batch in batches:
            for step, data in zip(batch.column(1).to_pylist(), batch.column(2)):
                if step >= 0:
                    search(Tree.unpacked(data.as_buffer()), own, vectors, best)
                    continue
                if best:
                    yield answered(own, best)
                with np.load(io.BytesIO(data.as_buffer())) as kept:
                    own, vectors = kept["ids"], kept["vectors"]
                best = [Best(k) for _ in own]
        if best:
            yield answered(own, best)

    # Each block's rows arrive in order: the queries, then the shards.
    n_blocks = sum(map(len, places.values()))
    ordered = sent.repartition(min(n_blocks, 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "block").sortWithinPartitions("block", "step")

    return ordered.mapInArrow(answer, schema)
