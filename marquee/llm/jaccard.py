"""Jaccard join of documents on n-word shingles, with prefixes under several global orders (operator 2).

Two sets that are similar enough share a shingle among the first few of each, under any order of all
shingles. Candidates must do so under three orders:

1. Rarity. Each document gives the first part of its set by hash, about twice the usual prefix, in which
   two similar sets share so many shingles that they also share one of the rarest. A shingle that only one
   class of equal sets has can't be shared; these are struck out first, so a text of its own ends here.
2., 3. Two orders by hash, whose prefixes must meet as well before two sets are compared.

Documents of equal sets are one class. Within a shingle's classes, first the two outermost are compared with all
others, which leaves many shingles with classes of one component. Where several components meet, each class is joined
with its nearest of another one, and then all pairs between different components are compared in blocks by bit signatures, whose distance is at most the number
of shingles that two sets don't share, and only pairs that this leaves become rows. So every link
between components is found, without listing the pairs within a group of copies. Components come from
alternating minimum stars over the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.ngramlm import _columns, _packets
from marquee.llm.shared import KEY, give_back, parts_of, row_key, staged, with_ids
from marquee.llm.words import Splitter, grams, mixed

SIGNATURE_BITS = 2048
FEW = 64  # classes of a shingle up to which their pairs are listed in memory instead of multiplied as matrices
PAIRS_AT_ONCE = 1 << 15
BLOCK_ROWS = 1024  # classes of a shingle that are compared with as many at once
BUCKET_SHINGLES = 400_000  # prefix shingles that a task takes at once
FLUSH_SHINGLES = 500_000
NEAREST_ROUNDS = 1
SMALL_SET = 192  # of smaller sets, all shingles are in the first part
ORDERS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


class Threshold:
    """Jaccard similarity of at least num/den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.least = num, den, {}

    def overlap(self, n: np.ndarray) -> np.ndarray:
        """The fewest shared shingles of a set of n with any similar one."""
        return -(-self.num * n // self.den)

    def first(self, n: np.ndarray) -> np.ndarray:
        """Size of the first part of a set by hash."""
        return np.minimum(n, np.maximum(SMALL_SET, -(-2 * (self.den - self.num) * n // self.den) + 2))

    def prefix(self, n: int) -> int:
        """How many of the rarest of the first part must be looked at: two similar sets share `least` in theirs."""
        if n not in self.least:
            sizes = np.arange(max(1, -(-self.num * n // self.den)), self.den * n // self.num + 1)
            shared = self.first(sizes) - (sizes - self.overlap(sizes))
            self.least[n] = max(1, int(shared.min()))
        return int(self.first(np.int64(n))) - self.least[n] + 1


def shingle_sets(words, n: int) -> Iterator[np.ndarray]:
    """The sorted different n-word shingles of each text; fewer words are one shingle, no words none."""
    runs = grams(words.hashes, n)
    for a, b in zip(words.offsets, words.offsets[1:]):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        else:
            yield grams(words.hashes[a:b], b - a) if b > a else runs[:0]


def _collect(docs: DataFrame, n: int, limit: Threshold, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind doc (a: id, b: class, c: set size, d: size of the first part, e: prefix), share (a: shingle, b: class) and
    shingle (a: shingle, b: documents) for shingles that several classes have."""
    packet = pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("n", pa.int64()), ("data", pa.binary())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_met: list[tuple[int, int, int, int, int]] = []
        first: dict[int, np.ndarray] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            ids, classes, sizes, firsts, prefixes = (np.array(x, t) for x, t in zip(zip(*docs_met), ("i8", "u8", "i8", "i8", "i8")))
            # Only passed on, so dealt evenly, however many rows one class has.
            rows = list(_packets(np.arange(len(ids)) * buckets // len(ids), ids, classes, sizes, firsts, prefixes))
            out = [(bucket, "doc", k, data) for bucket, data, k in rows]
            tokens = np.concatenate([*first.values(), np.zeros(0, np.uint64)])
            owners = np.repeat(np.array(list(first), np.uint64), [len(x) for x in first.values()])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
            times = np.diff(np.append(edge, len(tokens)))
            several = np.repeat(times > 1, times)
            bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            # A shingle that several classes of this task have is known as shared; its bucket only learns how often it is met.
            out += [(b, "one", k, d) for b, d, k in _packets(bucket[edge], tokens[edge], owners[edge], times)]
            shared = np.flatnonzero(several)
            out += [(int(shared[at]) % buckets, "share", len(part := shared[at : at + 50_000]), tokens[part].tobytes() + owners[part].tobytes()) for at in range(0, len(shared), 50_000)]
            docs_met.clear()
            first.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), packet.types)], schema=packet)

        split = Splitter()
        for batch in parts_of(batches):
            for words in split.chunks(batch.column(1)):
                ids = batch.column(0)[words.first : words.first + len(words.offsets) - 1].to_pylist()
                for i, found in zip(ids, shingle_sets(words, n)):
                    if i is None:
                        continue
                    with np.errstate(over="ignore"):
                        own = int(mixed(np.array([mixed(found ^ ORDERS[0]).sum(dtype=np.uint64) + np.uint64(len(found))]))[0])
                    k = int(limit.first(np.int64(len(found))))
                    docs_met.append((i, own, len(found), k, limit.prefix(len(found)) if len(found) else 0))
                    if own not in first:
                        first[own] = found[:k]
                        size += k
                if size >= FLUSH_SHINGLES:
                    size = 0
                    yield from flushed()
        if docs_met:
            yield from flushed()

    result = pa.schema([("kind", pa.string()), *[(c, pa.int64()) for c in "abcde"]])

    def sift(table: pa.Table) -> pa.Table:
        give_back()
        kinds, sizes, data = (table.column(c).to_pylist() if c != "data" else table.column(c) for c in ("kind", "n", "data"))
        of = lambda kind: [(k, d.as_buffer()) for k, d, have in zip(sizes, data, kinds) if have == kind]

        def rows(kind: str, *columns: np.ndarray) -> pa.Table:
            full = [pa.array(np.asarray(c).view(np.int64) if np.asarray(c).dtype == np.uint64 else c, pa.int64()) for c in columns]
            full += [pa.nulls(len(columns[0]), pa.int64())] * (5 - len(full))
            return pa.Table.from_arrays([pa.array([kind] * len(columns[0]), pa.string()), *full], schema=result)

        out = [rows("doc", *_columns(of("doc"), "<i8", "<u8", "<i8", "<i8", "<i8")), rows("share", *_columns(of("share"), "<u8", "<u8"))]
        tokens, owners, times = _columns(of("one"), "<u8", "<u8", "<i8")
        order = np.lexsort((owners, tokens))
        tokens, owners, times = tokens[order], owners[order], times[order]
        if len(tokens):
            edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            total, most = np.add.reduceat(times, edge), np.maximum.reduceat(times, edge)
            last = np.append(edge[1:], len(tokens)) - 1
            shared = (owners[edge] != owners[last]) | (most > 1)
            out.append(rows("shingle", tokens[edge][shared], total[shared]))
            keep = np.repeat(shared, np.diff(np.append(edge, len(tokens)))) & (times == 1)
            out.append(rows("share", tokens[keep], owners[keep]))
        return pa.concat_tables(out)

    kinds = "kind string, a long, b long, c long, d long, e long"
    packets = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")).mapInArrow(gather, "bucket long, kind string, n long, data binary")
    return packets.groupBy("bucket").applyInArrow(sift, kinds)


def components(links: DataFrame) -> DataFrame:
    """Of links (a, b): every end and its component, the smallest end that it reaches. Columns node, component.

    Alternates large and small stars: ends move to the smallest neighbour until every end hangs on its component.
    """
    edges, before = staged(links.select("a", "b").where("a <> b").distinct(), "links"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        edges = staged(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        before = now


def _sets(docs: DataFrame, wanted: DataFrame, n: int, limit: Threshold, id_col: str, text_col: str) -> DataFrame:
    """rep, its set, its prefixes under the second and third order, and its signature, for the wanted documents."""
    texts = with_ids(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("body")), wanted, "rep", "left_semi")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter()
        lists = pa.list_(pa.int64())
        for batch in parts_of(batches):
            for words in split.chunks(batch.column(1)):
                sets = list(shingle_sets(words, n))
                columns = [[x.view(np.int64) for x in sets]]
                for order in ORDERS:
                    columns.append([found[np.argsort(mixed(found ^ order))][: len(found) - int(limit.overlap(np.int64(len(found)))) + 1].view(np.int64) for found in sets])
                ids, bits = batch.column(0)[words.first : words.first + len(sets)], pa.array([signature(x) for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, lists) for c in columns], bits], names=["rep", "grams", "second", "third", "bits"])

    return texts.mapInArrow(scan, "rep long, grams array<long>, second array<long>, third array<long>, bits binary")


def signature(grams: np.ndarray) -> bytes:
    """A bit for each of SIGNATURE_BITS parts of the shingles: whether the set has an odd number of them."""
    counts = np.bincount((grams >> np.uint64(17)).astype(np.int64) % SIGNATURE_BITS, minlength=SIGNATURE_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _possible(n_left: np.ndarray, n_right: np.ndarray, limit: Threshold) -> np.ndarray:
    return limit.den * np.minimum(n_left, n_right) >= limit.num * np.maximum(n_left, n_right)


def compared(n: np.ndarray, component: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray, limit: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of left and right that are of different components and may be similar."""
    signs = [np.unpackbits(bits[side], axis=1).astype(np.float32) * 2 - 1 for side in (left, right)]
    apart = (SIGNATURE_BITS - signs[0] @ signs[1].T) / 2
    n_left, n_right = n[left][:, None], n[right][None, :]
    may = apart * (limit.den + limit.num) <= (n_left + n_right) * (limit.den - limit.num)
    may &= _possible(n_left, n_right, limit) & (component[left][:, None] != component[right][None, :])
    if left is right:
        may = np.triu(may, 1)
    x, y = np.nonzero(may)
    return left[x], right[y]


def compared_few(n: np.ndarray, component: np.ndarray, bits: np.ndarray, starts: np.ndarray, size: int, limit: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same within many groups of `size` rows each, given by where they begin."""
    x, y = np.triu_indices(size, 1)
    words = bits.view(np.uint64)
    for at in range(0, len(starts), max(1, PAIRS_AT_ONCE // len(x))):
        first = starts[at : at + max(1, PAIRS_AT_ONCE // len(x))][:, None]
        left, right = (first + x).ravel(), (first + y).ravel()
        keep = (component[left] != component[right]) & _possible(n[left], n[right], limit)
        left, right = left[keep], right[keep]
        apart = np.bitwise_count(words[left] ^ words[right]).sum(1, dtype=np.int64)
        keep = apart * (limit.den + limit.num) <= (n[left] + n[right]) * (limit.den - limit.num)
        yield left[keep], right[keep]


def nearest_alone(x: np.ndarray, y: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of places, for each place on either side the pair with the nearest signature."""
    words, keep = bits.view(np.uint64), np.zeros(len(x), bool)
    apart = np.concatenate([np.zeros(0, np.int64)] + [np.bitwise_count(words[x[at : at + PAIRS_AT_ONCE]] ^ words[y[at : at + PAIRS_AT_ONCE]]).sum(1, dtype=np.int64) for at in range(0, len(x), PAIRS_AT_ONCE)])
    for side in (x, y):
        order = np.lexsort((apart, side))
        keep[order[np.diff(side[order], prepend=-1) != 0]] = True
    return x[keep], y[keep]


def _across(postings: DataFrame, limit: Threshold, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) that share a shingle across components and may be similar, from rows of
    shingle, members, rep, n, component, bits; a shingle's classes meet in pairs of blocks of about BLOCK_ROWS.
    With nearest, each class brings one pair per shingle and block.
    """
    blocks = F.ceil(F.col("members") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.least(b, F.col("block")).alias("low"), F.greatest(b, F.col("block")).alias("high")))
    dealt = postings.withColumn("block", own).withColumn("pair", F.explode(pairs))
    columns = ["shingle", "pair.low", "pair.high", "block", "rep", "n", "component", "bits"]
    dealt = dealt.select(*columns).repartition("shingle", "low", "high").sortWithinPartitions("shingle", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        waiting: list[pa.RecordBatch] = []

        def pairs_of(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            shingle, low, high, block, rep, n, component = (rows.column(i).to_numpy() for i in range(7))
            bits = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.uint8).reshape(len(rep), SIGNATURE_BITS // 8)
            edge = np.flatnonzero(np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True]]))
            starts, sizes = edge[:-1], np.diff(edge)
            few = (sizes <= FEW) & (low[starts] == high[starts])
            found = [np.zeros((2, 0), np.int64)]
            for size in np.unique(sizes[few & (sizes > 1)]):
                found += compared_few(n, component, bits, starts[few & (sizes == size)], int(size), limit)
            for a, b in zip(starts[~few], (starts + sizes)[~few]):
                place = np.arange(a, b)
                left = place[block[a:b] == low[a]]
                right = left if low[a] == high[a] else place[block[a:b] == high[a]]
                if len(left) and len(right):
                    found.append(compared(n, component, bits, left, right, limit))
            x, y = np.concatenate(found, axis=1)
            if nearest:
                x, y = nearest_alone(x, y, bits)
            return np.unique(np.stack([np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])], 1), axis=0).T

        def out(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            a, b = pairs_of(pa.Table.from_batches(rows).combine_chunks().to_batches()[0])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                # A pair of blocks may go on in the next part, so its rows wait.
                keys = [part.column(i).to_numpy() for i in range(3)]
                last = np.flatnonzero((keys[0] != keys[0][-1]) | (keys[1] != keys[1][-1]) | (keys[2] != keys[2][-1]))
                cut = int(last[-1]) + 1 if len(last) else 0
                first = [waiting[0].column(i)[0].as_py() for i in range(3)] if waiting else None
                if waiting and (cut or first != [k[0] for k in keys]):
                    yield out([*waiting, part.slice(0, cut)] if cut else waiting)
                    waiting = []
                elif cut:
                    yield out([part.slice(0, cut)])
                waiting.append(part.slice(cut))
        if waiting:
            yield out(waiting)

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) of classes whose prefixes meet under the other two orders and whose sets are similar."""
    side = lambda s: sets.select(F.col("rep").alias(s), F.struct("grams", "second", "third").alias(f"of_{s}"))
    both = F.size(F.array_intersect("of_a.grams", "of_b.grams"))
    meet = F.arrays_overlap("of_a.second", "of_b.second") & F.arrays_overlap("of_a.third", "of_b.third")
    similar = limit.den * both >= limit.num * (F.size("of_a.grams") + F.size("of_b.grams") - both)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(F.when(meet, similar).otherwise(False)).select("a", "b")


def jaccard_components(docs: DataFrame, *, words: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of shingles have a Jaccard similarity of num/den and more.

    Returns id_col (as long), n_shingles and component_id, the smallest id reachable by links, one row per row of
    docs with an id. Words are runs of other characters than space and 0x09-0x0D, with A-Z lower-cased; shingles are
    compared by 64-bit hashes. Texts without words, null ones included, are linked with nothing. Rows
    without an id are left out; rows of equal ids get the smallest component of any of their texts. Other
    columns are left out.
    """
    limit = Threshold(num, den)
    size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    expected = min(size[0] * SMALL_SET + 2 * (den - num) * size[1] // (6 * den), size[1] // 3 + size[0])
    met = staged(_collect(docs, words, limit, max(16, -(-expected // BUCKET_SHINGLES)), id_col, text_col), "shingles")
    every = met.where("kind = 'doc'").select(F.col("a").alias("id"), F.col("b").alias("class"), F.col("c").alias("n"), F.col("d").alias("first"), F.col("e").alias("prefix"))
    classes = every.where("n > 0").groupBy("class").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "first", "prefix")])
    # The shared shingles of each class, the rarest first, as many as its prefix has beyond the unshared ones.
    counted = met.where("kind = 'shingle'").select(F.col("a").alias("shingle"), F.col("b").alias("times"))
    shares = met.where("kind = 'share'").select(F.col("a").alias("shingle"), F.col("b").alias("class")).join(counted, "shingle")
    shared = shares.groupBy("class").agg(F.array_sort(F.collect_set(F.struct("times", "shingle"))).alias("shared")).join(classes, "class")
    left = F.col("prefix") - (F.col("first") - F.size("shared"))
    kept = shared.where(left > 0).select("rep", "n", F.explode(F.slice("shared.shingle", 1, left.cast("int"))).alias("shingle"))
    postings = staged(kept, "postings")
    ends = postings.groupBy("shingle").agg(F.min(F.struct("rep", "n")).alias("low"), F.max(F.struct("rep", "n")).alias("high")).where("low.rep <> high.rep")
    near = lambda x, y: (F.least(x, y) * den >= F.greatest(x, y) * num)
    met_ends = postings.join(ends, "shingle")
    star = met_ends.select("rep", "n", F.explode(F.array("low", "high")).alias("end")).where(F.col("rep") != F.col("end.rep")).where(near(F.col("n"), F.col("end.n")))
    pairs = star.select(F.least("rep", "end.rep").alias("a"), F.greatest("rep", "end.rep").alias("b")).distinct()
    sets = _sets(docs, met_ends.select("rep").distinct(), words, limit, id_col, text_col)
    # Of an id that is repeated with another text, the class's text is meant.
    sets = staged(sets.join(classes.select("rep", "n"), "rep").where(F.size("grams") == F.col("n")).drop("n"), "sets")
    links = staged(_linked(pairs, sets, limit), "star-links")
    found = components(links)
    # Where a shingle's classes are of several components, compare across them: first each with its nearest, which makes
    # one component of most families of near copies, then all pairs that are still across.
    for nearest in (*[True] * NEAREST_ROUNDS, False):
        labelled = postings.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        open_ = labelled.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members")).where("x <> y").select("shingle", "members")
        more = staged(_across(labelled.join(open_, "shingle").join(sets.select("rep", "bits"), "rep"), limit, nearest), "pairs-across")
        fresh = staged(_linked(more, sets, limit), "links-across")
        if not fresh.isEmpty():
            links = links.union(fresh)
            found = components(links)
    by_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("class", F.coalesce("component", "rep").alias("component"))
    rows = staged(every.join(by_class, "class", "left").select("id", "n", F.coalesce("component", "id").alias("component")), "components")
    # Rows of an id that is repeated with other texts join the components of these texts.
    several = rows.groupBy("id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    bridges = staged(rows.join(several, "id").select(F.col("component").alias("a"), F.col("low").alias("b")).distinct(), "bridges")
    if not bridges.isEmpty():
        joined = components(bridges).select(F.col("node").alias("component"), F.col("component").alias("least"))
        rows = rows.join(joined, "component", "left").select("id", "n", F.coalesce("least", "component").alias("component"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, of each component the one of the smallest id alone (null is the greatest).

    Rows are told apart by id and text, so each row of a null or repeated id is judged by its own text. Rows equal in both
    are copies, of which one stays. Texts without words have no copies, and all stay.
    """
    keyed = docs.withColumn(KEY, row_key(id_col, text_col))
    found = jaccard_components(keyed.select(KEY, text_col), id_col=KEY, text_col=text_col, **options).where("n_shingles > 0")
    times = staged(found.groupBy(KEY).agg(F.first("component_id").alias("component"), F.count("*").alias("times")), "keys")
    named = keyed.select(F.col(id_col).alias("id"), KEY).distinct().join(times, KEY)
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", KEY)).alias("first"))
    copies = staged(times.join(first, "component").where(F.col(KEY) != F.col(f"first.{KEY}")).select(KEY), "copies")
    kept = with_ids(keyed, copies, KEY, "left_anti")
    again = staged(times.where("times > 1").join(copies, KEY, "left_anti").select(KEY), "repeated-rows")
    if again.isEmpty():
        return kept.drop(KEY)
    once = with_ids(kept, again, KEY, "left_semi").dropDuplicates([KEY])
    return with_ids(kept, again, KEY, "left_anti").unionByName(once).drop(KEY)
