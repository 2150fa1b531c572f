"""Removal of repeated passages (operator 12) by prefix-partitioned suffix trees.

Suffixes begin at every word with a whole window behind it. They are split by prefixes of variable length: a
suffix belongs to the shortest of its prefixes of PREFIX_WORDS words whose bin of prefixes is small enough, so that a
group of suffixes fits a task's memory. One pass over the corpus for each length counts the bins, the later ones only
below bins that were too full. Windows that are still too frequent as a whole are repeats for sure; their
suffixes go nowhere. Every group's suffixes are sorted into a tree, whose nodes are told by hashes of the words on
their path. The leaves below an inner node of the window's depth begin a repeated window; runs of such leaves
are the maximal repeats of a text, and what they cover is removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import parts_of, staged
from marquee.llm.words import SEPARATORS, Splitter, Words, grams, mixed

WINDOW = 35
PREFIX_WORDS = (2, 6, 16)  # and the window
UPPER_WORDS, UPPER_BITS = 12, 16  # the tree's upper nodes; the others are the windows
GROUP_SUFFIXES = 1_000_000
FLUSH_WORDS = 1_000_000
ADDED_AT_ONCE = 1024  # sums of tasks, in each of two steps
WORD_BYTES = 6  # of a usual word, to choose the number of bins


class Plan(NamedTuple):
    """How suffixes are dealt to groups; sizes are bounded by the limits of `planned`."""

    window: int
    bits: int  # of the number of a bin of prefixes
    groups: int
    full: tuple  # bins of each length, sorted, that are too full
    everywhere: np.ndarray  # hashes of windows that are too frequent for a group

    def lengths(self) -> list[int]:
        return [*[n for n in PREFIX_WORDS if n < self.window], self.window]


def member(of: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def splitter() -> Splitter:
    """Words with their case."""
    split = Splitter()
    split.fold = np.arange(256, dtype=np.uint8)
    split.fold[0] = 255  # which no UTF-8 has, as 0 stands for what parts words
    split.fold[SEPARATORS] = 0
    return split


def window_starts(words: Words, window: int) -> np.ndarray:
    """Words of the chunk that a whole window of their text begins with."""
    room = np.repeat(words.offsets[1:], np.diff(words.offsets)) - np.arange(len(words.hashes))
    return np.flatnonzero(room >= window)


def bins_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def descend(words: Words, plan: Plan, depth: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Starts whose prefixes of the first `depth` lengths all lie in full bins, with the others: (starts, group) by length."""
    starts, settled = window_starts(words, plan.window), []
    for level, n in enumerate(plan.lengths()[:depth]):
        if not len(starts):
            break
        bins = bins_of(grams(words.hashes, n)[starts], plan.bits)
        on = member(plan.full[level], bins)
        number = mixed((bins[~on] + (level << plan.bits)).astype(np.uint64)) % np.uint64(plan.groups)
        settled.append((starts[~on], number.astype(np.int64)))
        starts = starts[on]
    return starts, settled


def count_bins(texts: DataFrame, plan: Plan) -> DataFrame:
    """Suffixes in each bin of the next length, below the full bins of the earlier ones: bin, n. No more rows than bins."""
    depth, size = len(plan.full), 1 << plan.bits

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = splitter(), np.zeros(size, np.int64)
        for batch in parts_of(batches):
            for words in split.chunks(batch.column(0)):
                starts, _ = descend(words, plan, depth)
                if len(starts):
                    counts += np.bincount(bins_of(grams(words.hashes, plan.lengths()[depth])[starts], plan.bits), minlength=size)
        step, rows = 1 << 12, []
        for at in range(0, size, step):
            met = np.flatnonzero(counts[at : at + step])
            if len(met):
                rows.append((at, (met + at).astype("<u4").tobytes(), counts[at + met].astype("<i8").tobytes()))
        if rows:
            part, bins, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(bins, pa.binary()), pa.array(n, pa.binary())], names=["part", "bins", "n"])

    def add(table: pa.Table) -> pa.Table:
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), "<u4").astype(np.int64)
        n = np.frombuffer(b"".join(table.column("n").to_pylist()), "<i8")
        first = int(bins.min())
        total = np.zeros(int(bins.max()) - first + 1, np.int64)
        np.add.at(total, bins - first, n)
        return pa.table({"bin": np.flatnonzero(total) + first, "n": total[total > 0]})

    def some(table: pa.Table) -> pa.Table:
        total = add(table)
        row = [table.column("part")[0].as_py(), total.column("bin").to_numpy().astype("<u4").tobytes(), total.column("n").to_numpy().astype("<i8").tobytes()]
        return pa.table({c: pa.array([v]) for c, v in zip(("part", "bins", "n"), row)})

    packed = "part long, bins binary, n binary"
    # In two steps, so that no group holds a row of every task.
    counted = texts.select("body").mapInArrow(scan, packed).groupBy("part", F.pmod(F.spark_partition_id(), F.lit(ADDED_AT_ONCE)).alias("some"))
    return counted.applyInArrow(some, packed).groupBy("part").applyInArrow(add, "bin long, n long")


def frequent_windows(texts: DataFrame, plan: Plan, most: int) -> DataFrame:
    """Hashes of the windows below full bins of every length that occur more than `most` times."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in parts_of(batches):
            for words in split.chunks(batch.column(0)):
                starts, _ = descend(words, plan, len(plan.full))
                found, n = np.unique(grams(words.hashes, plan.window)[starts] if len(starts) else words.hashes[:0], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["hash", "n"])

    counted = texts.select("body").mapInArrow(scan, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") > most).select("hash")


def planned(texts: DataFrame, window: int, group_suffixes: int) -> Plan:
    """Prefix lengths are tried until no bin is too full, or the prefix is the window.

    Bins are numbered in 12 to 20 bits, by the size of the corpus. Full is what has more suffixes than half a group,
    or than four average bins if that is more; so the driver and the workers hold at most 2**18 full bins
    of a length and as many frequent windows.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    wanted = size / WORD_BYTES / (group_suffixes / 32)
    plan = Plan(window, int(np.clip(np.ceil(np.log2(max(2.0, wanted))), 12, 20)), 1, (), np.zeros(0, np.uint64))
    most = None
    for _ in plan.lengths():
        counted = staged(count_bins(texts, plan), "prefix-bins")
        if most is None:
            total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            most = max(group_suffixes // 2, 4 * total >> plan.bits)
            plan = plan._replace(groups=max(1, int(-(-total // max(group_suffixes, most)))))
        full = np.sort(np.array([r[0] for r in counted.where(F.col("n") > most).select("bin").collect()], np.int64))
        if not len(full):
            return plan
        plan = plan._replace(full=(*plan.full, full))
    found = np.array([r[0] for r in frequent_windows(texts, plan, most).collect()], np.int64).view(np.uint64)
    return plan._replace(everywhere=np.sort(found))


class Tree(NamedTuple):
    """A group's suffixes in the order of the tree, and how deep each is joined with the one before: in no node, an upper node, a window."""

    order: np.ndarray
    joined: np.ndarray

    @classmethod
    def of(cls, paths: np.ndarray) -> Tree:
        order = np.argsort(paths, kind="stable")
        paths = paths[order]
        joined = np.zeros(len(paths), np.int8)
        joined[1:] = (paths[1:] >> np.uint64(64 - UPPER_BITS) == paths[:-1] >> np.uint64(64 - UPPER_BITS)).astype(np.int8) + (paths[1:] == paths[:-1])
        return cls(order, joined)

    def nodes(self, depth: int) -> np.ndarray:
        """First and last place, in order, of each inner node of that depth, which has two leaves or more."""
        inside = self.joined >= depth
        edge = np.flatnonzero(~inside)
        last = np.append(edge, len(inside))[1:] - 1
        return np.stack([edge, last], 1)[last > edge]

    def leaves_below(self, depth: int) -> np.ndarray:
        """Whether each suffix is below an inner node of that depth."""
        below = np.zeros(len(self.order) + 1, np.int64)
        nodes = self.nodes(depth)
        below[nodes[:, 0]] += 1
        below[nodes[:, 1] + 1] -= 1
        out = np.zeros(len(self.order), bool)
        out[self.order] = np.cumsum(below[:-1]) > 0
        return out


UPPER_DEPTH, WINDOW_DEPTH = 1, 2


def path_of(words: Words, starts: np.ndarray, window: int) -> np.ndarray:
    """The path of a suffix: of the upper node, then of the window."""
    upper = grams(words.hashes, min(UPPER_WORDS, window))[starts] >> np.uint64(64 - UPPER_BITS) << np.uint64(64 - UPPER_BITS)
    return upper | grams(words.hashes, window)[starts] >> np.uint64(UPPER_BITS)


def suffixes(texts: DataFrame, plan: Plan) -> DataFrame:
    """Packed suffixes by group, and beside them the layout of the texts that they are of.

    A portion of a task's texts numbers its words. kind suffix: group, portion, paths and numbers; kind mark: numbers of
    words that begin a repeat for sure; kind text: the texts' two hashes and how many words they have. A portion's
    name follows from its texts, so that it is the same when a lost task is run again.
    """
    schema = "group long, kind string, portion long, n long, data binary"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, task, portions = splitter(), TaskContext.get().partitionId(), 0
        texts_met: list[np.ndarray] = []
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        marks: list[np.ndarray] = []
        n_words = 0

        def flushed() -> pa.RecordBatch:
            layout = np.concatenate(texts_met, axis=1)
            seed = np.array([(task << 32) + portions], np.uint64)
            with np.errstate(over="ignore"):
                places = np.arange(layout.shape[1], dtype=np.uint64)
                portion = int(mixed(seed + mixed(layout[0].view(np.uint64) + places).sum(dtype=np.uint64)).view(np.int64)[0])
            rows = [(portion % plan.groups, "text", portion, layout.shape[1], layout.astype("<i8").tobytes())]
            sure = np.concatenate([np.zeros(0, np.int64), *marks])
            if len(sure):
                rows.append((portion % plan.groups, "mark", portion, len(sure), sure.astype("<u4").tobytes()))
            group, path, number = (np.concatenate(c) for c in zip(*kept)) if kept else [np.zeros(0, np.int64)] * 3
            order = np.argsort(group, kind="stable")
            group, path, number = group[order], path[order].astype("<u8"), number[order].astype("<u4")
            edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
            for a, b in zip(edges[:-1], edges[1:]):
                rows.append((int(group[a]), "suffix", portion, int(b - a), path[a:b].tobytes() + number[a:b].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["group", "kind", "portion", "n", "data"])

        for batch in parts_of(batches):
            for words in split.chunks(batch.column(0)):
                size = np.diff(words.offsets)
                hashes = [batch.column(c)[words.first : words.first + len(size)].to_numpy() for c in (1, 2)]
                texts_met.append(np.stack([*hashes, size]))
                left, settled = descend(words, plan, len(plan.full))
                if len(left):
                    whole = grams(words.hashes, plan.window)[left] if plan.full else None
                    if len(plan.full) == len(plan.lengths()):
                        sure = member(plan.everywhere, whole)
                        marks.append(left[sure] + n_words)
                        left, whole = left[~sure], whole[~sure]
                        settled.append((left, (mixed(whole) % np.uint64(plan.groups)).astype(np.int64)))
                    else:
                        n = plan.lengths()[len(plan.full)]
                        bins = bins_of(grams(words.hashes, n)[left], plan.bits)
                        number = mixed((bins + (len(plan.full) << plan.bits)).astype(np.uint64)) % np.uint64(plan.groups)
                        settled.append((left, number.astype(np.int64)))
                for starts, group in settled:
                    if len(starts):
                        kept.append((group, path_of(words, starts, plan.window), starts + n_words))
                n_words += len(words.hashes)
                if n_words >= FLUSH_WORDS:
                    yield flushed()
                    texts_met, kept, marks, n_words, portions = [], [], [], 0, portions + 1
        if texts_met:
            yield flushed()

    return texts.select("body", "h1", "h2").mapInArrow(scan, schema)


def repeated(packets: DataFrame) -> DataFrame:
    """The numbers of words of each portion that begin a repeat, from the tree of each group; layouts pass."""

    def mark(table: pa.Table) -> pa.Table:
        kinds, portions, sizes = (np.array(table.column(c).to_pylist()) for c in ("kind", "portion", "n"))
        data = table.column("data")
        own = np.flatnonzero(kinds == "suffix")
        passed = np.flatnonzero(kinds != "suffix")
        rows = [(str(kinds[i]), int(portions[i]), int(sizes[i]), data[int(i)].as_py()) for i in passed]
        paths = [np.frombuffer(data[int(i)].as_buffer(), "<u8", sizes[i]) for i in own]
        tree = Tree.of(np.concatenate([np.zeros(0, np.uint64), *paths]))
        below = tree.leaves_below(WINDOW_DEPTH)
        at = 0
        for i in own:
            n = int(sizes[i])
            hit = below[at : at + n]
            at += n
            if hit.any():
                number = np.frombuffer(data[int(i)].as_buffer(), "<u4", n, 8 * n)[hit]
                rows.append(("mark", int(portions[i]), len(number), number.tobytes()))
        columns = zip(*rows) if rows else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int64(), pa.int64(), pa.binary()])], names=["kind", "portion", "n", "data"])

    return packets.groupBy("group").applyInArrow(mark, "kind string, portion long, n long, data binary")


def covered(marks: DataFrame, window: int) -> DataFrame:
    """The maximal repeats of each text that has any: h1, h2, ranges (first word and end, packed)."""

    def join(table: pa.Table) -> pa.Table:
        layout, numbers = [], [np.zeros(0, "<u4")]
        for kind, n, data in zip(table.column("kind").to_pylist(), table.column("n").to_pylist(), table.column("data").to_pylist()):
            if kind == "text":
                layout.append(np.frombuffer(data, "<i8").reshape(3, n))
            else:
                numbers.append(np.frombuffer(data, "<u4"))
        starts = np.unique(np.concatenate(numbers)).astype(np.int64)
        if len(layout) != 1:
            raise RuntimeError("a task that was run again met its texts in another order; write them to a table first")
        h1, h2, size = layout[0]
        offsets = np.concatenate([[0], np.cumsum(size)])
        text = np.searchsorted(offsets, starts, "right") - 1
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (np.diff(starts) > window) | (np.diff(text) > 0)
        edge = np.flatnonzero(fresh)
        last = np.append(edge[1:], len(starts)) - 1
        owner = text[edge]
        spans = np.stack([starts[edge], starts[last] + window], 1) - offsets[owner][:, None] if len(edge) else np.zeros((0, 2), np.int64)
        cut = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        packed = [spans[a:b].astype("<i8").tobytes() for a, b in zip(cut[:-1], cut[1:])]
        of = owner[cut[:-1]]
        return pa.table({"h1": pa.array(h1[of], pa.int64()), "h2": pa.array(h2[of], pa.int64()), "ranges": pa.array(packed, pa.binary())})

    return marks.groupBy("portion").applyInArrow(join, "h1 long, h2 long, ranges binary").dropDuplicates(["h1", "h2"])


def without_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """Every whole text without the words that a repeated window covers: id_col, n_words, n_removed, kept, repeats.

    A window is as many consecutive words as `window` says; it is repeated if its words also begin elsewhere, in another text
    or in the same, overlapping or not. All its occurrences go, also the first. Words are runs of other characters than space and
    0x09-0x0D, with their case. kept are the words that are left, joined by one space; repeats says first word and end of
    each maximal repeat. Null, empty and short texts have no window. One row per row of docs; null and repeated ids are
    kept; equal texts are repeats of each other; other columns are left out. Windows are compared by hashes of 64 bits, in
    which those that agree in their first UPPER_WORDS words are told apart by 48, and by their group. docs must
    give its rows in the same order when a lost task is run again, as a scan of files does.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), body.alias("body")).withColumns({"h1": F.xxhash64("body"), "h2": F.xxhash64(F.lit(1), "body")})
    plan = planned(texts, window, group_suffixes)
    marks = staged(repeated(suffixes(texts, plan)), "repeats")
    found = staged(covered(marks, window), "repeated-ranges")
    met = texts.join(found, ["h1", "h2"], "left").select("id", "body", "ranges")
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            n_words, n_removed, kept, repeats = [], [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()  # at the bytes that part words, and no others
                spans = np.frombuffer(ranges.as_py() or b"", "<i8").reshape(-1, 2).tolist()
                left, at = [], 0
                for a, b in spans:
                    left += words[at:a]
                    at = b
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                repeats.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(repeats, pa.list_(span))],
                names=[id_col, "n_words", "n_removed", "kept", "repeats"],
            )

    return met.mapInArrow(finish, f"`{id_col}` {kind}, n_words long, n_removed long, kept string, repeats array<struct<start: long, end: long>>")
