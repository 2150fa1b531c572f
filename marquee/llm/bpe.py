"""Byte-level BPE encoding and decoding (operator 8).

Merges of a piece run on a segment tree over its byte positions. A leaf holds the rank of the pair that
begins there, with its position, so that the root is the leftmost pair of the lowest rank; a merge
updates three leaves, each in logarithmic time, and links the live neighbours anew. A piece that is
itself in the vocabulary is one token, as in the public tiktoken library.

Texts are cut before a single space between other characters. The splitting pattern never looks across
such a place, so a cut piece of text is encoded once per worker and found again in a bounded table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from marquee.llm.shared import broadcast_file, filled, give_back, worker_state

# The characters with Unicode's White_Space property, which \s stands for in the pattern.
WHITE_SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
KEPT_PIECES = 100_000  # pieces of text that a worker keeps in half a table; when the newer half is full, the older one is emptied
TEXTS_A_STEP = 200  # encoded at once
NONE = 1 << 62
WIDE = 64  # bytes of the longest piece that is merged together with others
TOGETHER = 4096


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: lines of a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece, merging the leftmost pair of lowest rank again and again."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    part = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << (n - 1).bit_length()
    get = ranks.get
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while (best := tree[1]) != NONE:
        i = best & 0xFFFFFFFF
        j = after[i]
        part[i] += part[j]
        part[j] = b""
        after[i] = k = after[j]
        leaf = NONE
        if k < n:
            before[k] = i
            rank = get(part[i] + part[k])
            if rank is not None:
                leaf = rank << 32 | i
        changes = [(j, NONE), (i, leaf)]
        k = before[i]
        if k >= 0:
            rank = get(part[k] + part[i])
            changes.append((k, NONE if rank is None else rank << 32 | k))
        for k, leaf in changes:
            k += size
            while tree[k] != leaf:  # a parent that stays as it is ends the update
                tree[k] = leaf
                if k == 1:
                    break
                other = tree[k ^ 1]
                if other < leaf:
                    leaf = other
                k >>= 1
    return [ranks[p] for p in part if p]


class Pairs:
    """The ranks of all pairs of tokens that merge to a token, by a sorted array of the pairs' keys."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        self.keys, self.ranks = np.array([*sorted(found), (NONE, NONE)], np.int64).T.copy()
        self.of_byte = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)
        self.bytes_known = all(bytes([b]) in ranks for b in range(256))

    def look(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank of each pair with its place in the low bits, or NONE."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at] << 8 | place, NONE)


def merged_together(words: list[bytes], pairs: Pairs) -> list[bytes]:
    """Packed ids of many pieces of at most WIDE bytes: their segment trees are rows of one array.

    Every step merges the best pair of each piece that still has one, with the same three updates of
    leaves as in `merged`.
    """
    count, width = len(words), 1 << (max(map(len, words)) - 1).bit_length()
    length = np.fromiter(map(len, words), np.int64, count)
    token = np.zeros((count, width + 1), np.int64)
    inside = np.arange(width + 1) < length[:, None]
    token[inside] = pairs.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.broadcast_to(np.arange(1, width + 2), token.shape).copy()
    before = after - 2
    tree = np.full((count, 2 * width), NONE, np.int64)
    row, place = np.nonzero(inside[:, 1:])
    tree[row, width + place] = pairs.look(token[row, place], token[row, place + 1], place)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(row: np.ndarray, place: np.ndarray, value: np.ndarray | int) -> None:
        node = width + place
        tree[row, node] = value
        node >>= 1
        while node[0]:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node >>= 1

    row = np.arange(count) if width > 1 else np.zeros(0, np.int64)
    while True:
        best = tree[row, 1]
        row, best = row[best != NONE], best[best != NONE]
        if not len(row):
            break
        i = best & 0xFF
        j = after[row, i]
        token[row, i] = best >> 8
        inside[row, j] = False
        k = after[row, j]
        after[row, i] = k
        more = k < length[row]
        before[row[more], k[more]] = i[more]
        put(row, j, NONE)
        put(row, i, np.where(more, pairs.look(token[row, i], token[row, np.where(more, k, 0)], i), NONE))
        k = before[row, i]
        more = k >= 0
        if more.any():
            r, k, i = row[more], k[more], i[more]
            put(r, k, pairs.look(token[r, k], token[r, i], k))
    packed = token[inside].astype("<u4").tobytes()
    ends = (4 * inside.sum(1).cumsum()).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Kept:
    """A bounded table of the pieces met lately: when the newer half is full, the older half goes."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.new) >= KEPT_PIECES:
            self.old, self.new = self.new, {}

    def get(self, key: str) -> bytes | None:
        known = self.new.get(key)
        if known is None:
            known = self.old.get(key)
            if known is not None:
                self.new[key] = known
        return known

    def put(self, key: str, value: bytes) -> None:
        self.new[key] = value


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = parse_ranks(content)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # A set inside a set, then sets of their own.
        pattern = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\S", f"[^{WHITE_SPACE}]").replace(r"\s", f"[{WHITE_SPACE}]")
        self.pieces = regex.compile(pattern).findall
        self.beside_space = re.compile(r" \s|\s ").search
        self.cut = re.compile(r"(?<=\S)(?= \S)").split
        self.decimals = {rank: str(rank) for rank in self.tokens}
        self.pairs = Pairs(self.ranks)
        self.words, self.cuts = Kept(), Kept()

    def learn(self, words: list[str]) -> None:
        """Encode pieces of the splitting pattern, those of a like length together."""
        by_width: dict[int, list[str]] = {}
        for word in words:
            piece = word.encode()
            if (whole := self.ranks.get(piece)) is not None:
                self.words.put(word, whole.to_bytes(4, "little"))
            elif len(piece) <= WIDE and self.pairs.bytes_known:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(word)
        for group in by_width.values():
            for at in range(0, len(group), TOGETHER):
                some = group[at : at + TOGETHER]
                for word, packed in zip(some, merged_together([w.encode() for w in some], self.pairs)):
                    self.words.put(word, packed)

    def _word(self, word: str) -> bytes:
        known = self.words.get(word)
        return known if known is not None else b"".join([i.to_bytes(4, "little") for i in merged(word.encode(), self.ranks)])

    def cuts_of(self, text: str) -> list[str]:
        if self.beside_space(text) or text[-1:] == " " or "\0" in text:
            return self.cut(text)
        return text.replace(" ", "\0 ").split("\0")

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cuts = [self.cuts_of(text) for text in texts]
        known = self.cuts
        known.turn()
        unknown = set().union(*cuts).difference(known.new)
        pieces = {}
        for cut in unknown:
            if (packed := known.old.get(cut)) is not None:
                known.new[cut] = packed
            else:
                pieces[cut] = self.pieces(cut)
        self.words.turn()
        self.learn([word for word in set().union(*pieces.values()) if self.words.get(word) is None])
        get = known.new
        for cut, words in pieces.items():
            get[cut] = b"".join([self._word(word) for word in words])
        out = [b"".join([get[cut] for cut in of_text]) for of_text in cuts]
        for cut in pieces:
            if len(cut) > 64:
                del get[cut]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return ids_of(self.packed_all([text])[0])


def ids_of(packed: bytes) -> list[int]:
    return list(memoryview(packed).cast("I")) if sys.byteorder == "little" else np.frombuffer(packed, "<u4").tolist()


def bpe_tokens(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, and the round trip.

    Returns id_col, n_tokens, ids (little-endian 32-bit integers), ids_sha256 (of the decimal ids joined by
    one space) and decoded_sha256 (of the bytes decoded from the ids), one row per row of docs. Null and
    empty texts have no ids; null or repeated id_col values are kept as they are; other columns are left
    out, whatever their names. The text of one batch and the bounded tables of the encoder are in memory.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    content = broadcast_file(docs.sparkSession, ranks_path)
    key = f"bpe {hashlib.sha256(content.value + pattern.encode()).hexdigest()}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(keep=key)
        coder = worker_state(key, lambda: ByteBpe(content.value, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_A_STEP):
                part = batch.slice(at, TEXTS_A_STEP)
                packed = coder.packed_all(filled(part.column(1)).to_pylist())
                ids_hash, text_hash, decimals = [], [], coder.decimals
                for ids in map(ids_of, packed):
                    ids_hash.append(hashlib.sha256(" ".join([decimals[i] for i in ids]).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                counts = [len(x) // 4 for x in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                    names=[id_col, "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )
                del packed, part
                give_back(keep=key)

    return docs.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")
