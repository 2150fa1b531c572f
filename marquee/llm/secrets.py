"""Secret scan (operator 9): fixed rules, and Markov models of characters for what the rules don't name.

Candidates are maximal runs of 16 and more characters of base64 and identifiers. Two first-order Markov
models, of random strings and of ordinary words and identifiers, are compared by their log-likelihood
ratio. They are counted in all documents: what the rules match is random, the other runs of 8 and more
characters are ordinary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import TEXTS_AT_ONCE, filled, give_back, parts_of

# The rules, the order of kinds, the characters of candidates.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

CANDIDATE_LEAST = 16
ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
RATIO_LEAST = 8.0  # log-likelihood ratio from which a candidate counts as random
REPLACEMENT = "[secret]"

_PLACE = {c: i + 1 for i, c in enumerate(ALPHABET)}  # 0 is the beginning
_IN_ALPHABET = np.zeros(256, bool)
_IN_ALPHABET[list(ALPHABET.encode())] = True


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def text_of(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def long_runs(column: pa.Array) -> dict[int, list[tuple[int, int]]]:
    """Positions of the texts of a batch that hold candidates, with the bytes of each candidate."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    found: dict[int, list[tuple[int, int]]] = {}
    data = column.buffers()[2]
    if data is None:
        return found
    data = np.frombuffer(data, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), "right")) - 1)
        inside = np.zeros(offsets[to] - offsets[at] + (to - at) + 1, bool)  # a gap behind each text
        of_text = offsets[at : to + 1] - offsets[at] + np.arange(to - at + 1)
        gap = np.ones(len(inside), bool)
        gap[of_text[1:] - 1] = gap[-1] = False
        inside[gap] = _IN_ALPHABET[data[offsets[at] : offsets[to]]]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= CANDIDATE_LEAST
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            k = int(np.searchsorted(of_text, a, "right")) - 1
            found.setdefault(at + k, []).append((a - int(of_text[k]), b - int(of_text[k])))
        at = to
    return found


def runs_in(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Bytes of a text as code points."""
    if text.isascii():
        return places
    data = text.encode()
    out, at, chars = [], 0, 0
    for a, b in places:
        chars += len(data[at:a].decode())
        out.append((chars, chars + b - a))
        at, chars = b, chars + b - a
    return out


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """What the fixed rules find; access keys and hex lie within long runs."""
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    for kind, rule in ((1, ACCESS), (2, HEX)):
        spans += [Span(m.start(), kind, m.end()) for a, b in runs for m in rule.finditer(text, a, b)]
    return sorted(spans)


class CharModels:
    """Counts of character transitions in random and in ordinary strings, each plus one."""

    def __init__(self, counts: np.ndarray):
        chances = (counts + 1.0) / (counts + 1.0).sum(axis=2, keepdims=True)
        self.ratio = np.log(chances[0]) - np.log(chances[1])

    def __call__(self, string: str) -> float:
        places = [0, *map(_PLACE.__getitem__, string)]
        return float(self.ratio[places[:-1], places[1:]].sum())


_PLACE_OF_BYTE = np.zeros(256, np.int64)  # of other bytes 0
_PLACE_OF_BYTE[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
_OTHER = re.compile(r"[^A-Za-z0-9+/_=\n-]")


def added(counts: np.ndarray, strings: list[str]) -> None:
    """Count the transitions of all strings, without characters outside the alphabet."""
    if strings:
        places = _PLACE_OF_BYTE[np.frombuffer(_OTHER.sub("", "\n".join(["", *strings])).encode(), np.uint8)]
        counts += np.bincount((places[:-1] * len(counts) + places[1:])[places[1:] > 0], minlength=counts.size).reshape(counts.shape)


def ordinary_runs(text: str, spans: list[Span]) -> list[str]:
    """Runs of 8 and more characters that no span, in order of their starts, overlaps."""
    if not spans:
        return ORDINARY.findall(text)
    out, k, reach = [], 0, 0
    for m in ORDINARY.finditer(text):
        while k < len(spans) and spans[k].start < m.end():
            reach, k = max(reach, spans[k].end), k + 1
        if reach <= m.start():
            out.append(m[0])
    return out


def train_char_models(docs: DataFrame, *, text_col: str = "text") -> CharModels:
    """Count the two models in all rows of docs; copies of a text count as often as they occur.

    Without any labelled string both models are uniform, and no candidate is random.
    """
    n = len(ALPHABET) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, n, n), np.int64)
        for batch in parts_of(batches):
            column = filled(batch.column(0))
            runs = long_runs(column)
            for k, text in enumerate(column.to_pylist()):
                spans = base_spans(text, runs_in(text, runs.get(k, [])))
                added(counts[0], [text[s.start : s.end] if s.kind else ASSIGN.match(text, s.start)[1] for s in spans])
                added(counts[1], ordinary_runs(text, spans))
        places = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(counts.ravel()[places])], names=["place", "n"])

    counts = np.zeros(2 * n * n, np.int64)
    for place, total in docs.select(text_col).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n")).collect():
        counts[place] = total
    return CharModels(counts.reshape(2, n, n))


def all_spans(text: str, runs: list[tuple[int, int]], models: CharModels, ratio_least: float) -> tuple[list[Span], list[Span]]:
    base = base_spans(text, runs)
    more = [
        Span(a, 3, b)
        for a, b in runs
        if not any(s.start < b and a < s.end for s in base) and models(text[a:b]) >= ratio_least
    ]
    return base, sorted(base + more)


def secret_spans(docs: DataFrame, models: CharModels, *, id_col: str = "doc_id", text_col: str = "text", ratio_least: float = RATIO_LEAST) -> DataFrame:
    """All secrets of every whole text, one row per row of docs.

    Returns id_col, n_assign, n_access, n_hex, n_random, base_sha256 (of the fixed rules' spans) and spans, as
    kind:start:end in code points, by start and kind. Null and empty texts have none; null or repeated ids
    are kept; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            column = filled(batch.column(1))
            runs = long_runs(column)
            numbers, base_hash, spans = [], [], []
            for k, text in enumerate(column.to_pylist()):
                base, every = all_spans(text, runs_in(text, runs.get(k, [])), models, ratio_least)
                numbers.append([sum(s.kind == i for s in every) for i in range(len(KINDS))])
                base_hash.append(hashlib.sha256(text_of(base).encode()).hexdigest())
                spans.append(text_of(every))
            counts = np.array(numbers, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[:, i]) for i in range(len(KINDS))], pa.array(base_hash, pa.string()), pa.array(spans, pa.string())],
                names=[id_col, *[f"n_{name}" for name in KINDS], "base_sha256", "spans"],
            )

    numbers = ", ".join(f"n_{name} long" for name in KINDS)
    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, {numbers}, base_sha256 string, spans string")


def without_secrets(docs: DataFrame, models: CharModels, *, text_col: str = "text", ratio_least: float = RATIO_LEAST) -> DataFrame:
    """The rows of docs with every secret replaced; a null text stays null, other columns as they are.

    Overlapping spans are replaced as one.
    """
    def clean(text: str, runs: list[tuple[int, int]]) -> str:
        out, done = [], 0
        for span in all_spans(text, runs_in(text, runs), models, ratio_least)[1]:
            if span.start >= done:
                out += [text[done : span.start], REPLACEMENT]
            done = max(done, span.end)
        return "".join(out) + text[done:]

    def replace(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        for column in columns:
            out = []
            for at in range(0, len(column), TEXTS_AT_ONCE):
                some = column[at : at + TEXTS_AT_ONCE]
                runs = long_runs(filled(some))
                out.append(pa.array([text and clean(text, runs.get(k, [])) for k, text in enumerate(some.to_pylist())], pa.string()))
            yield pa.concat_arrays([pa.array([], pa.string()), *out])
            give_back()

    replace.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(text_col, F.arrow_udf(replace, "string")(text_col))
