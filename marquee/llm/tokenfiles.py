"""Token ids in binary files (operator 3).

A folder holds one dictionary and many shards. The zstandard dictionary is trained on serialized id arrays
of a bounded sample of documents and shared by all shards. A shard holds consecutive documents in order of
their id, each compressed on its own, so that a short document is read without its neighbours:

    8 bytes   magic
    32 bytes  SHA-256 of the dictionary
    4 bytes   bytes per id (2 or 4)
    4 bytes   reserved
    ...       frames, one per document
    8 x (n+1) offsets of the frames, and their end
    8 x n     ids per document
    ...       the documents' own ids, as an Arrow stream
    8 x 3     place of the offsets, place of the Arrow stream, number of documents

Numbers are little-endian. Shards are written under names of their own for each task attempt; the manifest, a
table in the same folder, names those that count, so a repeated attempt leaves at most an unused file.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.shared import broadcast_file, file_system, filled, worker_state

# Fixed values of the format.
MAGIC = b"TOKSHRD1"
HEADER, FOOTER = 48, 24

SAMPLE_DOCS = 4000  # documents that the dictionary is trained on, at most about so many
SAMPLE_BYTES = 16_384  # only whole documents up to this size are samples: the dictionary serves the short ones
DICTIONARY_BYTES = 65_536
LEVEL = 3
KEPT_WORDS = 300_000
PORTION = 3_000_000  # bytes of text that are encoded at once: the more, the fewer words are looked up again

# The pattern of CLIP's tokenizer, and its normalizers.
CLIP = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CLIP_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
ONE_PIECE = f"^(?:[{LETTERS}]+|[{MARKS}]+)$"


class WordTokenizer:
    """A tokenizer of the tokenizers library that drops white space, met word by word.

    Its splitting pattern and its normalizer never look across ASCII white space, so words between such are
    encoded once and kept in a bounded table. `whole` says whether that does not hold, and texts are encoded
    as they are.

    CLIP's pattern always ends a piece between a letter and an ASCII mark, so there words are parted too. A part of
    common letters or of marks alone is one piece, unchanged but for its case: `pieces`, with the same model, encodes
    those without the normalizer and the pattern.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_buffer(content)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 65_536
        self.type = np.dtype("<u4" if self.wide else "<u2")
        config = json.loads(content)
        self.whole = not self._drops_white_space(config)
        self.pieces = None
        if not self.whole and self._is_like_clip(config):
            self._take_pieces(config)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _drops_white_space(config: dict) -> bool:
        """Whether the first step keeps only matches of a pattern that fits no white space and looks at none."""
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normalizers = (config.get("normalizer") or {}).get("normalizers") or []
        pattern = steps[0].get("pattern", {}).get("Regex", " ").replace(r"[^\s", "[")
        return (
            (steps[0].get("type"), steps[0].get("behavior"), steps[0].get("invert")) == ("Split", "Removed", True)
            and not re.search(r"\\[sSbBAzZ]|[ ^$]|\(\?", pattern)
            and not any(step.get("add_prefix_space") for step in steps)
            and {n["type"] for n in normalizers} <= {"NFC", "NFD", "Lowercase", "Replace"}
            and all(n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normalizers if n["type"] == "Replace")
            and not any(c.isspace() for t in config.get("added_tokens", []) for c in t["content"])
        )

    @staticmethod
    def _is_like_clip(config: dict) -> bool:
        """Whether pattern, normalizers and byte pairs are CLIP's, and no added token fits into a piece."""
        steps = config["pre_tokenizer"]["pretokenizers"]
        added = config.get("added_tokens", [])
        return (
            (steps[0]["pattern"], [step["type"] for step in steps]) == ({"Regex": CLIP}, ["Split", "ByteLevel"])
            and not steps[1].get("use_regex", True)
            and [n["type"] for n in (config.get("normalizer") or {}).get("normalizers") or []] == CLIP_NORMALIZERS
            and (config["model"].get("type"), config["model"].get("end_of_word_suffix")) == ("BPE", "</w>")
            and not any(t.get("normalized") or re.search(ONE_PIECE, t["content"].lower()) for t in added)
        )

    def _take_pieces(self, config: dict) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.last = np.zeros(max(config["model"]["vocab"].values()) + 1, bool)
        self.last[[i for token, i in config["model"]["vocab"].items() if token.endswith("</w>")]] = True
        # Texts that are not parted or lowered: with added tokens, in either case, or with combining marks, as these
        # join some capitals and not their small letters, or the other way round.
        self.guard = "(?i)" + "|".join([*(re.escape(t["content"]) for t in config.get("added_tokens", [])), r"[\x{300}-\x{36f}]"])

    def _parted(self, texts: pa.Array) -> pa.Array:
        """The same ids, with fewer different words: a space between letters and marks, and A-Z lowered."""
        if self.pieces is None:
            return texts
        # In this order: of a slice whose offsets do not begin at 0, ascii_lower takes the wrong bytes.
        parted = pc.ascii_lower(pc.replace_substring_regex(texts, f"([{LETTERS}])([{MARKS}])", r"\1 \2"))
        return pc.if_else(pc.match_substring_regex(texts, self.guard), texts, parted)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces_encoded(self, words: list[str]) -> list[bytes]:
        """Many words of one piece as one text, cut behind the ids that end a piece."""
        out: list[bytes] = []
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(some).lower()], add_special_tokens=False)[0].ids, self.type)
            cuts = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(cuts) == len(some):
                ids, size = ids.tobytes(), self.type.itemsize
                out += [ids[size * a : size * b] for a, b in zip([0, *cuts], cuts)]
            else:
                out += self._encoded(some)
        return out

    def _words_encoded(self, words: list[str]) -> list[bytes]:
        """Many words without the digit 0 as one text, with that digit between them, cut at its id."""
        out: list[bytes] = []
        zero = self.tokenizer.encode("0", add_special_tokens=False).ids
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = np.array(self.tokenizer.encode_batch_fast([" 0 ".join(some)], add_special_tokens=False)[0].ids, self.type)
            cuts = np.flatnonzero(ids == zero[0])
            if len(zero) == 1 and len(cuts) == len(some) - 1:
                ids, size = ids.tobytes(), self.type.itemsize
                out += [ids[size * a : size * b] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])]
            else:
                out += self._encoded(some)
        return out

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of different words, from the table or encoded."""
        if len(self.new) >= KEPT_WORDS:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        unknown = [word for word in words if word not in new]
        new.update((word, old[word]) for word in unknown if word in old)
        unknown = [word for word in unknown if word not in old]
        rest = unknown
        if self.pieces is not None:
            one = pc.match_substring_regex(pa.array(unknown, pa.large_string()), ONE_PIECE).to_numpy(zero_copy_only=False)
            pieces, rest = list(compress(unknown, one)), list(compress(unknown, ~one))
            new.update(zip(pieces, self._pieces_encoded(pieces)))
        plain = [word for word in rest if "0" not in word]
        other = [word for word in rest if "0" in word]
        new.update(zip(plain, self._words_encoded(plain)))
        new.update(zip(other, self._encoded(other)))
        out = [new[word] for word in words]
        for word in unknown:
            if len(word) > 64:
                del new[word]
        return out

    def packed(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, serialized; null counts as empty."""
        texts = filled(texts).cast(pa.large_string())
        if self.whole or not len(texts):
            return self._encoded(texts.to_pylist())
        words = pc.ascii_split_whitespace(self._parted(texts))
        different = words.flatten().dictionary_encode()
        ids = pa.array(self._of_words(different.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(different.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[words.offsets.to_numpy()].tolist()
        ids = (ids.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def portions(batch: pa.RecordBatch, texts: int) -> Iterator[pa.RecordBatch]:
    """All rows, as many at once as have some PORTION bytes of text in the column of that number, but one at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = [0, *(np.flatnonzero(np.diff(ends // PORTION)) + 1).tolist(), batch.num_rows]
    if batch.num_rows:
        yield from (batch.slice(at, end - at) for at, end in zip(starts, starts[1:]))


def train_dictionary(docs: DataFrame, tokenizer, key: str, text_col: str) -> bytes:
    """A dictionary from at most about SAMPLE_DOCS short documents, chosen by a hash; empty if there are too few."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(key, lambda: WordTokenizer(tokenizer.value))
        for batch in batches:
            for part in portions(batch, 0):
                ids = [p for p in coder.packed(part.column(0)) if 0 < len(p) <= SAMPLE_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    # The hashes are even, so a share of their range is as large a share of the texts, at every size.
    chosen = docs.select(text_col).where(F.xxhash64(text_col).cast("double") < F.lit(-(2.0**63) + share * 2.0**64)) if share < 1 else docs.select(text_col)
    different = chosen.mapInArrow(encode, "ids binary").distinct().orderBy(F.xxhash64("ids"), "ids").limit(2 * SAMPLE_DOCS)
    samples = sorted({bytes(row.ids) for row in different.collect()})
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _context(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


class ShardReader:
    """Random access to the documents of a shard through a seekable file."""

    def __init__(self, file, dictionary: bytes):
        size = file.size()
        file.seek(0)
        head = file.read(HEADER)
        if head[:8] != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        self.type = np.dtype({2: "<u2", 4: "<u4"}[int.from_bytes(head[40:44], "little")])
        file.seek(size - FOOTER)
        at, keys_at, n = np.frombuffer(file.read(FOOTER), "<i8").tolist()
        file.seek(at)
        index = np.frombuffer(file.read(8 * (2 * n + 1)), "<i8")
        self.keys = pa.ipc.open_stream(file.read(size - FOOTER - keys_at)).read_all().column(0).combine_chunks()
        self.offsets, self.counts = index[: n + 1], index[n + 1 :]
        self.file, self.unpack = file, zstandard.ZstdDecompressor(dict_data=_context(dictionary))

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, k: int) -> np.ndarray:
        self.file.seek(int(self.offsets[k]))
        frame = self.file.read(int(self.offsets[k + 1] - self.offsets[k]))
        return np.frombuffer(self.unpack.decompress(frame), self.type)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of every whole text in ascending order of id_col, and return the manifest.

    The manifest has a row per shard: shard (position in the order), file, n_docs, n_ids. Every document gets end_id
    at its end. Null texts count as empty; a null id comes first; rows with equal ids are ordered by their
    text. Other columns are left out. An empty table has no shards. A task holds a portion of its texts and an index.
    """
    spark = docs.sparkSession
    tokenizer = broadcast_file(spark, tokenizer_path)
    key = f"tokenizer {hashlib.sha256(tokenizer.value).hexdigest()}"
    dictionary = train_dictionary(docs, tokenizer, key, text_col)
    fs, at = file_system(folder)
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/dictionary") as f:
        f.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = worker_state(key, lambda: WordTokenizer(tokenizer.value))
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_context(dictionary), write_checksum=True)
        end = np.array([end_id], coder.type).tobytes()
        shard, out, name = TaskContext.get().partitionId(), None, f"shard-{uuid4().hex}"
        offsets, counts = [HEADER], []
        keys: list[pa.Array] = []
        for batch in batches:
            for part in portions(batch, 1):
                if out is None:
                    out = file_system(folder)[0].open_output_stream(f"{file_system(folder)[1]}/{name}")
                    out.write(MAGIC + hashlib.sha256(dictionary).digest() + int(coder.type.itemsize).to_bytes(4, "little") + bytes(4))
                keys.append(part.column(0))
                for ids in coder.packed(part.column(1)):
                    frame = pack.compress(ids + end)
                    out.write(frame)
                    offsets.append(offsets[-1] + len(frame))
                    counts.append(len(ids) // coder.type.itemsize + 1)
        if out is None:
            return
        ids = pa.table({"key": pa.chunked_array(keys)}).combine_chunks()
        index, stream = np.array(offsets + counts, "<i8").tobytes(), pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, ids.schema) as writer:
            writer.write_table(ids)
        out.write(index)
        out.write(stream.getvalue())
        out.write(np.array([offsets[-1], offsets[-1] + len(index), len(counts)], "<i8").tobytes())
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(counts)]), pa.array([sum(counts)])],
            names=["shard", "file", "n_docs", "n_ids"],
        )

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body")).repartitionByRange(parts, "key", F.xxhash64("body"))
    rows = ordered.sortWithinPartitions("key", F.xxhash64("body"), "body").mapInArrow(write, "shard int, file string, n_docs long, n_ids long")
    rows.write.parquet(f"{folder}/manifest")
    return spark.read.schema(rows.schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, *, id_col: str = "doc_id", id_type: str = "long") -> DataFrame:
    """Every document of the files: id_col, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ids are little-endian 32-bit integers. The driver sees one number per shard, to sum up the starts.
    """
    before, starts = 0, {}
    for row in manifest.select("shard", "n_ids").orderBy("shard").collect():
        starts[row.shard], before = before, before + row.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(folder)
        with fs.open_input_file(f"{at}/dictionary") as f:
            dictionary = f.read()
        for batch in batches:
            for shard, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{at}/{name}") as file:
                    reader = ShardReader(file, dictionary)
                    ends = starts[shard] + np.cumsum(reader.counts)
                    for k in range(0, len(reader), 500):
                        texts = [reader[i].astype("<u4").tobytes() for i in range(k, min(k + 500, len(reader)))]
                        n = reader.counts[k : k + 500]
                        yield pa.RecordBatch.from_arrays(
                            [
                                reader.keys[k : k + 500],
                                pa.array(ends[k : k + 500] - n),
                                pa.array([len(t) // 4 for t in texts], pa.int64()),
                                pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                                pa.array(texts, pa.binary()),
                            ],
                            names=[id_col, "start", "n_tokens", "ids_crc32", "ids"],
                        )

    files = manifest.select("shard", "file").repartition(max(1, len(starts)), "shard")
    return files.mapInArrow(read, f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long, ids binary")
