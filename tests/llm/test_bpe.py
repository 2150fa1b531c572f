import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from marquee.llm.bpe import ByteBpe, bpe_tokens, merged, parse_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        content = f.read()
    return ByteBpe(content, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=parse_ranks(content), special_tokens={})


def test_random_texts_as_the_library(both):
    own, library = both
    rng = random.Random(8)
    alphabet = " \n\t\r\xa0\u3000\x1c\x1f\x85\x00'sdaAZz0９٣éß漢字😀.,!?-_\u0301\u200d"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 15))) for _ in range(3000)] + [" a", "a ", "  a  b", "\u0130" * 70]
    for text, packed in zip(texts, own.packed_all(texts)):
        assert [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)] == library.encode_ordinary(text), repr(text)


def test_one_tree_and_many_give_the_same(both):
    own, _ = both
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeéon", k=rng.randint(1, 60))) for _ in range(300)]
    own.learn([w for w in words if len(w.encode()) <= 64])
    assert all(own.words.get(w) == b"".join(i.to_bytes(4, "little") for i in merged(w.encode(), own.ranks)) for w in words if len(w.encode()) <= 64)


def test_documents_and_odd_rows(both, sample, documents, odd):
    for docs in (sample("documents"), documents(odd)):
        rows = docs.select("doc_id", "text").collect()
        want = []
        for r in rows:
            ids = both[1].encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_tokens(docs, PATH, PATTERN).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty(documents):
    assert bpe_tokens(documents([]), PATH, PATTERN).collect() == []
