import collections
import math
import zlib

from marquee.llm.ngramlm import lm_scores


def model(texts, words):
    counts, pairs = collections.Counter(), collections.Counter()
    for text in texts:
        before = None
        for word in [*words(text), ()]:
            counts[word] += 1
            pairs[before, word] += 1
            before = word

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        if min(n) == 0:
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return [0, *[min(max(d, 0.01 * k), k) for k, d in enumerate(raw, 1)]]

    contexts, kinds = collections.Counter(w for _, w in pairs), collections.defaultdict(list)
    for (u, _), n in pairs.items():
        kinds[u].append(n)
    d, e = discounts(list(pairs.values())), discounts(list(contexts.values()))
    total, vocabulary = sum(counts.values()), len(counts)
    rest = sum(e[min(n, 3)] for n in contexts.values()) / len(pairs) if pairs else 1.0

    def chance(u, w):
        n = contexts[w]
        alone = max(n - e[min(n, 3)], 0) / max(1, len(pairs)) + rest / (vocabulary + 1)
        if u not in kinds:
            return alone
        n = pairs[u, w]
        return max(n - d[min(n, 3)], 0) / sum(kinds[u]) + sum(d[min(k, 3)] for k in kinds[u]) / sum(kinds[u]) * alone

    def of(text):
        tokens = [*words(text), ()]
        score = sum(math.log10(chance(u, w)) for u, w in zip([None, *tokens], tokens))
        base = sum(math.log10((counts[w] + 1) / (total + vocabulary + 1)) for w in tokens)
        return len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score

    return of


def compare(rows, got, words):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    of = model([t for i, t in rows if not held(i)], words)
    want = sorted((repr(i), held(i), *of(t)) for i, t in rows)
    have = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for w, h in zip(want, have) for a, b in zip(w[5:], h[5:]))


def test_against_brute_force(sample, words):
    docs = sample("documents")
    got = lm_scores(docs).collect()
    compare([(r.doc_id, r.text) for r in docs.collect()], got, words)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(documents, odd, words):
    compare(odd, lm_scores(documents(odd)).collect(), words)


def test_empty_and_nothing_to_learn_from(documents, words):
    assert lm_scores(documents([])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    compare([(held, "a b")], lm_scores(documents([(held, "a b")])).collect(), words)
