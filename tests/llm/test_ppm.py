"""PPM against a trie walked in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from gridloom.llm import ppm


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def brute(rows, order=5):
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    words = Counter()
    follow = [defaultdict(Counter) for _ in range(order + 1)]
    for i, w in texts:
        if not held(i):
            words.update(w)
            words[b"\n"] += 1
            s = b"\n" * order + b" ".join(w) + b"\n"
            for p in range(order, len(s)):
                for k in range(order + 1):
                    follow[k][s[p - k : p]][s[p]] += 1
    total, distinct = sum(words.values()), len(words)
    for i, w in texts:
        tokens = [*w, b"\n"]
        base = sum(math.log10((words[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        s, score = b"\n" * order + b" ".join(w) + b"\n", 0.0
        for p in range(order, len(s)):
            out = set()
            for k in range(order, -1, -1):
                seen = follow[k].get(s[p - k : p])
                if not seen:
                    continue
                left = {b: c for b, c in seen.items() if b not in out}
                n = sum(left.values())
                if s[p] in left:
                    score += math.log10((2 * left[s[p]] - 1) / (2 * n))
                    break
                if left:
                    score += math.log10(len(left) / (2 * n))
                out |= set(seen)
            else:
                score -= math.log10(ppm.ALPHABET - len(out))
        yield i, held(i), len(tokens), sum(words[t] > 0 for t in tokens), total, base, score


def key(row):
    return tuple(-1 if v is None else round(v, 6) for v in row)


def test_against_a_trie(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ppm.score_documents(docs, block_bytes=20_000)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for a, b in zip(sorted(map(key, got.collect())), sorted(map(key, brute(rows)))):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-5)


def test_sample_and_blocks(sample):
    want = {key(r) for r in brute([(r.doc_id, r.text) for r in sample.limit(60).collect()])}
    some = sample.limit(60).cache()
    got = [key(r) for r in ppm.score_documents(some).collect()]
    for a, b in zip(sorted(got), sorted(want)):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-5)


def test_probabilities_add_up(spark):
    text = "abracadabra abrac"
    levels = [(int.from_bytes((b"\n" * 5 + text.encode() + b"\n")[p : p + 6], "big"), 1) for p in range(len(text) + 1)]
    context = int.from_bytes(b" abrac"[-5:], "big") << 8
    unseen = [(context | b, 0) for b in range(256) if b not in (9, 11, 12, 13)]
    rows = Counter(dict(unseen))
    for g, c in levels:
        rows[g] += c
    frame = spark.createDataFrame(list(rows.items()), "gram long, c long")
    costs = {r.gram: r.logp for r in ppm.log_costs(frame).collect()}
    assert sum(10 ** costs[context | b] for b in range(256) if b not in (9, 11, 12, 13)) == pytest.approx(1)


def test_empty(nothing):
    assert ppm.score_documents(nothing).count() == 0
