"""Importance resampling: planes against plain sums, checksums, and the whole against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(x):
    return zlib.crc32(x.encode()) % 10000


def brute(docs, target):
    s, t = (Counter(bucket(x) for r in rows for x in features(r.text)[1]) for rows in (docs, target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in s}
    out, able = [], []
    for k, r in enumerate(docs):
        words, found = features(r.text)
        weight = sum(gain[bucket(x)] for x in found) // len(found) if found else 0
        score = None
        if r.doc_id is not None:
            u = (int(hashlib.sha256(f"7:{r.doc_id}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
            score = weight + math.floor(-1000 * math.log(-math.log(u)))
            if len(words) >= 20:
                able.append((-score, r.doc_id, k))
        out.append([r.doc_id, len(found), weight, score, None])
    for rank, (_, _, k) in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        out[k][4] = rank
    return out


def same(got, want):
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(str, map(list, got.collect()))) == sorted(map(str, want))


def test_buckets_of_words_of_any_length():
    texts = ["Ab c", "x" * 63, "y" * 64 + " " + "z" * 65 + " 9", "été 日本語 a" + "b" * 200 + " q", "", None, "-", " a\n\nB\tc!d_e"]
    for text, (n, found) in zip(texts, R.feature_buckets(pa.array(texts))):
        words, want = features(text)
        assert n == len(words) and Counter(found.tolist()) == Counter(map(bucket, want))
    words = "one two three four five".split()
    (_, found), = R.feature_buckets(pa.array([" ".join(words)]), longest=3)
    assert sorted(found.tolist()) == sorted(bucket(" ".join(words[i : i + n])) for n in (1, 2, 3) for i in range(6 - n))


@pytest.mark.parametrize("seed", range(5))
def test_planes_sum_exactly(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 2 ** rng.integers(1, 20), 10_000) * (rng.random(10_000) < 0.1)
    gains = rng.integers(-(2**15), 2**15, 10_000)
    planes = R.planes_of(counts)
    assert (R.counts_of(planes, 10_000) == counts).all()
    assert R.sliced_sum(planes, (R.planes_of(np.maximum(gains, 0)), R.planes_of(np.maximum(-gains, 0)))) == int((counts * gains).sum())
    none = R.planes_of(np.zeros(10_000, np.int64))
    assert R.sliced_sum(none, (planes, none)) == 0


def test_odd_rows(docs, nothing, spark):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    # Repeated rows tie, so their ranks may stand either way round.
    same(R.resample(docs, target), brute(docs.collect(), target.collect()))
    assert R.resample(nothing, target).count() == 0
    odd = spark.createDataFrame([(None,), ("",)], "text string")
    same(R.resample(docs, odd), brute(docs.collect(), odd.collect()))


def test_sample(sample, spark):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    same(R.resample(sample, target), brute(sample.collect(), target.collect()))
