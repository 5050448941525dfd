"""Importance resampling towards a target distribution, with weights summed from bit planes.

Features are hashed to ``BUCKETS`` buckets. A document's counts by bucket become bit planes: bit b of plane j is bit j of
the count of bucket b. What a bucket gains (how much more frequent it is in the target than in the corpus) is an integer,
sliced likewise into planes of magnitude for positive and for negative gains. The weight is then exact without a
multiplication by bucket: each count plane AND each gain plane, population counts, and a sum of powers of two.

Planes are written once, so texts are read once; totals by bucket and weights are both taken from the planes.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import lowered_chunks, ready, staged
from gridloom.llm.ordering import numbered

BUCKETS = 10_000
#: Percent of the documents that can be drawn.
SHARE = 25
LEAST_WORDS = 20
#: Rows of planes worked on at a time.
_ROWS = 256
#: Words of more bytes have their checksums taken one by one.
_LONG = 64

_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def _shifts() -> np.ndarray:
    """[n, k, b]: what n zero bytes make of a checksum with the single byte b at place k; the map is linear over xor."""
    out = np.empty((_LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_LONG):
        out[n + 1] = _CRC[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


_SHIFT = _shifts()


def _word_crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, byte by byte over all words at once."""
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], np.minimum(length[order], _LONG)
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for j in range(int(size[0]) if len(size) else 0):
        k = np.searchsorted(-size, -j, "left")
        state[:k] = _CRC[(state[:k] ^ data[begin[:k] + j]) & 0xFF] ^ (state[:k] >> 8)
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(length > _LONG):
        out[i] = zlib.crc32(data[start[i] : start[i] + length[i]])
    return out


def _followed(first: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC-32 of a text with checksum ``first`` followed by a word with checksum ``crc``."""
    n = np.minimum(length, _LONG)
    out = crc ^ _SHIFT[n, 0, first & 0xFF] ^ _SHIFT[n, 1, (first >> 8) & 0xFF] ^ _SHIFT[n, 2, (first >> 16) & 0xFF] ^ _SHIFT[n, 3, first >> 24]
    for i in np.flatnonzero(length > _LONG):
        out[i] = zlib.crc32(data[start[i] : start[i] + length[i]], int(first[i]))
    return out


def feature_buckets(texts, longest: int = 2, buckets: int = BUCKETS):
    """For each Arrow string its number of words and the bucket of each run of 1 to ``longest`` words, repeats included."""
    for some in lowered_chunks(texts):
        data = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
        last = np.cumsum([len(t) + 1 for t in some]) - 1
        inside = _IN_WORD[data]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
        length = stop - start
        ends = np.searchsorted(start, last)
        begins = np.concatenate(([0], ends[:-1]))
        word = _word_crcs(data, start, length)
        runs, found = word, [word % np.uint32(buckets)]
        for n in range(1, longest):
            # A run of n words, a space, and the next word; runs across two texts are made too and not looked at.
            spaced = _CRC[(~runs[: max(0, len(word) - n)] ^ np.uint32(32)) & 0xFF] ^ (~runs[: max(0, len(word) - n)] >> 8)
            runs = _followed(~spaced, data, start[n:], length[n:], word[n:])
            found.append(runs % np.uint32(buckets))
        for a, b in zip(begins.tolist(), ends.tolist()):
            yield b - a, np.concatenate([f[a : max(a, b - n)] for n, f in enumerate(found)])


def planes_of(counts: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative counts, lowest first, each of whole bytes."""
    n = int(counts.max(initial=0)).bit_length()
    return np.packbits((counts[None] >> np.arange(n)[:, None]) & 1 == 1, axis=1)


def counts_of(planes: np.ndarray, buckets: int) -> np.ndarray:
    bits = np.unpackbits(planes, axis=1, count=buckets)
    return (bits.astype(np.int64) << np.arange(len(planes))[:, None]).sum(axis=0)


def sliced_sum(counts: np.ndarray, gains: tuple[np.ndarray, np.ndarray]) -> int:
    """The sum of count times gain over all buckets, from planes of the counts and of positive and negative gains."""
    total = 0
    for sign, planes in zip((1, -1), gains):
        ones = np.bitwise_count(counts[:, None] & planes[None]).sum(axis=2, dtype=np.int64)
        total += sign * sum(int(x) << (i + j) for (i, j), x in np.ndenumerate(ones) if x)
    return total


def bucket_planes(docs: DataFrame, longest: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, planes) for each row (id, text), over the whole text; null reads as empty."""

    def run(batches):
        for batch in batches:
            ids, at = batch.column("id"), 0
            held = ([], [], [])
            for words, found in feature_buckets(batch.column("text"), longest, buckets):
                planes = planes_of(np.bincount(found, minlength=buckets))
                for column, x in zip(held, (words, len(found), [p.tobytes() for p in planes])):
                    column.append(x)
                if len(held[0]) == _ROWS or at + len(held[0]) == len(ids):
                    columns = [pa.array(c, t) for c, t in zip(held, (pa.int64(), pa.int64(), pa.list_(pa.binary())))]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(held[0])), *columns], ["id", "n_words", "n_features", "planes"])
                    at, held = at + len(held[0]), ([], [], [])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, n_words long, n_features long, planes array<binary>")


def _rows_of_planes(batch):
    """The planes of each row of a batch, as a matrix of bytes."""
    for row in batch.column("planes"):
        planes = [p.as_buffer() for p in row.values] if row.is_valid else []
        yield np.stack([np.frombuffer(p, np.uint8) for p in planes]) if planes else None


def bucket_totals(planes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, total): the sum of all rows' counts; each task sums its own rows first, so it sends ``buckets`` rows at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for p in _rows_of_planes(batch):
                if p is not None:
                    total += counts_of(p, buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "total"])

    return planes.select("planes").mapInArrow(run, "bucket long, total long").groupBy("bucket").agg(F.sum("total").alias("total"))


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket 1000 times the logarithm of its share in the target to that in the corpus, both smoothed, floored."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _totals(planes: DataFrame, buckets: int) -> np.ndarray:
    """At most ``buckets`` rows come to the driver, whatever the input."""
    out = np.zeros(buckets, np.int64)
    for r in bucket_totals(planes, buckets).collect():
        out[r["bucket"]] = r["total"]
    return out


def noise(key: str, seed: int = 7) -> int:
    """A document's own Gumbel noise in thousandths, from its id alone."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(planes: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    sliced = planes_of(np.maximum(gains, 0)), planes_of(np.maximum(-gains, 0))

    def run(batches):
        for batch in batches:
            n, ids = batch.column("n_features").to_pylist(), batch.column("id").to_pylist()
            weight = [sliced_sum(p, sliced) // k if k else 0 for k, p in zip(n, _rows_of_planes(batch))]
            score = [None if i is None else w + noise(str(i), seed) for i, w in zip(ids, weight)]
            columns = [*(batch.column(c) for c in ("id", "n_words", "n_features")), pa.array(weight, pa.int64()), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight", "score"])

    return planes.mapInArrow(run, f"id {dict(planes.dtypes)['id']}, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", share: int = SHARE,
    least_words: int = LEAST_WORDS, longest: int = 2, buckets: int = BUCKETS, seed: int = 7,
) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank (null if not drawn).

    Words are runs of digits, a-z (A-Z lowered) and anything beyond ASCII; features are all runs of 1 to ``longest``
    words of the whole text, however long. ``weight`` is the floored mean gain of the features, 0 without any; ``score``
    adds noise that the id gives. Of the rows with at least ``least_words`` words, ``share`` percent, floored, are drawn
    by highest score, ties to smaller ids. Null and empty texts have no word. Repeated rows count, and are drawn, each;
    a row without an id has no score and is not drawn or counted among those that can be. An empty target or corpus leaves smoothed shares.
    Other columns are not read; an empty table gives no rows.
    """
    ready(docs)
    planes = staged(bucket_planes(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), longest, buckets), "resample-planes")
    wanted = bucket_planes(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), longest, buckets)
    gains = gains_of(_totals(planes, buckets), _totals(wanted, buckets))
    scored = staged(_scored(planes, gains, seed), "resample-scores").withColumn("all", F.lit(0))
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    ranked = numbered(scored.where(able), "all", [F.col("score").desc(), F.col("id")], "resample-ordered")
    drawn = F.col("pos") < F.floor(F.col("n") * F.lit(share) / F.lit(100))
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(drawn, F.col("pos") + 1).alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
