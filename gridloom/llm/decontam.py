"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are read as lower-case word sequences. Windows of ``LEAST_MATCH`` words, known by a
Karp-Rabin hash, that stand in both are the seeds. For each document and item that share seeds, seeds next to each other
grow into maximal matches; the longest match is marked as a tile, what overlaps it is cut back, and so on until no match
of the least length is left. Tiles may lie in any order, so reordered passages are found; an item is leaked by a document
if tiles cover at least ``COVERAGE`` of it. An item with fewer words than the least match is one window of its own length
and is leaked where it stands whole.

The benchmark is dealt into blocks of about ``BLOCK_BYTES``. The seeds of one block are broadcast, which bounds them, and
all documents are run against each block in turn; a benchmark is usually one block.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm._util import ready, small_batches, text_bytes

LEAST_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 16_000_000
_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9FB21C651E98DF25)


def tile(matches: list[tuple[int, int, int]], least: int = LEAST_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (document place, item place, length) out of maximal matches of the same form, the longest first.

    Of equally long ones that with the lesser places goes first. A match that meets marked words is cut into the
    stretches between them; those of at least ``least`` words stay.
    """
    heap = [(-n, d, i) for d, i, n in matches if n >= least]
    heapq.heapify(heap)
    in_doc, in_item, tiles = set(), set(), []
    while heap:
        n, d, i = heapq.heappop(heap)
        free = [d + k not in in_doc and i + k not in in_item for k in range(-n)]
        if all(free):
            tiles.append((d, i, -n))
            in_doc.update(range(d, d - n))
            in_item.update(range(i, i - n))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= least:
                    heapq.heappush(heap, (start - k, d + start, i + start))
                start = None
    return tiles


class Benchmark:
    """Seeds of some items (id, text): window hashes with where they stand."""

    def __init__(self, items: list[tuple[object, str | None]], least: int = LEAST_MATCH):
        self.least, self.vocabulary, self.items = least, {}, []
        keys, places, short = [], [], defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in _WORD.findall((text or "").lower())]
            if 0 < len(words) < least:
                code = self._windows(np.array(words, np.int64), len(words))[0]
                short[len(words)][code].append((item_id, words))
            elif words:
                codes = self._windows(np.array(words, np.int64), least)
                keys.append(codes)
                places += [(len(self.items), k) for k in range(len(codes))]
                self.items.append((item_id, words))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        by = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[by], np.array(places, np.int64).reshape(-1, 2)[by]
        self.short = {n: (np.array(sorted(at), np.uint64), dict(at)) for n, at in sorted(short.items())}

    @staticmethod
    def _windows(words: np.ndarray, size: int) -> np.ndarray:
        n = len(words) - size + 1
        code, words = np.zeros(max(0, n), np.uint64), words.astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(size):
                code = code * _FACTOR + words[k : k + len(code)]
        return code

    def _quoted(self, words: np.ndarray, unknown: np.ndarray):
        """Leaks of items with fewer words than the least match: those that stand whole in the words."""
        for n, (keys, items) in self.short.items():
            at = np.flatnonzero(unknown[n:] == unknown[: len(words) - n + 1])
            codes = self._windows(words, n)[at] if len(at) else np.zeros(0, np.uint64)
            places = np.searchsorted(keys, codes)
            hit = keys[np.minimum(places, len(keys) - 1)] == codes
            found, first = np.unique(codes[hit], return_index=True)
            for code, d in zip(found, at[hit][first].tolist()):
                yield from ((item_id, 1, n, n, n) for item_id, item in items[code] if words[d : d + n].tolist() == item)

    def leaks(self, text: str | None, coverage: float = COVERAGE) -> list[tuple[object, int, int, int, int]]:
        """(item id, tiles, longest tile, covered words, item words) of each item that the text leaks."""
        get = self.vocabulary.get
        words = np.array([get(w, -1) for w in _WORD.findall((text or "").lower())], np.int64)
        unknown = np.concatenate([[0], np.cumsum(words < 0)])
        found = list(self._quoted(words, unknown)) if self.short else []
        n = len(words) - self.least + 1
        if n < 1 or not len(self.keys):
            return found
        at = np.flatnonzero(unknown[self.least :] == unknown[: n])
        if not len(at):
            return found
        codes = self._windows(words, self.least)[at]
        low, high = np.searchsorted(self.keys, codes), np.searchsorted(self.keys, codes, "right")
        seeds = defaultdict(list)
        for d, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
            for item, i in self.places[a:b].tolist():
                if words[d : d + self.least].tolist() == self.items[item][1][i : i + self.least]:
                    seeds[item].append((d - i, d))
        for item, hits in sorted(seeds.items()):
            item_id, item_words = self.items[item]
            # Fewer item words under seeds than asked for cannot be covered by tiles either.
            under = {d - diagonal + k for diagonal, d in hits for k in range(self.least)}
            if len(under) < coverage * len(item_words):
                continue
            matches, run = [], None
            for diagonal, d in sorted(hits):
                if run and run[0] == diagonal and run[1] + run[2] == d:
                    run[2] += 1
                else:
                    run = [diagonal, d, 1]
                    matches.append(run)
            tiles = tile([(d, d - diagonal, k + self.least - 1) for diagonal, d, k in matches], self.least)
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(item_words):
                found.append((item_id, len(tiles), max(t[2] for t in tiles), covered, len(item_words)))
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark as lists of (id, text) of about ``block_bytes`` each, one at a time."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(text_bytes("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    coverage: float = COVERAGE, least: int = LEAST_MATCH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per leaked pair: doc_id, item_id, n_tiles, longest_tile, covered_words, item_words, coverage.

    Clean documents have no row. Null and empty texts leak nothing, and items without a word are leaked by nothing; one with
    fewer words than the least match is leaked where it stands whole, as one tile. Rows that repeat an id are each looked
    at. A very long text is read whole. Other columns are not read; empty tables give no rows.
    """
    spark = ready(docs)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["n_tiles", "longest_tile", "covered_words", "item_words"]
    item_type = benchmark.schema[item_col].dataType
    schema = T.StructType(
        [T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("item_id", item_type)]
        + [T.StructField(n, T.LongType()) for n in names] + [T.StructField("coverage", T.DoubleType())]
    )
    arrow_item = _arrow_type(item_type)
    parts = []
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Benchmark(items, least))

        def run(batches, shared=shared):
            bench = shared.value
            for batch in small_batches(batches, "text"):
                rows, found = [], []
                for k, text in enumerate(batch.column("text")):
                    for leak in bench.leaks(text.as_py(), coverage):
                        rows.append(k)
                        found.append(leak)
                columns = [pa.array([f[c] for f in found], pa.int64()) for c in range(1, 5)]
                share = pa.array([f[3] / f[4] for f in found], pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array([f[0] for f in found], arrow_item), *columns, share],
                    ["doc_id", "item_id", *names, "coverage"],
                )

        parts.append(source.mapInArrow(run, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    coverage: float = COVERAGE, least: int = LEAST_MATCH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows, with all their columns, whose text leaks no item; odd texts and items count as in :func:`find_leaks`.

    Rows with null or empty texts stay, repeated rows go or stay together, and an empty table gives no rows.
    """
    spark = ready(docs)
    at = docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Benchmark(items, least))

        def run(batches, shared=shared):
            for batch in small_batches(batches, at):
                yield batch.filter(pa.array([not shared.value.leaks(x.as_py(), coverage) for x in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
    return docs
