"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import scratch_path

#: White space of the word pattern ``[^\x20\x09-\x0D]+``; exactly what ``bytes.split()`` splits on.
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Bytes of texts worked on at a time.
_CHUNK = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers with their bits spread; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: What a Python worker keeps from one task to the next, under one key at most.
_KEPT: dict = {}


def kept(key, make):
    """What ``make`` gives, made once in a worker and kept until something is asked for under another key."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def slices(batches, column: str | int, size: int = _CHUNK):
    """The rows of Arrow batches in slices of about ``size`` bytes of a text column, at least a row each.

    A batch may hold ten thousand long texts; what is made of a slice is handed on before the next one is looked at.
    """
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(length.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
            yield batch.slice(at, end - at)
            at = end


def small_batches(batches, column: str | int, size: int = _CHUNK):
    """:func:`slices` for operators that keep nothing in a worker: what it keeps for another one is let go first."""
    _KEPT.clear()
    yield from slices(batches, column, size)


def lowered_chunks(texts, lower: bool = True):
    """Lists of the UTF-8 of Arrow strings, of about ``_CHUNK`` bytes in all, with A-Z lowered; null reads as empty."""
    held, size = [], 0
    for text in texts:
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        held.append(data.lower() if lower else data)
        size += len(data)
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def hashed_words(texts: list[bytes]):
    """Words of some UTF-8 texts joined by line ends.

    Returns the joined bytes, which of them are white space, where each text ends, and of each word where it stops,
    the number of its text, and an unsigned 64-bit hash. Hashes are summed in stretches of ``_CHUNK`` bytes, so a very
    long text or word takes no more memory beside its own bytes.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    last = np.cumsum([len(t) + 1 for t in texts]) - 1
    space = _IS_SPACE[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    word = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        power, inverse = _powers()
        for at in range(0, len(data), _CHUNK):
            part = data[at : at + _CHUNK]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
            a, b = np.searchsorted(stop, at, "right"), np.searchsorted(start, at + len(part))
            first, last_ = np.maximum(start[a:b] - at, 0), np.minimum(stop[a:b] - at, len(part))
            # Divided by the power where the word starts, so that equal words are equal wherever they stand.
            found = (total[last_] - total[first]) * inverse[first]
            if a < b and start[a] < at:
                found[0] *= np.uint64(pow(int(_BASE), int(at - start[a]), 1 << 64))
            word[a:b] += found
    return data, space, last, stop, np.searchsorted(last, start), mixed(word)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from the first on, for one stretch of text."""
    return tuple(np.cumprod(np.full(_CHUNK, x, np.uint64)) for x in (_BASE, _INVERSE))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """UTF-8 words of a text; ``bytes.lower`` changes A-Z alone."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def ready(df: DataFrame) -> SparkSession:
    """The frame's session, with this package's folder on the path of its Python workers."""
    spark = df.sparkSession
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    while name in df.columns:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage is cut, and the planner knows its size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one run of an operator writes to the shared folder, and takes away when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self._held = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._held.append((out, path))
        return out

    def drop(self, *keep: DataFrame) -> None:
        """Delete all tables but those given."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for out, place in self._held:
            if not any(out is k for k in keep):
                path = jvm.org.apache.hadoop.fs.Path(place)
                path.getFileSystem(conf).delete(path, True)
        self._held = [(out, place) for out, place in self._held if any(out is k for k in keep)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
