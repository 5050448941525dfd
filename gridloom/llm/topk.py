"""Exact top-k search by inner product over integer vectors, with candidates ruled out by a table of pivot distances.

An inner product is turned into a distance: every vector x gets one more component sqrt(M - |x|^2), M the greatest
squared length of all, and a query gets 0 there, so |q' - x'|^2 = |q|^2 + M - 2 q.x and the highest scores are the least
distances. The distances of all vectors to ``PIVOTS`` pivots are computed once and written with the vectors. By the
triangle inequality a candidate is no nearer to a query than the greatest difference of their distances to any pivot.

A query looks at candidates in the order of that bound, computes scores in growing runs, and stops for good when the
bound of the next one is beyond its k-th best score so far, which starts as the k-th best among the sampled vectors.

Queries and candidates meet in cells of at most ``QUERIES`` by ``CANDIDATES`` vectors (fewer, if they are long), dealt
by hash; each cell gives at most k rows for a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm._util import ready, staged

SCALE = 256
TOP = 5
QUERY_EVERY = 50
PIVOTS = 64
#: Vectors that pivots are chosen from and first thresholds are taken from; all others are searched just as well.
SAMPLE = 2048
QUERIES, CANDIDATES = 1024, 16_384
#: Bytes of components in a cell's candidates.
CELL_BYTES = 32_000_000
_FIRST_RUN = 256
_LIMIT = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, dims, norm, v) of rows (id, v): components floor(scale * x) as doubles, without rows that take no part."""

    def run(batches):
        for batch in batches:
            keep, found = [], []
            for i, row in enumerate(batch.column("v")):
                if row.is_valid and row.values.null_count == 0:
                    x = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if np.isfinite(x).all() and batch.column("id")[i].is_valid:
                        keep.append(i)
                        found.append(np.floor(scale * x))
            columns = [
                batch.column("id").take(pa.array(keep, pa.int64())), pa.array([len(x) for x in found], pa.int64()),
                pa.array([float(x @ x) for x in found], pa.float64()), pa.array(found, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "dims", "norm", "v"])

    return vectors.mapInArrow(run, f"id {dict(vectors.dtypes)['id']}, dims long, norm double, v array<double>")


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors held as doubles; beyond 64 bits they stop at the greatest or least long."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if most < 2**53:
        return (x @ q).astype(np.int64)
    if most < 2**62 and max(np.abs(q).max(), np.abs(x).max()) < 2**62:
        return x.astype(np.int64) @ q.astype(np.int64)
    own = [int(c) for c in q]
    return np.array([min(_LIMIT, max(-_LIMIT - 1, sum(a * int(b) for a, b in zip(own, row)))) for row in x], np.int64).reshape(len(x))


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Numbers of sampled vectors, each the farthest from those before it."""
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(pivots, len(sample)):
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        best = int(np.argmax(far))
        if not far[best] > 0:
            break
        chosen.append(best)
    return np.array(chosen)


class Pivots:
    """Pivots of one number of components, and distances to them."""

    def __init__(self, sample: np.ndarray, greatest: float, pivots: int):
        lifted = self._lifted(sample, greatest)
        self.at, self.greatest = lifted[choose_pivots(lifted, pivots)], greatest

    @staticmethod
    def _lifted(x: np.ndarray, greatest: float) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(0.0, greatest - (x * x).sum(axis=1)))])

    def distances(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        lifted = np.column_stack([x, np.zeros(len(x))]) if query else self._lifted(x, self.greatest)
        square = (lifted * lifted).sum(axis=1)[:, None] + (self.at * self.at).sum(axis=1) - 2 * (lifted @ self.at.T)
        return np.sqrt(np.maximum(0.0, square)).astype(np.float32)


def bounds(mine: np.ndarray, theirs: np.ndarray, slack: float) -> np.ndarray:
    """Least distances of queries (rows) to candidates (columns), from distances to pivots (second axis of both)."""
    best = np.zeros((len(mine), len(theirs)), np.float32)
    for p in range(mine.shape[1]):
        gap = np.subtract.outer(mine[:, p], theirs[:, p])
        np.maximum(best, np.abs(gap, out=gap), out=best)
    # What is not a number rules nothing out.
    return np.maximum(np.where(np.isfinite(best), best, 0) - np.float32(slack), 0)


def search(q: np.ndarray, known: int | None, bound: np.ndarray, v: np.ndarray, ids: np.ndarray, own: int | None, far: float, k: int):
    """The k best candidates (numbers, scores) of one query, ties to smaller ids, and how many scores were computed.

    ``known`` is a score that k others are known to reach; ``far`` is |q|^2 + M; ``own`` is the query's own number.
    """
    order = np.argsort(bound, kind="stable")
    at, done, run = np.zeros(0, np.int64), 0, _FIRST_RUN
    best = np.zeros(0, np.int64)
    while done < len(order):
        worst = known
        if len(best) == k and (known is None or best[-1] > known):
            worst = int(best[-1])
        # A candidate that reaches the score is no farther than this; an equal score may still win by its id.
        if worst is not None and float(bound[order[done]]) ** 2 > far - 2.0 * worst + 1e-9 * far:
            break
        new = order[done : done + run]
        done, run = done + len(new), run * 2
        if own is not None:
            new = new[new != own]
        found = scores(q, v[new])
        if len(best) == k:
            new, found = new[found >= best[-1]], found[found >= best[-1]]
        if not len(new):
            continue
        at, best = np.concatenate([at, new]), np.concatenate([best, found])
        first = np.lexsort((ids[at], ~best))[:k]
        at, best = at[first], best[first]
    return at, best, done


def _matrix(column, dims: int, kind=np.float64) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return chunk.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(chunk), dims)


def top_scores(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = QUERY_EVERY, k: int = TOP, scale: int = SCALE,
    pivots: int = PIVOTS, sample: int = SAMPLE, queries: int = QUERIES, candidates: int = CANDIDATES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id ``every`` divides, its k best among all other rows.

    Scores are exact inner products of floor(scale * x), highest first, ties to smaller ids; fewer than k other rows
    give fewer. Vectors null or with null or non-finite components take no part, nor do rows without an id. Vectors of
    different lengths do not meet; empty ones score 0. Rows that repeat an id are rows of their own, as queries and as
    candidates. A vector of any length is taken whole. Other columns are not read; an empty table gives no rows.
    """
    spark = ready(vectors)
    id_type = dict(vectors.dtypes)[id_col]
    whole = staged(integer_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), scale), "topk-vectors")
    # Bounded by the parameter; lengths that have no vector in it are searched without bounds.
    drawn = whole.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("dims", "v").collect()
    size = whole.agg(F.max("norm"), F.max("dims"), F.count("*")).first()
    greatest, longest, rows = size[0] or 0.0, max(1, size[1] or 1), size[2]
    by_dims = {}
    for r in drawn:
        by_dims.setdefault(r["dims"], []).append(r["v"])
    by_dims = {d: np.array(v, np.float64).reshape(len(v), d) for d, v in by_dims.items()}
    tables = {d: Pivots(v, greatest, pivots) for d, v in by_dims.items()}

    def with_distances(batches):
        for batch in batches:
            dims, norm = batch.column("dims").to_numpy(), batch.column("norm").to_numpy()
            far, query, known = [], [], []
            ids = batch.column("id").to_numpy()
            for i, row in enumerate(batch.column("v")):
                x = row.values.to_numpy()[None].astype(np.float64)
                table = tables.get(int(dims[i]))
                far.append(table.distances(x)[0] if table else None)
                is_query = ids[i] % every == 0
                query.append(table.distances(x, query=True)[0] if table and is_query else None)
                # One of the sampled scores may be the query's own, so the next one is taken.
                some = np.sort(scores(x[0], by_dims[int(dims[i])])) if table and is_query else ()
                known.append(int(some[-k - 1]) if len(some) > k else None)
            kind = pa.list_(pa.float32())
            extra = [pa.array(far, kind), pa.array(query, kind), pa.array(known, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "far", "near", "known"])

    extended = whole.mapInArrow(with_distances, f"id {id_type}, dims long, norm double, v array<double>, far array<float>, near array<float>, known long")
    table = staged(extended.withColumn("row", F.monotonically_increasing_id()), "topk-pivots")

    asked = table.where(F.col("id") % every == 0)
    cells = max(1, -(-rows // max(1, min(candidates, CELL_BYTES // (8 * longest)))))
    groups = max(1, -(-asked.count() // queries))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    columns = ["dims", "id", "row", "norm", "v"]
    left = asked.select(*columns, F.col("near").alias("d"), "known", dealt(groups).alias("g"), spread(cells).alias("c"))
    right = table.select(*columns, F.col("far").alias("d"), dealt(cells).alias("c"), spread(groups).alias("g"))

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "row": [], "score": []}
        if len(one) and len(other):
            dims = one["dims"][0].as_py()
            v, ids, row = _matrix(other["v"], dims), other["id"].to_numpy(), other["row"].to_numpy()
            place = {r: i for i, r in enumerate(row.tolist())}
            mine, norm, known = _matrix(one["v"], dims), one["norm"].to_numpy(), one["known"].to_pylist()
            has = one["d"].null_count == 0 and other["d"].null_count == 0
            width = len(one["d"][0]) if has else 0
            d, e = (_matrix(x["d"], width, np.float32) if has else np.zeros((len(x), 0), np.float32) for x in (one, other))
            slack = 1e-5 * max(float(np.abs(d).max(initial=0)), float(np.abs(e).max(initial=0)), greatest**0.5)
            for a in range(0, len(mine), 64):
                part = bounds(d[a : a + 64], e, slack)
                for i, bound in enumerate(part, a):
                    q = one["row"][i].as_py()
                    at, best, _ = search(mine[i], known[i], bound, v, ids, place.get(q), float(norm[i]) + greatest, k)
                    out["query"] += [q] * len(at)
                    out["query_id"] += [one["id"][i].as_py()] * len(at)
                    out["vec_id"] += ids[at].tolist()
                    out["row"] += row[at].tolist()
                    out["score"] += best.tolist()
        own = one.schema.field("id").type
        kinds = {"query": pa.int64(), "query_id": own, "vec_id": own, "row": pa.int64(), "score": pa.int64()}
        return pa.table({c: pa.array(x, kinds[c]) for c, x in out.items()})

    met = left.groupBy("g", "c", "dims").cogroup(right.groupBy("g", "c", "dims")).applyInArrow(
        run, f"query long, query_id {id_type}, vec_id {id_type}, row long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
