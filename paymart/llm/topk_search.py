"""Exact top-k search by inner product with norm-bucketed retrieval.

Components become ``floor(scale * x)``, whole numbers, so products are exact.

1. All vectors are stored once, dealt and sorted by length (longest first). A task
   reads them as buckets: neighbours in length, at most ``BUCKET`` of them, none
   shorter than ``SPREAD`` times the longest.
2. Queries are taken in blocks of at most ``BLOCK_BYTES`` of vectors, so what is
   broadcast has a fixed size. The block first searches the ``HEAD`` longest
   vectors: the k-th best score of a query there is its first threshold. A block
   whose thresholds bound the length reads only the files that reach it.
3. In each bucket, a query's threshold over its own length and the bucket's longest
   is the cosine that a vector must reach. Over 1, the bucket is passed by.
   From ``COSINE`` up, *coordinate* pruning: a vector at that cosine has each of its
   unit coordinates within a known interval around the query's, so the sorted
   coordinates of the bucket give the few vectors that can do it. Else *length*
   pruning: the bucket's vectors that are long enough, a prefix of it.
4. Products of what is left are computed in full; the best k of a task raise the
   threshold for its next buckets. The best k of all tasks are merged.

Bounds are computed in floating point and widened by ``SLACK``, so they only let
more through; products are whole numbers in doubles where these are exact, else
Python's integers. Every vector is looked at by a bound or a product; none is
dropped otherwise.

Results: (query_id, rank, vec_id, score), ties to the smaller vec_id. Vectors that
are null, hold a null or a non-finite component (before or after scaling), and
null ids take no part. Vectors with other numbers of components have no product
and are no candidates for each other. Repeated rows are candidates each; a
repeated query (same id and vector) is answered once, and the same id with another
vector is a query of its own. Rows with the query's own id are not its candidates.
A score beyond 64 bits counts as the nearest long. Empty tables give an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.session import stored_once, work_dir

SCALE = 256
K = 5
BUCKET = 8192
SPREAD = 0.9
HEAD = 1024
BLOCK_BYTES = 8 << 20
QUERY_STEP = 256
COSINE = 0.7
FOCUS = 4
SLACK = 1e-6
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_FOUND = "query long, query_id long, vec_id long, score long"


def _floor(x: Column) -> Column:
    """Floor of a double as a double (Spark's own gives a long, which saturates):
    from 2**52 on a double is whole."""
    return F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(x)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, q, norm) of the vectors that take part; q: the scaled components, whole
    numbers in doubles."""
    scaled = F.transform(F.col(vector), lambda x: _floor(x.cast("double") * F.lit(float(scale))))
    finite = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x))
    return (rows.select(F.col(vec_id).cast("long").alias("id"), scaled.alias("q"))
            .where(F.col("id").isNotNull() & F.col("q").isNotNull() & finite)
            .withColumn("norm", norm))


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, cut to 64 bits."""
    if not q.size or not p.size:
        return np.zeros((len(q), len(p)), dtype=np.int64)
    if np.abs(q).max() * np.abs(p).max() * q.shape[1] < _EXACT:
        return (q @ p.T).astype(np.int64)
    big = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (q, p)]
    return np.clip(big[0] @ big[1].T, -_LONG, _LONG).astype(np.int64)


class Block:
    """Queries with equally many components, and the best k found for each."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, q: np.ndarray, norm: np.ndarray,
                 floor: np.ndarray, k: int):
        self.number, self.ids, self.q, self.norm, self.k = number, ids, q, norm, k
        # a candidate must score over the floor, or as much with a smaller id
        self.floor, self.floor_id = floor.copy(), np.full(len(ids), _LONG)
        self.found = np.zeros((0, 3), dtype=np.int64)  # query, score, candidate id
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(norm[:, None] > 0, q / norm[:, None], 0.0)
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]

    def search(self, ids: np.ndarray, p: np.ndarray, norm: np.ndarray) -> None:
        """One bucket, longest vector first."""
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            need = np.where(self.floor > 0, self.floor / self.norm, 0.0)  # length a vector must have
            cosine = np.where(need > 0, need / norm[0], 0.0)
        cosine[~np.isfinite(cosine)] = 0.0
        alive = cosine <= 1 + SLACK
        by_coordinate = alive & (cosine >= COSINE)
        bucket = _Coordinates(p, norm)
        for i in np.flatnonzero(by_coordinate):
            at = bucket.reach(self.unit[i], self.focus[i], min(cosine[i], 1.0))
            if len(at):
                self._take(np.array([i]), ids[at], products(self.q[i:i + 1], p[at]))
        by_length = np.flatnonzero(alive & ~by_coordinate)
        for begin in range(0, len(by_length), QUERY_STEP):
            step = by_length[begin:begin + QUERY_STEP]
            n = int(np.searchsorted(-norm, -need[step].min() * (1 - SLACK), side="right"))
            if n:
                self._take(step, ids[:n], products(self.q[step], p[:n]))

    def _take(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        own = ids[None, :] == self.ids[queries][:, None]
        floor, floor_id = self.floor[queries][:, None], self.floor_id[queries][:, None]
        hit = ~own & ((scores > floor) | (scores == floor) & (ids[None, :] < floor_id))
        if hit.shape[1] > self.k and hit.sum() > 4 * self.k * len(queries):
            # no threshold yet: the k-th best of this bucket is one
            least = np.partition(np.where(own, -_LONG, scores), -self.k, axis=1)[:, -self.k]
            hit &= scores >= least[:, None]
        at, j = np.nonzero(hit)
        if not len(at):
            return
        touched = np.isin(self.found[:, 0], queries)
        rows = np.concatenate([self.found[touched],
                               np.stack([queries[at], scores[at, j], ids[j]], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        rows = rows[place < self.k]
        full = rows[place[place < self.k] == self.k - 1]
        self.floor[full[:, 0]], self.floor_id[full[:, 0]] = full[:, 1], full[:, 2]
        self.found = np.concatenate([self.found[~touched], rows])

    def result(self) -> pa.RecordBatch:
        i = self.found[:, 0]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.number[i]), pa.array(self.ids[i]), pa.array(self.found[:, 2]), pa.array(self.found[:, 1])],
            ["query", "query_id", "vec_id", "score"])


class _Coordinates:
    """Unit coordinates of a bucket, sorted one by one when first asked for."""

    def __init__(self, p: np.ndarray, norm: np.ndarray):
        with np.errstate(divide="ignore", invalid="ignore"):
            # a vector of no length reaches no cosine
            self.unit = np.where(norm[:, None] > 0, p / norm[:, None], 2.0)
        self.order: dict[int, np.ndarray] = {}

    def reach(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Which vectors may have that cosine with ``unit``: the angle between a
        coordinate of theirs and the query's is at most the angle between them."""
        angle = np.arccos(cosine) + SLACK
        at = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, at + angle)) - SLACK
        high = np.cos(np.maximum(0, at - angle)) + SLACK
        best = None
        for f, lo, hi in zip(focus, low, high, strict=True):
            if f not in self.order:
                self.order[f] = np.argsort(self.unit[:, f], kind="stable")
            column = self.unit[self.order[f], f]
            a, b = np.searchsorted(column, [lo, hi], side="left")
            if best is None or b - a < len(best):
                best = self.order[f][a:b]
        near = self.unit[best][:, focus]
        return best[((near >= low) & (near <= high)).all(axis=1)]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets (ids, vectors, lengths), longest first, of equally many components."""
    held: dict[int, list] = {}

    def cut(dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ids, p, norm = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        order = np.argsort(-norm, kind="stable")
        ids, p, norm = ids[order], p[order], norm[order]
        while len(ids):
            n = max(1, int(np.searchsorted(-norm, -norm[0] * SPREAD, side="right"))) if norm[0] > 0 else len(ids)
            yield ids[:n], p[:n], norm[:n]
            ids, p, norm = ids[n:], p[n:], norm[n:]

    for batch in batches:
        q = batch.column("q")
        size = np.diff(q.offsets.to_numpy())
        flat = q.flatten().to_numpy(zero_copy_only=False)
        begin = np.cumsum(size) - size
        ids, norm = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "norm"))
        for dim in np.unique(size).tolist():
            at = np.flatnonzero(size == dim)
            for i in range(0, len(at), BUCKET):
                part = at[i:i + BUCKET]
                p = flat[begin[part][:, None] + np.arange(dim)]
                if sum(len(x[0]) for x in held.get(dim, [])) + len(part) > BUCKET:
                    yield from cut(dim)
                held.setdefault(dim, []).append((ids[part], p, norm[part]))
    for dim in list(held):
        yield from cut(dim)


def _search(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {dim: Block(*x) for dim, x in queries.value.items()}
        for ids, p, norm in _buckets(batches):
            if p.shape[1] in blocks:
                blocks[p.shape[1]].search(ids, p, norm)
        for block in blocks.values():
            yield block.result()
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(queries: DataFrame, vectors: DataFrame, k: int = K, vec_id: str = "vec_id",
           vector: str = "embedding", scale: int = SCALE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product with each row of
    ``queries``: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    by_length = (whole_vectors(vectors, vec_id, vector, scale)
                 .repartitionByRange(F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"), F.asc("id")))
    stored = stored_once(by_length, "topk-vectors")
    head = stored_once(stored.orderBy(F.desc("norm"), F.asc("id")).limit(HEAD), "topk-head")
    asked = stored_once(whole_vectors(queries, vec_id, vector, scale).dropDuplicates(["id", "q"]), "topk-queries")
    count, dim = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    size = max(1, block_bytes // (8 * max(1, dim)))
    blocks = 1 if count <= size else -(-2 * count // size)  # by hash: about half full
    path = work_dir(spark, "topk-found")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "q"), F.lit(blocks)))
    for number in range(blocks):
        block = _block(asked.where(F.col("block") == number), number << 32)
        shared = spark.sparkContext.broadcast(_by_size(block, {}, k))
        first = head.mapInArrow(_search(shared), _FOUND)
        floors = {r.query: r.score for r in _best(first, k).where(F.col("rank") == k).collect()}
        shared.unpersist()
        shared = spark.sparkContext.broadcast(_by_size(block, floors, k))
        need = [floors.get(n, 0) / norm if norm > 0 else 0 for n, _, _, norm in block]
        reach = stored
        if need and min(need) > 0:
            reach = stored.where(F.col("norm") >= F.lit(min(need) * (1 - SLACK)))
        reach.mapInArrow(_search(shared), _FOUND).write.mode("append").parquet(path)
        shared.unpersist()
    found = spark.read.schema(_FOUND).parquet(path)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def _block(queries: DataFrame, start: int) -> list[tuple[int, int, list[float], float]]:
    """The queries of one block (bounded by its bytes), numbered."""
    return [(start + i, r.id, r.q, r.norm) for i, r in enumerate(queries.select("id", "q", "norm").collect())]


def _by_size(block: list, floors: dict[int, int], k: int) -> dict[int, tuple]:
    out = {}
    for dim in {len(q) for _, _, q, _ in block}:
        rows = [x for x in block if len(x[2]) == dim]
        out[dim] = (np.array([x[0] for x in rows]), np.array([x[1] for x in rows]),
                    np.array([x[2] for x in rows], dtype=np.float64).reshape(len(rows), dim),
                    np.array([x[3] for x in rows]),
                    np.array([floors.get(x[0], -_LONG) for x in rows], dtype=np.int64), k)
    return out


def oracle_sql(every: int = 50, k: int = K, scale: int = SCALE) -> str:
    """DuckDB SQL of the registered query."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
