"""Exact top-k search against brute force."""

import math
import random

import numpy as np

from paymart.llm import topk_search
from paymart.llm.topk_search import Block, search

SCHEMA = "vec_id long, embedding array<double>"


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256.0 * x) for x in v):
        return None
    return [math.floor(256.0 * x) for x in v]


def brute(rows, queries, k=5):
    vectors = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    asked = {(i, tuple(whole(v))) for i, v in queries if i is not None and whole(v) is not None}
    out = []
    for i, q in asked:
        scores = [(-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), j)
                  for j, v in vectors if j != i and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, every=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = search(df.where(f"vec_id % {every} = 0"), df, **kw)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    queries = [r for r in rows if r[0] is not None and r[0] % every == 0]
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, kw.get("k", 5))


def vectors(seed, n, dim=8, spread=1.0):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(max(1, n // 10), dim))
    v = base[rnd.integers(0, len(base), n)] + rnd.normal(size=(n, dim)) * 0.1
    v *= np.exp(rnd.normal(size=(n, 1)) * spread)
    return [(i, list(map(float, x))) for i, x in enumerate(v)]


def test_lengths_of_all_sizes(spark):
    for spread in (0.0, 0.3, 2.0):
        run(spark, vectors(1, 700, spread=spread))


def test_blocks_of_queries(spark):
    run(spark, vectors(2, 400), block_bytes=8 * 8 * 20)


def test_nulls_odd_values_and_other_sizes(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 60) + [(100, None), (102, []), (105, []), (103, [1.0, None]), (106, [nan] * 8), (108, [1.0, inf]),
                             (None, [1.0] * 8), (111, [0.0] * 8), (114, [1.0, -2.5]), (115, [2.0, 0.001]),
                             (117, [1e308, 1.0]), (120, [1e300] * 3), (123, [-1e300] * 3), (-3, [0.25] * 8),
                             (126, [float(2**40), 1.0, 3.0]), (127, [float(2**20) + 0.5, 2.0, 1.0])]
    run(spark, rows)
    run(spark, rows, k=1)


def test_ties_copies_and_repeated_rows(spark):
    same = [0.5, 0.5, -0.25, 0.0]
    rows = [(i, same) for i in range(300)] + [(3, same), (3, same), (6, [1.0, 0.0, 0.0, 0.0]), (7, [1.0, 0.0, 0.0, 0.0])]
    run(spark, rows)
    run(spark, [(i, [0.0, 0.0]) for i in range(20)])
    run(spark, [(i, [-1.0, -float(i)]) for i in range(0, 20)] + [(i, [1.0, 0.5]) for i in range(21, 25)])


def test_small_and_empty_tables(spark):
    run(spark, [])
    run(spark, [(0, [1.0])])
    run(spark, [(0, [1.0]), (1, [2.0])])
    run(spark, [(1, [1.0]), (2, [2.0])])


def test_small_buckets(spark, monkeypatch):
    rnd = random.Random(4)
    rows = vectors(5, 300, spread=0.5)
    rnd.shuffle(rows)
    # one task sees many buckets and prunes with what it has found
    ids = np.array([i for i, _ in rows])
    p = np.array([whole(v) for _, v in rows], dtype=np.float64)
    norm = np.sqrt((p * p).sum(axis=1))
    order = np.argsort(-norm)
    queries = np.flatnonzero(ids % 3 == 0)
    for cosine in (0.0, 0.7, 2.0):  # coordinates always, by the threshold, never
        monkeypatch.setattr(topk_search, "COSINE", cosine)
        block = Block(ids[queries], ids[queries], p[queries], norm[queries],
                      np.full(len(queries), -(2**63 - 1)), 5)
        for i in range(0, len(order), 16):
            at = order[i:i + 16]
            block.search(ids[at], p[at], norm[at])
        got = sorted((r["query_id"], r["vec_id"], r["score"]) for r in block.result().to_pylist())
        assert got == sorted((q, j, s) for q, _, j, s in brute(rows, [rows[i] for i in queries]))


def test_extra_columns(spark):
    rows = vectors(6, 60)
    df = spark.createDataFrame([(*r, 1.0, 2, 3) for r in rows], SCHEMA + ", norm double, rank int, query_id int")
    got = search(df.where("vec_id % 3 = 0"), df)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r for r in rows if r[0] % 3 == 0])
