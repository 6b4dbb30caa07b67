"""Source mixing: exact draws, the target mix, edge rows."""

import hashlib
import math
from collections import Counter

from paymart.llm.source_mixing import SEED, mix_sources


def draw(doc_id, rate):
    u = int(hashlib.md5(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, cdf, log_p = 0, math.exp(-rate), -rate
    while cdf <= u:
        k += 1
        log_p += math.log(rate) - math.log(k)
        cdf += math.exp(log_p)
    return k


def test_draws_and_mix(spark):
    rows = [(i, "t", ["big", "mid", "small"][min(2, i % 10 // 6 + (i % 50 == 0) * 2)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    targets = spark.createDataFrame([("big", 1.0), ("mid", 2.0), ("small", 1.0), ("none", 4.0)],
                                    "source string, weight double")
    got = Counter((r.doc_id, r.source) for r in mix_sources(df, targets).collect())
    n = Counter(r[2] for r in rows)
    rate = {s: 4000 * w / 4 / n[s] for s, w in (("big", 1), ("mid", 2), ("small", 1))}
    assert got == Counter({(i, s): k for i, _, s in rows if (k := draw(i, rate[s]))})
    mix = Counter()
    for (_, s), k in got.items():
        mix[s] += k
    assert abs(mix["mid"] / 2000 - 1) < 0.1 and abs(mix["big"] / 1000 - 1) < 0.15


def test_large_rate(spark):
    df = spark.createDataFrame([(i, "a") for i in range(50)], "doc_id long, source string")
    assert mix_sources(df, total=50 * 1000).count() == sum(draw(i, 1000.0) for i in range(50))


def test_null_and_repeated_rows(spark):
    rows = [(None, None, None, 9), (1, None, None, 9), (1, "", "a", 9), (1, "", "a", 9), (2, "x", "null", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy_no int")
    out = mix_sources(df, total=500).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "source", "copy_no"}
    assert {r.source for r in out} == {None, "a", "null"}
    assert mix_sources(df.limit(0)).collect() == []


def test_shuffled(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'s' AS source").coalesce(1)
    ids = [r.doc_id for r in mix_sources(df).collect()]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.7 * len(ids)
