"""Quality rules: measures against brute force, the estimation, edge rows."""

import random
import re

import numpy as np

from paymart.llm.quality_rules import RULES, estimate, judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat),
            n < 20 or 100 * len(repeat) > 30 * n)


def test_measures_match_brute_force(spark):
    rnd = random.Random(6)
    texts = [None, "", "\n", "a\n\na\n a\na ", "é|é # x\x1fy\n", "the " * 500, "x" * 5000, "\x0b a\rb"]
    for _ in range(150):
        n = rnd.randint(0, 80)
        texts.append("".join(rnd.choice(["a", "bé", "c", "漢", "#", "|%"]) + rnd.choice([" ", " ", "\n", "\t", "  \n", " "])
                             for _ in range(n)))
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int").repartition(3)
    out = judge_quality(df).collect()
    assert {r.doc_id: tuple(r[2:8]) for r in out} == {i: brute(t) for i, t in enumerate(texts)}
    assert not any(r.kept for r in out if r.base_failed)


def test_estimation_finds_accuracies():
    rnd = np.random.default_rng(0)
    truth = rnd.random(20_000) < 0.85
    accuracy = [0.95, 0.9, 0.9, 0.6, 0.85, 0.95, 0.5, 0.9, 0.8]
    votes = np.ones((len(truth), len(RULES)), dtype=int)
    for j, a in enumerate(accuracy):
        cast = rnd.random(len(truth)) < 0.7
        votes[cast, j] = np.where(truth ^ (rnd.random(len(truth)) > a), 2, 0)[cast]
    codes, index, counts = np.unique(votes @ 3 ** np.arange(len(RULES))[::-1], return_inverse=True, return_counts=True)
    post, learned, share = estimate(codes, counts.astype(float))
    assert ((post[index] >= 0.5) == truth).mean() > 0.97
    assert learned[0] > learned[4] > learned[3] > learned[6] and abs(share - 0.87) < 0.04
    alone, _, _ = estimate(np.array([], dtype=np.int64), np.array([]))
    assert len(alone) == 0


def test_clean_kept_junk_dropped(spark):
    rnd = random.Random(1)
    clean = [" ".join(rnd.choice("the of and river stone walks under bright morning light".split())
                      + ("." if rnd.random() < 0.1 else "") for _ in range(120)) for _ in range(40)]
    junk = [" ".join("w%d%%%%%%" % rnd.randint(0, 999) for _ in range(80)) for _ in range(8)]
    df = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    kept = {r.doc_id for r in judge_quality(df).where("kept").collect()}
    assert kept == set(range(40))


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "doc_id long, text string")
    assert [r.kept for r in judge_quality(df).collect()] == [False, False]
    assert judge_quality(df.limit(0)).collect() == []
