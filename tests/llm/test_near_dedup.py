"""Near-dedup against brute force, unbiased signatures, edge rows."""

import random
from collections import Counter

import numpy as np
import pytest

from paymart.llm import textops as tx
from paymart.llm.components import connected_components
from paymart.llm.near_dedup import bag, bag_minhash, compare, keep_one_per_group, near_groups, numbered, parity_sketch


def multiset(text, width=5):
    words = (text or "").encode().split()
    if len(words) < width:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def similarity(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute_groups(rows, threshold=0.8):
    bags = [multiset(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= threshold:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    ids = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            ids[g] = min(doc_id, ids.get(g, doc_id))
    return sorted(((d, ids.get(g)) for (d, _), g in zip(rows, group)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.7:
            words = rnd.choice(texts).split()
            for _ in range(rnd.randint(0, 5)):
                if words:
                    words[rnd.randrange(len(words))] = "w%d" % rnd.randint(0, 9999)
        else:
            words = ["w%d" % rnd.randint(0, 9999) for _ in range(rnd.choice([1, 3, 5, 30, 120]))]
            if rnd.random() < 0.2:
                words = words[:3] * rnd.randint(1, 40)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_brute_force(spark, seed):
    rows = list(enumerate(corpus(seed, 90) + [None, "", " \n", "a b", "a  b", "a b"]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.group_id) for r in near_groups(df).collect()), key=str)
    assert got == brute_groups(rows)
    kept = {r.doc_id for r in keep_one_per_group(df).collect()}
    assert kept == {g for _, g in got}


def test_chain_is_one_group(spark):
    """Neighbours are near copies, far ones are not: one component, whichever
    node leads a bucket."""
    words = ["w%d" % i for i in range(100)]
    rows = []
    for i in range(12):
        words[8 * i] = "x%d" % i
        rows.append((50 - i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.group_id) for r in near_groups(df).collect()), key=str)
    assert got == brute_groups(rows)


def test_families_with_far_members(spark):
    """Families in which many members are not linked to the text they were made
    from, but some to each other; truncated members; a passage in all texts."""
    rnd = random.Random(9)
    word = lambda: "w%d" % rnd.randint(0, 10**6)
    common = [word() for _ in range(25)]
    rows = []
    for _ in range(3):
        base = [word() for _ in range(140)]
        for _ in range(28):
            words = list(base)
            for _ in range(rnd.randint(0, 9)):
                words[rnd.randrange(len(words))] = word()
            if rnd.random() < 0.3:
                words = words[:rnd.randint(100, 140)]
            rows.append(words + (common if rnd.random() < 0.5 else []))
            if rnd.random() < 0.5:
                again = list(rows[-1])
                again[rnd.randrange(len(again))] = word()
                rows.append(again)
    rows += [common + [word() for _ in range(60)] for _ in range(30)]
    rnd.shuffle(rows)
    rows = list(enumerate(" ".join(r) for r in rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.group_id) for r in near_groups(df).collect()), key=str)
    assert got == brute_groups(rows)


def test_prefixes_meet():
    """Sets that are similar enough and share something beyond a third one have
    prefixes that meet."""
    rnd = np.random.default_rng(3)
    met = 0
    for _ in range(3000):
        third = numbered(rnd.integers(0, 60, 30).astype(np.uint64))
        a = rnd.integers(0, 60, 30).astype(np.uint64)
        b = a.copy()
        b[rnd.integers(0, 30, rnd.integers(0, 5))] = rnd.integers(0, 60)
        a, b = numbered(a), numbered(b[:rnd.integers(24, 31)])
        shared = len(np.intersect1d(a, b))
        if shared / (len(a) + len(b) - shared) < 0.8 or not len(np.setdiff1d(np.intersect1d(a, b), third)):
            continue
        met += 1
        assert len(np.intersect1d(compare(a, third, 0.8)[1], compare(b, third, 0.8)[1]))
    assert met > 500
    assert numbered(np.zeros(0, dtype=np.uint64)).tolist() == [] and len(set(numbered(np.zeros(5, dtype=np.uint64)).tolist())) == 5


def test_sketches_never_differ_more_than_the_sets():
    rnd = np.random.default_rng(5)
    for n in (0, 1, 20, 400, 5000):
        a, b = (numbered(rnd.integers(0, 2 * n + 1, n).astype(np.uint64)) for _ in range(2))
        bits = sum(int(x).bit_count() for x in (parity_sketch(a) ^ parity_sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) and len(parity_sketch(a)) == 16


def test_signature_is_unbiased():
    rnd = random.Random(4)
    pairs = []
    for _ in range(150):
        a = {i: rnd.choice([1, 1, 2, 5, 30]) for i in range(30)}
        b = {i: w if rnd.random() < 0.7 else rnd.choice([0, 1, 3, 40]) for i, w in a.items()}
        b = {i: w for i, w in b.items() if w}
        text, runs, weight, base = [], [], [], rnd.getrandbits(60)
        for t, x in enumerate((a, b)):
            for i, w in x.items():
                text.append(t), runs.append(base + i * 7919), weight.append(w)
        got = bag_minhash(np.array(text), tx.mix(np.array(runs, dtype=np.uint64)), np.array(weight), 2)
        both = sum(min(a[i], b.get(i, 0)) for i in a)
        pairs.append(((got[0] == got[1]).mean(), both / (sum(a.values()) + sum(b.values()) - both)))
    error = np.array([x - y for x, y in pairs])
    assert abs(error.mean()) < 0.012 and error.std() < 0.06


def test_bag_has_weights_and_short_texts():
    data = np.frombuffer(b"a b c d e a b c d e x y", dtype=np.uint8)
    words = tx.words_of(data, np.array([0, 20, 23, 23]))
    text, runs, weight = bag(words, 3, 5)
    assert sorted(zip(text.tolist(), weight.tolist())) == [(0, 1)] * 4 + [(0, 2), (1, 1)]
    assert len(set(runs.tolist())) == 6


def test_edge_rows(spark):
    text = " ".join("w%d" % i for i in range(40))
    rows = [(None, text, 1), (7, text, 2), (7, text, 2), (3, text + " more", 3), (9, None, 4), (9, None, 4), (None, "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, band int")
    got = Counter((r.doc_id, r.group_id) for r in near_groups(df).collect())
    assert got == Counter([(None, 3), (7, 3), (7, 3), (3, 3), (9, 9), (9, 9), (None, None)])
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert Counter(tuple(r) for r in kept.collect()) == Counter([rows[3], rows[4], rows[5], rows[6]])
    assert near_groups(df.limit(0)).collect() == [] and keep_one_per_group(df.limit(0)).collect() == []


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(80)] + [(5, 5)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for p in links for x in p}
    for _ in range(300):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
