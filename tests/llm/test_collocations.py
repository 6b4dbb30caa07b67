"""Collocations against brute force over whole texts."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from paymart.llm import collocations
from paymart.llm.collocations import chunk_spans, cut_score, mine_collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def phrases(rows, words):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(w)
            for k in range(1, words + 1):
                counts.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return counts, totals


def brute(rows, words=3, min_count=10, top=2000, share=50):
    counts, totals = phrases(rows, words)
    cand = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= min_count}
    longer = Counter()
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i:i + k]] = max(longer[lang, p[i:i + k]], a)
    found = {}
    for (lang, p), a in cand.items():
        if 100 * longer[lang, p] < share * a:
            cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
                  for lang, all_ in found.items() for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top]))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = mine_collocations(df, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def random_rows(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "c", "Ä", "ß", "日本", "d-e", "x" * 30, " ", "\x1c"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n", "!?", "\x0b"]
    passage = "".join(rnd.choice(vocabulary) + rnd.choice(gaps) for _ in range(90))
    rows = []
    for _ in range(n):
        text = "".join(rnd.choice(vocabulary) + rnd.choice(gaps) for _ in range(rnd.randint(0, 60)))
        rows.append((text + passage * rnd.choice([0, 0, 1, 2]), rnd.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" .\n", "en"), ("a a a", "fr")]


def test_random_texts(spark):
    rows = random_rows(1)
    for kw in ({}, {"min_count": 3}, {"words": 2}, {"words": 5, "min_count": 4, "share": 80}, {"top": 5}):
        assert run(spark, rows, **kw) == brute(rows, **kw)
    assert run(spark, rows, words=1) == []


def test_full_bitmap_only_costs_time(spark):
    rows = random_rows(2)
    assert run(spark, rows, bits=1 << 15) == brute(rows)


def test_long_and_hot_texts(spark):
    rows = [("ha " * 200_000, "en"), ("ha ho " * 3000, "en")] + [("the same line again.", "en")] * 500
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = random_rows(3)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "text string, lang string, n int, chunk int, freq int")
    assert sorted(map(tuple, mine_collocations(df).collect())) == brute(rows)


def test_parse_covers_each_word_once():
    rnd = np.random.default_rng(5)
    for longest in (4, 1000):
        texts = [b" ".join(rnd.choice([b"a", b"b", b"c", b"d"], n)) for n in rnd.integers(0, 200, 50)]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        owned = Counter()
        for text, begin, end, last, n in chunk_spans(data, offsets, 2, 4, longest):
            words = data[begin:end].tobytes().split()
            assert n == len(words) - (0 if last else 2) and n > 0
            owned[text] += n
        assert [owned[i] for i in range(len(texts))] == [len(t.split()) for t in texts]


def test_equal_passages_give_equal_chunks():
    rnd = np.random.default_rng(6)
    passage = b" ".join(b"%d" % x for x in rnd.integers(0, 50, 400))
    texts = [b"one two " + passage, b"three " + passage + b" four"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.array([0, len(texts[0]), len(data)])
    chunks = [(t, data[b:e].tobytes()) for t, b, e, _, _ in chunk_spans(data, offsets, 2, 8)]
    one, two = ({c for t, c in chunks if t == i} for i in (0, 1))
    assert len(one & two) >= len(one) - 3 > 20


def test_large_counts_are_exact(spark):
    rows = [(10**14 - 1, 10**15 - 3, 10**14 + 7), (999_999_999_999, 10**12 + 1, 10**12 + 9), (10, 10, 10), (1, 10**15 - 1, 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (l * r) for a, l, r in rows]


def test_pieces_of_a_batch_add_up(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BATCH_BYTES", 100)
    rows = random_rows(4, 60)
    assert run(spark, rows, min_count=5) == brute(rows, min_count=5)
