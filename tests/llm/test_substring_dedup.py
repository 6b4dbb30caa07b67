"""Substring dedup against brute force, and its edge cases."""

import random

import pytest

from paymart.llm.substring_dedup import dedup_substrings
from paymart.llm.suffix_automaton import SuffixAutomaton


def brute(texts, width):
    seqs = [(t or "").encode().split() for t in texts]
    seen = {}
    for seq in seqs:
        for i in range(len(seq) - width + 1):
            seen[tuple(seq[i:i + width])] = seen.get(tuple(seq[i:i + width]), 0) + 1
    out = []
    for seq in seqs:
        gone = set()
        for i in range(len(seq) - width + 1):
            if seen[tuple(seq[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(seq), len(gone), b" ".join(w for i, w in enumerate(seq) if i not in gone).decode()))
    return out


def run(spark, texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    return [tuple(r[1:]) for r in sorted(dedup_substrings(df, **how)
                                         .select("doc_id", "n_words", "n_removed", "kept_text").collect())]


def corpus(seed, n, vocab, longest):
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, longest))]
        if texts and rnd.random() < 0.6:  # a passage of an earlier text
            other = (rnd.choice(texts) or "").split()
            a = rnd.randint(0, len(other))
            at = rnd.randint(0, len(words))
            words[at:at] = other[a:a + rnd.randint(0, 25)]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(words))
    return texts + [None, "", "  \n", texts[0], texts[0]]


@pytest.mark.parametrize("seed,vocab", [(1, "abc"), (2, "abcdefghijklmnop"), (3, "a")])
@pytest.mark.parametrize("hot", [1000, 2])
def test_matches_brute_force(spark, seed, vocab, hot):
    texts = corpus(seed, 25, list(vocab), 40)
    assert run(spark, texts, width=7, anchor=3, hot=hot) == brute(texts, 7)


def test_production_width(spark):
    rnd = random.Random(5)
    word = lambda: "w%d" % rnd.randint(0, 10**6)
    passage = [word() for _ in range(60)]
    texts = [" ".join([word() for _ in range(rnd.randint(0, 50))] + passage + [word() for _ in range(20)])
             for _ in range(30)]
    texts += [" ".join([word()] + passage[:34] + [word()]), " ".join([word()] + passage[:35] + [word()]),
              " ".join([word() for _ in range(3000)]), "the " * 2000, "é ü " * 100]
    assert run(spark, texts) == brute(texts, 35)
    assert run(spark, texts, hot=5) == brute(texts, 35)


def test_extra_and_clashing_columns(spark):
    text = " ".join(str(i) for i in range(50))
    df = spark.createDataFrame([(None, text, 7, "x"), (1, text, 8, None)],
                               "doc_id long, text string, n_words int, m string")
    rows = dedup_substrings(df).collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in rows] == [(50, 50, "")] * 2
    assert {r.m for r in rows} == {"x", None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(df).collect() == []


def test_automaton_counts():
    automaton = SuffixAutomaton([(list("abcab"), 1), (list("xabcx"), 2)])
    assert automaton.repeated(list("zabcabz"), 3) == [1]
    assert automaton.repeated(list("cab"), 3) == []
    assert automaton.repeated(list("cab"), 2) == [1]
