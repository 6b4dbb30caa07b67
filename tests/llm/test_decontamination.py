"""Benchmark decontamination: planted leaks, re-parameterised items, edge rows."""

import random

from paymart.llm.decontamination import judge_documents

SF = "/root/testdata/sf0.01"


def judged(spark, texts, items, **how):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, items int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: (r.contaminated, r["items"]) for r in judge_documents(docs, bench, **how).collect()}


def test_planted_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    want = {i: sorted(k for k, x in items.items() if x in t) for i, t in texts.items()}
    got = {r.doc_id: r["items"] for r in judge_documents(docs, bench).collect()}
    assert got == want and any(want.values())


def test_parameters_and_consistency(spark):
    item = "If Alice buys 12 apples and 7 pears for 12 dollars each then how many dollars does Alice spend in total today"
    again = "Well: if Robert buys 31 apples and 5 pears for 31 euros each, then how many euros does Robert spend in total today?"
    broken = "if Robert buys 31 apples and 5 pears for 99 euros each then how many miles does Lucy spend in total today"
    other = "the quick brown fox walks over the hill and then how many times does it turn round before it goes home again"
    got = judged(spark, [again, broken, other, item.upper(), None, "", item, item], [(5, item), (None, item), (6, None), (7, "")])
    assert got[0] == got[6] == got[7] == (True, [5])
    assert [got[i][0] for i in (1, 2, 4, 5)] == [False] * 4


def test_short_items_long_texts_and_blocks(spark, monkeypatch):
    from paymart.llm import decontamination
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rnd.choice([5, 6, 8, 20])))) for i in range(12)]
    filler = [word() for _ in range(30_000)]
    texts = [" ".join(filler), " ".join(filler[:20_000] + items[3][1].split() + filler[20_000:]), items[0][1]]
    texts += [" ".join([word(), t, word()]) for _, t in items]
    want = {i: (bool(k), k) for i, t in enumerate(texts) for k in [[n for n, x in items if f" {x} " in f" {t} "]]}
    assert judged(spark, texts, items) == want
    monkeypatch.setattr(decontamination, "BLOCK", 10)
    assert judged(spark, texts, items) == want


def test_empty_tables(spark):
    assert judged(spark, [], [(1, "a b c d e f g h i")]) == {}
    assert judged(spark, ["a b c d e f g h i"], []) == {0: (False, [])}


def test_copies_in_another_case(spark):
    item = "If Alice buys 12 apples and 7 pears for 12 dollars each then how many dollars does Alice spend in total today"
    names = "Ann Bob Carl Dora Émile Straße Gil Hanna In 1999 And 2001 Met Iris Jon"
    items = [(5, item), (8, names)]
    texts = [t for x in (item, names) for t in (x.upper(), x.lower(), f"so, {x.upper()}! and more", x.swapcase())]
    got = judged(spark, texts + ["if alice buys pears"], items)
    assert [got[i] for i in range(9)] == [(True, [5])] * 4 + [(True, [8])] * 4 + [(False, [])]


def test_planted_passages_in_capitals(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id IN (1699, 6420, 8376)")
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    got = {r.doc_id: r["items"] for r in judge_documents(docs.select("doc_id", "text"), bench).collect()}
    assert got == {1699: [130], 6420: [37], 8376: [101]}


def test_values_repeated_by_chance(spark):
    pears = "Tom has 3 apples and 3 pears in one large basket so how many pieces of fruit does Tom carry home"
    dogs = "The old dog sleeps by the door all day while The young cat hunts small mice in the garden all night long"
    many = ("in 3 towns with 3 shops and 4 mills and 4 barns there are so many people who walk along the long road to the "
            "market every single week of the year that nobody has ever tried to count all of them by hand before")
    texts = [pears.replace("Tom", "Jim").replace("3 apples", "4 apples").replace("3 pears", "6 pears"),
             dogs.replace("while The", "while A"),
             many.replace("3 towns", "5 towns").replace("3 shops", "6 shops").replace("4 mills", "7 mills").replace("4 barns", "8 barns"),
             # the same template, but what repeats in the item doesn't here
             "Jim has 4 apples and 6 pears in one large basket so how many pieces of fruit does Eve carry home"]
    got = judged(spark, texts, [(1, pears), (2, dogs), (3, many)])
    assert got == {0: (True, [1]), 1: (True, [2]), 2: (True, [3]), 3: (False, [])}


def test_passages_of_long_items(spark):
    words = [f"{a}{b}o" for a in "bdfgklmnprst" for b in "aeiou"]
    item = " ".join(words)
    texts = [" ".join(["before", *words[10:10 + n], "after"]) for n in (30, 20, 19, 60)]
    # two halves of a passage, apart
    texts += [" ".join([*words[:15], "other", *words[30:45]]), " ".join(words[20:45]).upper()]
    got = judged(spark, texts, [(1, item)])
    assert [got[i][0] for i in range(6)] == [True, True, False, True, False, True]
