"""Language ID: held-out accuracy, the machines, edge rows."""

import random
import zlib

import numpy as np

from paymart.llm.language_id import Hierarchy, OneVersusOne, features, identify_languages, lowered

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in identify_languages(docs).collect() if r.lang is not None]
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_hierarchy_on_points():
    rnd = np.random.default_rng(1)
    centre = {"en": [3, 1, 0], "de": [3, -1, 0], "fr": [-3, 0, 1], "es": [-3, 0, -1], "xx": [0, 6, 0]}
    names = np.array(sorted(centre))[rnd.integers(0, 5, 600)]
    x = np.array([centre[n] for n in names]) + rnd.normal(0, 0.2, (600, 3))
    model = Hierarchy.fit(x.astype(np.float32), names)
    lang, clear = model.predict(x.astype(np.float32))
    assert (lang == names).mean() > 0.99 and model.families.classes == ["germanic", "romance", "xx"]
    assert clear.min() >= 0 and clear.max() <= 1
    only, sure = OneVersusOne.fit(x[:3].astype(np.float32), np.array(["a"] * 3)).predict(x.astype(np.float32))
    assert set(only) == {0} and set(sure) == {1.0}


def test_features_do_not_cross_texts():
    data = np.frombuffer("ABcdÉx".encode(), dtype=np.uint8)
    assert bytes(lowered(data)).decode() == "abcdéx"
    both = features(data, np.array([0, 2, 2, len(data)]))
    assert np.allclose(both[0], features(data[:2], np.array([0, 2]))[0])
    assert not both[1].any() and np.allclose(both[2], features(data[2:], np.array([0, len(data) - 2]))[0])


def test_edge_rows(spark):
    rows = [(None, "the house and the garden", "en", "q")] * 2 + [(i, "la maison et le jardin", "fr", "q") for i in range(9)]
    rows += [(20, None, "en", "q"), (21, "123 !?", "en", "q"), (22, "the", None, "q"), (23, "the the " * 40_000, "en", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = identify_languages(df)
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    got = {(r.doc_id, r.lang_pred) for r in out.collect()}
    assert {(20, "und"), (21, "und"), (22, "en"), (23, "en"), (None, "en"), (0, "fr")} <= got
    assert identify_languages(df.limit(0)).collect() == []
    unknown = identify_languages(df.withColumn("lang", df.lang.substr(9, 1)).where("lang IS NULL")).collect()
    assert {r.lang_pred for r in unknown} <= {"und"}


def test_a_rare_language_keeps_its_share_of_the_sample(spark):
    """More rows wanted than the limit: each language gives in proportion."""
    rnd = random.Random(6)
    rows = []
    for k in range(13):
        letters = [rnd.choice("abcdefghijklmnopqrstuvwxyz") + rnd.choice("aeiouxyz") + chr(97 + k) for _ in range(12)]
        rows += [(1000 * k + i, " ".join(rnd.choices(letters, k=40)), f"x{k:02d}") for i in range(25 if k == 12 else 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [r for r in identify_languages(df, per_language=20, limit=90).collect()]
    rare = [r for r in got if r.lang == "x12"]
    assert sum(r.lang_pred == "x12" for r in rare) >= 0.9 * len(rare)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.9 * len(got)
