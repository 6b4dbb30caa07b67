"""LM scoring: gradients, better than frequencies on unseen text, edge rows."""

import collections
import random

import numpy as np

from paymart.llm import lm_scoring as lm

SF = "/root/testdata/sf0.01"


def test_gradient_matches_differences():
    rnd = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm.initial(rnd.random(lm.SIDE**2) + 0.1).items()}
    line, at = lm.padded(rnd.integers(0, lm.SIDE**2, 30).astype(np.int32), np.repeat([0, 1, 3], 10), 4)
    loss = lambda: -lm.log_probs(p, line, at).sum()
    g = lm._gradient(p, line, at)
    for k in lm.SHAPES:
        flat, grad = p[k].reshape(-1), np.asarray(g[k]).reshape(-1)
        for i in np.argsort(-np.abs(grad))[[0, 3]]:
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-5 - grad[i]) < 1e-2 * max(1, abs(grad[i])), k


def test_probabilities_sum_to_one():
    p = lm.initial(np.ones(lm.SIDE**2))
    line, at = lm.padded(np.array([5, 6, 7], dtype=np.int32), np.zeros(3, dtype=int), 1)
    total = 0.0
    for token in range(lm.SIDE**2):
        line[at[1]] = token
        total += np.exp(lm.log_probs(p, line, at)[1])
    assert abs(total - 1) < 1e-3


def test_learns_and_ranks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("lang = 'en'")
    seen, unseen = docs.where("doc_id % 4 <> 0"), docs.where("doc_id % 4 = 0")
    texts = seen.select("text")
    vocabulary = lm.build_vocabulary(texts)
    start = lm.pack(lm.initial(vocabulary.frequency))
    trained = lm.train(texts, vocabulary, rounds=2)
    mixed = [(r.doc_id, " ".join(random.Random(1).sample(r.text.split(), len(r.text.split()))))
             for r in unseen.where("text IS NOT NULL").collect()]
    shuffled = spark.createDataFrame(mixed, "doc_id long, text string")

    def mean(df, flat):
        return lm.score_documents(df, model=(vocabulary, flat)).selectExpr("sum(log_prob) / sum(n_tokens)").first()[0]

    assert mean(unseen, trained) > mean(unseen, start) + 0.02
    assert mean(unseen, trained) > mean(shuffled, trained) + 0.02


def test_edge_rows(spark):
    rows = [(1, None, 1.0), (1, " \n", 2.0), (None, "a b c", 3.0), (2, "a b c", 4.0), (3, "x " * 50_000, 5.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, log_prob double")
    got = sorted(((r.n_tokens, r.log_prob, r.mean_log_prob) for r in lm.score_documents(df).collect()), key=str)
    assert [x[0] for x in got] == [0, 0, 3, 3, 50_000]
    assert got[0][1:] == (0.0, None) and got[2] == got[3] and got[4][1] < 0
    assert lm.score_documents(df.limit(0)).collect() == []


def test_words_of_a_shared_token(spark, monkeypatch):
    """Each word's share of its token against brute force, unseen words below
    seen ones, the same through the join."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i % 70, " ".join(rnd.choices(words, k=300)) + (" once" + str(i)) * (i % 2)) for i in range(80)]
    rows += [rows[1], (7, None), (8, "never heard of this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    count = collections.Counter(w for _, t in rows[:-2] for w in t.split())
    hashed = lambda w: lm.tx.words_of(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w)])).hashes

    def scores(common):
        monkeypatch.setattr(lm, "COMMON", common)
        texts = docs.where("doc_id <> 8 OR text <> 'never heard of this'").select(lm.F.coalesce("text", lm.F.lit("")))
        vocabulary = lm.build_vocabulary(texts)
        flat = lm.pack(lm.initial(vocabulary.frequency))
        assert (vocabulary.counts is None) == (common > 5000) and len(vocabulary.common) <= common
        out = lm.score_documents(docs, model=(vocabulary, flat)).collect()
        return vocabulary, flat, sorted((r.doc_id, r.text or "", r.n_tokens, r.log_prob) for r in out)

    vocabulary, flat, got = scores(1 << 18)
    token = {w: int(vocabulary.tokens(hashed(w))[0]) for w in count}
    inside, kinds = collections.Counter(), collections.Counter(token.values())
    for w, n in count.items():
        inside[token[w]] += n
    p = lm.unpack(flat)
    for _, text, n, log_prob in got:
        ids = [token.get(w, int(vocabulary.tokens(hashed(w))[0])) for w in text.split()]
        line, at = lm.padded(np.array(ids, dtype=np.int32), np.zeros(len(ids), dtype=int), 1)
        want = lm.log_probs(p, line, at).sum() if ids else 0.0
        want += sum(np.log((count[w] + lm.ADD) / (inside[t] + lm.ADD * (kinds[t] + 1)))
                    for w, t in zip(text.split(), ids) if t >= lm.TOP)
        assert n == len(ids) and abs(want - log_prob) < 1e-3 * max(1, n)
    for common in (0, 900, 2000):
        again = scores(common)[2]
        assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, a[2]) for a, b in zip(got, again))
        assert len(again) == len(got)


def test_invented_words_score_below_seen_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    vocabulary = lm.build_vocabulary(docs.select("text"))
    flat = lm.pack(lm.initial(vocabulary.frequency))
    seen = [w for r in docs.where("text IS NOT NULL").limit(50).collect() for w in r.text.split()]
    hashes = [lm.tx.words_of(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w.encode())])).hashes[0] for w in seen]
    tokens = vocabulary.tokens(np.array(hashes, dtype=lm.tx.U64))
    rare = {int(t): w for t, w in zip(tokens, seen) if t >= lm.TOP}
    new = {}
    for i in range(20_000):
        w = f"qzx{i}"
        new.setdefault(int(vocabulary.tokens(lm.tx.words_of(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w)])).hashes)[0]), w)
    both = sorted(rare.keys() & new.keys())
    rows = [(t, w) for t in both for w in (rare[t], new[t])]
    df = spark.createDataFrame(rows, "token long, text string").repartition(2)
    got = {r.text: r.log_prob for r in lm.score_documents(df, model=(vocabulary, flat)).collect()}
    assert len(both) > 100 and all(got[new[t]] < got[rare[t]] for t in both)
