"""Quality classifier: site posteriors against brute force, labels left out of
the fit, edge rows."""

import random
from collections import defaultdict
from math import log

from paymart.llm import quality_classifier as qc

SF = "/root/testdata/sf0.1"


def brute_shifts(rows):
    """Shift of each (host, path): shrunken log-odds less the global ones."""
    paths = defaultdict(list)
    for host, path, p in rows:
        paths[host, path].append(p)

    def logit(p):
        p = min(max(p, 1e-4), 1 - 1e-4)
        return log(p / (1 - p))

    def worth(groups):  # (documents, mean, mean of the level above)
        n = sum(g[0] for g in groups)
        between = (sum(k * (m - of) ** 2 for k, m, of in groups) - sum(of * (1 - of) for _, _, of in groups)) / n
        return min(max(sum(k * of * (1 - of) for k, _, of in groups) / n / max(between, 1e-6), 1.0), 1e6)

    hosts = defaultdict(list)
    for (host, _), ps in paths.items():
        hosts[host] += ps
    overall = sum(p for _, _, p in rows) / len(rows)
    k = worth([(len(ps), sum(ps) / len(ps), overall) for ps in hosts.values()])
    mean = {h: (sum(ps) + k * overall) / (len(ps) + k) for h, ps in hosts.items()}
    k = worth([(len(ps), sum(ps) / len(ps), mean[h]) for (h, _), ps in paths.items()])
    return {(h, p): logit((sum(ps) + k * mean[h]) / (len(ps) + k)) - logit(overall) for (h, p), ps in paths.items()}


def test_site_posteriors_by_brute_force(spark):
    rnd = random.Random(3)
    base = {f"h{i}": rnd.random() for i in range(8)}
    rows = [(h, f"p{j}", min(1.0, max(0.0, rnd.gauss(b, 0.3)))) for h, b in base.items() for j in range(4)
            for _ in range(rnd.choice([1, 3, 40]))]
    df = spark.createDataFrame(rows, "__site_host string, __site_path string, p_good double").repartition(3)
    got = {(r[0], r[1]): r["shift"] for r in qc.site_posteriors(df).collect()}
    want = brute_shifts(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert max(want.values()) > 0.2 and min(want.values()) < -0.2
    assert qc.site_posteriors(df.limit(0)).collect() == []


def test_labels_left_out_of_the_fit(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    half = "pmod(xxhash64('held', doc_id), 2) = "
    out = {r.doc_id: r for r in qc.classify_quality(docs, labels.where(half + "0")).collect()}
    held = [(r, out[r.doc_id]) for r in labels.where(half + "1").collect() if r.doc_id in out]
    toxic = [d for r, d in held if r.toxic == 1]
    clean = [d for r, d in held if r.toxic == 0 and r.quality == 1]
    poor = [d for r, d in held if r.quality == 0]
    shares = [sum(d.p_toxic > 0.5 for d in toxic) / len(toxic), sum(not d.kept for d in toxic) / len(toxic),
              sum(not d.kept for d in poor) / len(poor), sum(d.kept for d in clean) / len(clean)]
    assert min(shares) > 0.75, shares


def test_edge_rows(spark):
    rows = [(i, f"{'good kind word' if i % 2 else 'bad vile thing'} number{i}", "s", "en", "mine") for i in range(80)]
    rows += [rows[3], (None, None, None, None, "mine"), (500, "", None, "en", "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, kept string")
    schema = "doc_id long, quality int, toxic int"
    given = [(i, i % 2, 1 - i % 2) for i in range(60)]
    odd = [(None, 1, 1), (None, 0, 0), (70, None, None), (71, None, None)]
    judge = lambda labels: sorted((r.doc_id or -1, r.p_quality, r.p_toxic, r.p_good, r.kept)
                                  for r in qc.classify_quality(docs, spark.createDataFrame(labels, schema)).collect())
    got = judge(given)
    assert len(got) == len(rows) and all(isinstance(r[4], bool) for r in got)
    assert [r for r in got if r[0] == 3][0] == [r for r in got if r[0] == 3][1]
    assert all(r[4] == (r[0] % 2 == 1) and (r[2] > 0.5) == (r[0] % 2 == 0) for r in got if 0 <= r[0] < 80)
    # labels without an id or a value teach nothing
    assert judge(given + odd) == got
    for labels in ([], [(i, 1, 0) for i in range(30)], odd):
        assert all(r[1:3] == (0.5, 0.0) and r[4] for r in judge(labels))
    out = qc.classify_quality(docs, spark.createDataFrame(given, schema))
    assert out.columns == ["doc_id", "text", "source", "lang", "p_quality", "p_toxic", "p_good", "kept"]
    assert qc.classify_quality(docs.limit(0), spark.createDataFrame(given, schema)).collect() == []
