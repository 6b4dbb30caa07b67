"""The pipeline: each stage against a brute-force version of it on its own
input, the columns that go on, edge rows."""

from collections import Counter

import pytest

import corpus_pipeline

from .test_near_dedup import brute_groups
from .test_source_mixing import draw
from .test_substring_dedup import brute as brute_cut

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, frame = [docs.collect()], docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SF)
        rows.append(out.collect())
        frame = spark.createDataFrame(rows[-1], out.schema)
    return rows


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "substring dedup", "benchmark decontamination",
        "mixing sources to target weights"]
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == COLUMNS
    assert list(stages[-1][0].asDict()) == COLUMNS + ["copy_no"]


def test_quality_stage(spark):
    """On a table with some hundred labels: clean documents stay, bad ones go."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, sf).collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    bad = [i for i, r in labels.items() if r.quality == 0 or r.toxic == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.25 * len(bad)


def test_near_dedup_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    assert sorted(r.doc_id for r in stages[2]) == sorted({g for _, g in brute_groups(rows)})


def test_substring_stage(stages):
    before = sorted(stages[2], key=lambda r: r.doc_id)
    after = {r.doc_id: r.text for r in stages[3]}
    assert len(after) == len(before)
    for r, (_, gone, kept) in zip(before, brute_cut([r.text for r in before], 35)):
        assert after[r.doc_id] == (kept if gone else r.text)


def test_decontamination_stage(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages[3] if not any(" ".join(x.split()) in " ".join(r.text.split()) for x in items)}
    assert {r.doc_id for r in stages[4]} == clean


def test_mixing_stage(stages):
    n = Counter(r.source for r in stages[4])
    rows, roots = sum(n.values()), sum(v**0.5 for v in n.values())
    want = {r.doc_id: k for r in stages[4] if (k := draw(r.doc_id, rows * n[r.source]**0.5 / roots / n[r.source]))}
    assert Counter(r.doc_id for r in stages[5]) == Counter(want)


def test_edge_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", None, None, 0), (7, " ", "", "", 1),
                                 (7, " ", "", "", 1), (9, "word " * 30_000, "xx", None, None)], docs.schema)
    frame = odd
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        assert frame.columns[:5] == COLUMNS
        frame.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).collect() == []
