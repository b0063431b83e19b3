"""The pipeline against a brute-force version of what its stages promise, and odd tables."""

import pytest
from test_decontaminate import brute as contaminated
from test_jaccard_join import brute as components

import corpus_pipeline as C
from sitefold.llm import preference_quality, quality_rules
from sitefold.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    everything = docs
    stages = dict(C.STAGES)
    assert list(stages) == ["quality_classifier", "quality_rules", "near_copies", "decontamination", "mixing"]
    for name in list(stages)[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stages[name](spark, docs, SMALL)
        assert after.columns == everything.columns
        kept = {r.doc_id for r in after.collect()}
        assert kept <= set(before)
        if name == "quality_classifier":
            scores = QUERIES["op2_preference_quality"](spark, SMALL).collect()
            assert kept == {r.doc_id for r in scores if r.predicted == 1}
        if name == "quality_rules":
            verdicts = {r.doc_id: r.kept for r in QUERIES["op9_quality_rules"](spark, SMALL).collect()}
            assert kept == {i for i in before if verdicts[i]}
        if name == "near_copies":
            assert kept == {i for i, n, least in components(sorted(before.items())) if i == least or n == 0}
        if name == "decontamination":
            assert kept == {i for i, text in before.items() if not contaminated(text, items)[4]}
        docs = everything.where(everything.doc_id.isin(sorted(kept)))
    mixed = stages["mixing"](spark, docs, SMALL)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("name, stage", C.STAGES)
def test_odd_rows(spark, name, stage):
    rows = [
        (1, None, None, None, None, "k"), (None, "a text without an id " * 3, "en", "s", 1, "k"), (2, "", "en", "s", 0, "k"),
        (3, "long " * 30000, "en", "s", 1, "k"), (4, "repeated row " * 9, "en", None, 1, "k"), (4, "repeated row " * 9, "en", None, 1, "k"),
    ]
    odd = stage(spark, spark.createDataFrame(rows, DOCS), SMALL)
    none = stage(spark, spark.createDataFrame([], DOCS), SMALL)
    assert none.count() == 0 and odd.count() <= len(rows) + 20
    if name != "mixing":
        assert odd.columns == none.columns == [c.split()[0] for c in DOCS.split(", ")]
