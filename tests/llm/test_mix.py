"""Temperature mixing: exponent, quotas, and the schedule's blocks."""

import math
from collections import Counter, defaultdict

import pytest

from sitefold.llm import temperature_mix as M

DOCS = "doc_id long, text string, source string, n_tokens string, block string"


def frame(spark, sizes, repeat=1):
    """sizes: {source: (documents, words each)}"""
    rows, k = [], 0
    for source, (count, words) in sizes.items():
        for _ in range(count):
            rows += [(k, "w " * words, source, "x", "y")] * repeat
            k += 1
    return spark.createDataFrame(rows, DOCS)


def entropy(tokens, exponent):
    p = [t**exponent for t in tokens]
    p = [x / sum(p) for x in p]
    return -sum(x * math.log(x) for x in p) / math.log(len(p))


SIZES = {"big": (60, 50), "mid": (30, 20), "small": (20, 5), None: (10, 3)}
TOKENS = {s: n * w for s, (n, w) in SIZES.items()}


def planned(spark, **options):
    docs = frame(spark, SIZES)
    sized = docs.select("doc_id", "source", M.token_size(docs.text).alias("n_tokens"))
    return sized, M.plan(sized, **options)


def test_exponent_is_the_largest_that_reaches_the_entropy(spark):
    _, mixture = planned(spark, target_entropy=0.8, max_repeats=None)
    tokens = list(TOKENS.values())
    assert entropy(tokens, mixture.exponent) >= 0.8 - 1e-9 > entropy(tokens, mixture.exponent + 2e-6) - 1e-6
    _, same = planned(spark, target_entropy=0.0, max_repeats=None)
    assert same.exponent == 1.0


def test_repetition_limit_wins(spark):
    _, mixture = planned(spark, target_entropy=1.0, max_repeats=3.0)
    spread = max(t ** (mixture.exponent - 1) for t in TOKENS.values()) / min(t ** (mixture.exponent - 1) for t in TOKENS.values())
    assert 2.99 < spread <= 3.0 + 1e-9
    assert max(r.quota / r.tokens for r in mixture.sources.collect()) < 3.1


@pytest.mark.parametrize("blocks", [1 << 20, 200])
def test_schedule(spark, monkeypatch, blocks):
    monkeypatch.setattr(M, "BLOCK_TOKENS", blocks)
    sized, mixture = planned(spark, target_entropy=0.95, max_repeats=4.0)
    rows = M.schedule(sized, mixture).collect()
    quota = {r.source: r.quota for r in mixture.sources.collect()}
    dealt = Counter()
    for r in rows:
        dealt[r.source] += r.n_tokens
    times = Counter((r.doc_id, r.source) for r in rows)
    assert len(times) == 120, "every document is dealt out"
    for source, (count, words) in SIZES.items():
        assert quota[source] <= dealt[source] < quota[source] + words
        own = [n for (_, s), n in times.items() if s == source]
        assert max(own) - min(own) <= 1
    # Each epoch deals every block once, in its own order, and offsets add up.
    slots = defaultdict(set)
    for r in rows:
        slots[r.source, r.epoch].add((r.slot, r.block, r.source_offset))
    for found in slots.values():
        ordered = sorted(found)
        assert [s for s, _, _ in ordered] == list(range(1, len(ordered) + 1))
        assert len({b for _, b, _ in ordered}) == len(ordered)
    if blocks == 200:
        orders = [tuple(b for _, b, _ in sorted(slots["mid", e])) for e in (1, 2) if ("mid", e) in slots]
        assert len(slots["big", 1]) > 5 and (len(orders) < 2 or orders[0] != orders[1])


def test_budget_cuts_inside_a_block(spark):
    docs = frame(spark, SIZES)
    rows = M.mix(docs, budget=600).collect()
    assert 600 <= sum(r.n_tokens for r in rows) < 600 + 50 + 20 + 5 + 3
    assert sorted(M.mix(docs, budget=600).collect()) == sorted(rows)


def test_odd_rows(spark):
    rows = [(1, None, "a", "x", "y"), (2, "", "a", "x", "y"), (None, "w", None, "x", "y"), (3, "", "empty", "x", "y"), (4, "w w", "a", "x", "y"), (4, "w w", "a", "x", "y")]
    got = Counter((r.doc_id, r.source) for r in M.mix(spark.createDataFrame(rows, DOCS)).collect())
    assert set(got) == {(1, "a"), (2, "a"), (None, None), (3, "empty"), (4, "a")} and got[4, "a"] >= 2
    assert M.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert M.mix(frame(spark, {"only": (5, 10)})).count() == 5


def test_no_python_on_the_executors(spark):
    plan = M.mix(frame(spark, SIZES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_exponents_are_tried_without_a_sort(spark):
    """Rows come back in the order of their exponents, and no job of the search sorts them on the executors."""
    totals = spark.createDataFrame([(900, 1000.0), (100, 1000.0)], "tokens long, all_tokens double")
    spark.sparkContext.setJobGroup("measures", "measures")
    try:
        found = M._measures(totals, [0.5, 0.0, 1.0, 0.25])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.exponent for r in found] == [0.0, 0.25, 0.5, 1.0]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("measures")) <= 2
