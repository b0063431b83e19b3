"""Quality rules and the preference ranking: counts by brute force, models on held-out rows, odd rows."""

import random
import re
import tracemalloc
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sitefold.llm import preference_quality as P
from sitefold.llm import quality_rules as Q
from sitefold.llm.common import WordHash

DOCS = "doc_id long, text string, score string, kept string"
LABELS = "doc_id long, quality int, toxic int, lang string"
GOOD = "the of and to in that was it for on are as with his they at be this from have".split()


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


TEXTS = [
    None, "", " \n\t\x0b", "one", "a b c d e f\na b c d e f\n\na b c d e f", "é😀 ## <b> x|y $5 & 7%\n" * 3, "x\r\nx\r\n x",
    " ".join("abc"[k % 3] for k in range(40)), "\n\n", "a b c d e a b c d e f", "w " * 9, "a b c d",
]


@cache
def corpus():
    draw = random.Random(2)
    docs, labels = [], []
    for k in range(400):
        words = [draw.choice(GOOD) + draw.choice(["", "", "ing", "ed", ","]) for _ in range(draw.randrange(20, 120))]
        good = k % 4 != 0
        if not good:
            words = [w.upper() + "!!" if k % 8 else w + "###" for w in words]
        docs.append((k, " ".join(words)))
        labels.append((k, int(good)))
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    rows = [*docs, *((1000 + k, t) for k, t in enumerate(TEXTS)), (None, "text without an id"), (5, docs[5][1])]
    extra = [(0, 1), (0, 0), (None, 1), (7777, 0), (3, None)]
    return (
        spark.createDataFrame([(*r, "s", "k") for r in rows], DOCS),
        spark.createDataFrame([(*r, 0, "en") for r in [*labels, *extra]], LABELS),
    )


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    raw = (text or "").encode()
    words = raw.split()
    assert Q.base_counts(raw, WordHash().of(words), words) == counts(text)


def test_random_counts():
    draw = random.Random(8)
    for _ in range(200):
        text = "".join(draw.choice(["a", "b", "c ", " ", "\n", "é ", "# "]) for _ in range(draw.randrange(80)))
        raw = text.encode()
        assert Q.base_counts(raw, WordHash().of(raw.split()), raw.split()) == counts(text)


def test_rules_keep_good_and_reject_bad(spark):
    docs, labels = frames(spark)
    model = Q.train(docs, labels)
    found = Q.assess(docs, model).collect()
    assert len(found) == docs.count()
    known = dict(corpus()[1])
    for r in found:
        n, chars, symbols, dup, repeat = counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (not r.base_failed and r.probability >= Q.KEEP_AT)
    judged = [(r.kept, known[r.doc_id]) for r in found if r.doc_id in known and not r.base_failed]
    assert np.mean([kept == bool(label) for kept, label in judged]) > 0.97
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)


def test_probabilities_are_calibrated():
    draw = np.random.default_rng(1)
    margins = draw.normal(size=4000)
    labels = (draw.random(4000) < 1 / (1 + np.exp(-(3 * margins - 1)))).astype(float)
    slope, offset = Q.calibrate(margins, labels)
    assert abs(slope - 3) < 0.4 and abs(offset + 1) < 0.3


def test_training_keeps_the_real_share_of_labels(spark):
    draw = random.Random(6)
    docs, labels = [], []
    for k in range(1200):
        good = draw.random() < 0.85
        share = 0.6 if good else 0.4  # labels overlap, so that texts in between are doubtful
        words = ["".join(draw.choice("aeiou" if draw.random() < share else "bcdfg") for _ in range(4)) for _ in range(14)]
        docs.append((k, " ".join(words), "s", "k"))
        labels.append((k, int(good), 0, "en"))
    real = np.mean([quality for _, quality, _, _ in labels])
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = Q.train(docs, labels, rows=300)
    found = Q.assess(docs, model).agg(F.avg("probability")).first()[0]
    assert abs(found - real) < 0.06


def test_ranking_on_held_out_rows(spark):
    docs, labels = frames(spark)
    ranker = P.train(docs, P.split_labels(labels))
    found = P.classify(docs, ranker).collect()
    assert len(found) == docs.count()
    known = dict(corpus()[1])
    for r in found:
        part = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4
        assert r.held_out == (part == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, known[r.doc_id]) for r in found if r.held_out and r.doc_id in known]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.97
    assert P.keep_good(docs, ranker).columns == docs.columns
    used = {r.doc_id for r in P.split_labels(labels).collect() if r.doc_id is not None}
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in used)


def test_threshold_covers_all_labelled_rows(spark):
    docs, labels = frames(spark)
    ranker = P.train(docs, labels, rows=20)  # few to fit to; the cut is over all
    known = {i: label for i, label in corpus()[1] if i not in (0,)}
    strengths = sorted(float(ranker.strength(P.features(t))) for i, t in corpus()[0] if i in known)
    bad = sum(1 for label in known.values() if label == 0)
    assert ranker.threshold == (strengths[bad - 1] + strengths[bad]) / 2


def test_exact_cut(spark):
    draw = random.Random(4)
    values = [draw.gauss(0, 1) ** 5 for _ in range(500)] + [0.25] * 300 + [1e9, -1e9]
    frame = spark.createDataFrame([(v,) for v in values], "strength double").repartition(3).cache()
    values.sort()
    for below in (1, 2, 250, 500, 801):
        assert P.exact_cut(frame, below) == (values[below - 1] + values[below]) / 2


def test_an_id_with_many_rows_gives_one_example(spark):
    docs = spark.createDataFrame([(k % 2, f"{k:03} text", "s", "k") for k in range(60)], DOCS)
    labels = spark.createDataFrame([(0, 0, 0, "en"), (1, 1, 0, "en")], LABELS)
    assert Q.labelled_sample(docs, labels, 10, F.col("text")) == [(0, 0, "000 text"), (1, 1, "001 text")]


def test_quantile_threshold_lies_between():
    strengths, mass = np.array([3.0, 1.0, 2.0, 10.0]), np.ones(4)
    assert P.quantile_threshold(strengths, mass, 0.25) == 1.5
    assert P.quantile_threshold(strengths, mass, 0.75) == 6.5
    assert P.quantile_threshold(strengths, np.array([1.0, 97.0, 1.0, 1.0]), 0.97) == 1.5


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark)
    none = labels.where(F.lit(False))
    assert Q.assess(docs, Q.train(docs, none)).where("NOT base_failed AND NOT kept").count() == 0
    assert P.classify(docs, P.train(docs, none)).where("predicted = 0").count() == 0
    empty = docs.where(F.lit(False))
    assert Q.assess(empty, Q.train(empty, labels)).count() == 0
    assert P.classify(empty, P.train(empty, labels)).count() == 0


def test_fit_holds_one_piece_at_a_time():
    draw = np.random.default_rng(3)
    indptr = np.cumsum([0, 0, *draw.integers(0, 2_000, 600), 3 * Q.PIECE])
    size, labels = 500, draw.integers(0, 2, len(indptr) - 1).astype(float)
    slots, values = draw.integers(0, size, indptr[-1]).astype(np.int32), draw.random(indptr[-1]).astype(np.float32)
    row = np.repeat(np.arange(len(labels)), np.diff(indptr))
    weights = np.zeros(size)
    error = 1.0 / (1.0 + np.exp(-np.bincount(row, values * weights[slots], len(labels)))) - labels
    whole = np.bincount(slots, values * error[row], size) / len(labels)
    small = slice(0, int(indptr[-2]))
    tracemalloc.start()
    fitted, _ = Q.fit_logistic(indptr[:-1], slots[small], values[small], labels[:-1], size, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * Q.PIECE  # all entries at once take 9 times a piece
    assert fitted.any()
    # The order of the sums is that of one pass over all entries, so results are the same to the bit.
    got, _ = Q.fit_logistic(indptr, slots, values, labels, size, rounds=1)
    assert (Q.margins(indptr, slots, values, got) == np.bincount(row, values * got[slots], len(labels))).all()
    step = 0.5 * (0.1 * whole / (1 - 0.9)) / (np.sqrt(0.001 * whole**2 / (1 - 0.999)) + 1e-8)
    assert (got == -step).all()


def test_sample_is_held_without_an_object_for_each_feature():
    """What stays of rows that come one by one is their entries, in order of label and id."""
    def feature(k):
        slots = np.arange(k % 7, k % 7 + 3000, dtype=np.int32) + Q.WORD_SLOTS + 1000
        return Row(slots=slots.tobytes(), shares=np.full(3000, k, np.float32).tobytes())

    def found():
        for k in reversed(range(400)):
            yield Row(doc_id=k, label=k % 2, feature=feature(k))

    tracemalloc.start()
    try:
        sample = Q.Entries(found())
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 400 * 3000 * 8  # as many bytes as the features themselves have
    assert [(label, i) for label, i, _ in sample.rows] == sorted((k % 2, k) for k in range(400))
    indptr, slots, shares, labels = sample.matrix(sample.rows[1::3])
    ids = [i for _, i, _ in sample.rows[1::3]]
    assert indptr.tolist() == [3000 * k for k in range(len(ids) + 1)]
    assert labels.tolist() == [i % 2 for i in ids]
    assert (shares == np.repeat(np.array(ids, np.float32), 3000)).all()
    assert (slots == np.concatenate([np.frombuffer(feature(i).slots, np.int32) for i in ids])).all()
