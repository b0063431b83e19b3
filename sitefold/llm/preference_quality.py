"""Quality classifier by Bradley-Terry ranking: document scores learnt from preference pairs.

In a pair one document is preferred to another; the loss is the logistic loss of the difference of
their scores, a linear function of the difference of their features. The threshold between good and
bad is a quantile of the scores of all labelled documents: the share of bad ones among them. Only the
weights come from a sample.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.llm.common import MIX_1, crc_part, mix, utf8
from sitefold.llm.quality_rules import labelled_sample, usable_labels
from sitefold.session import materialize

#: Labelled rows used for learning, half of each label, and preference pairs drawn from them.
TRAIN_ROWS, PAIRS = 3_000, 40_000
#: Score at which a document is predicted to be good; the quantile threshold is mapped to it.
GOOD_AT = 0.7
#: Bins of scores that are counted in each round of the search for the quantile.
BINS = 1_024
#: Hashed character 3-grams besides the counted features.
GRAM_SLOTS = 256

_CLASSES = 6  # of bytes: upper case, lower case, digits, white space, other ASCII, non-ASCII
_CLASS_OF = np.array([
    5 if b >= 128 else 0 if 65 <= b <= 90 else 1 if 97 <= b <= 122 else 2 if 48 <= b <= 57
    else 3 if b == 32 or 9 <= b <= 13 else 4
    for b in range(256)
], np.uint8)
#: Fixed value: ASCII punctuation and symbols that have a feature each.
_MARKS = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[]^_{|}~", np.uint8)
SIZE = _CLASSES + len(_MARKS) + 12 + GRAM_SLOTS


def features(text: str | None) -> np.ndarray:
    """Feature vector of a whole text; nothing but the text goes in. Empty texts have one too."""
    raw = utf8(text)
    out = np.zeros(SIZE, np.float32)
    words = raw.split()
    if not words:
        out[_CLASSES + len(_MARKS)] = 1.0
        return out
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(codes, minlength=256)
    at = _CLASSES
    out[:at] = np.bincount(_CLASS_OF, kinds, _CLASSES) / len(codes)
    out[at : at + len(_MARKS)] = kinds[_MARKS] / len(words)
    at += len(_MARKS)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    capital = sum(1 for w in words if w.isupper())
    out[at + 1 : at + 12] = (
        np.log1p(len(words)),
        sum(map(len, words)) / len(words) / 10,
        len(counts) / len(words),
        len(counts) / np.sqrt(2 * len(words)) / 10,
        max(counts.values()) / len(words),
        pairs / max(1, len(words) - 1),
        len(set(lines)) / len(lines),
        np.log1p(len(words) / len(lines)),
        capital / len(words),
        sum(1 for w in words if len(w) == 1) / len(words),
        sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128) / len(words),
    )
    at += 12
    if len(codes) >= 3:
        wide = codes.astype(np.uint64)
        grams = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
        slots = (mix(grams * MIX_1) >> np.uint64(40)).astype(np.int64) % GRAM_SLOTS
        out[at:] = np.sqrt(np.bincount(slots, minlength=GRAM_SLOTS) / len(grams))
    return out


@dataclass(frozen=True)
class Ranker:
    """Bradley-Terry weights over standardised features; ``threshold`` is the score quantile."""

    weights: np.ndarray
    centre: np.ndarray
    threshold: float
    scale: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, ``GOOD_AT`` at the threshold."""
        z = (self.strength(x) - self.threshold) / self.scale + np.log(GOOD_AT / (1 - GOOD_AT))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _features(texts: pa.Array) -> pa.Array:
    """Packed float32 vectors."""
    return pa.array([features(t.as_py()).tobytes() for t in texts], pa.binary())


def fit(
    x: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, rounds: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and centre from ``pairs`` preferences of a row of label 1 over one of label 0 (fixed seed)."""
    draw = np.random.default_rng(7)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    centre, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-6, spread, np.inf)  # a constant feature gets no weight
    z = (x - centre) / spread
    better, worse = draw.choice(good, pairs), draw.choice(bad, pairs)
    weights = np.zeros(x.shape[1])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        strength = z @ weights
        push = 1.0 / (1.0 + np.exp(np.clip(strength[better] - strength[worse], -35, 35))) / pairs
        by_row = np.bincount(worse, push, len(x)) - np.bincount(better, push, len(x))
        gradient = z.T @ by_row + 1e-3 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights / spread, centre


def quantile_threshold(strengths: np.ndarray, mass: np.ndarray, share: float) -> float:
    """Midway between the two scores around the ``share`` quantile of the weighted scores."""
    order = np.argsort(strengths, kind="stable")
    ranked, total = strengths[order], np.cumsum(mass[order]) / mass.sum()
    k = int(np.clip(np.searchsorted(total, share - 1e-9), 0, len(ranked) - 2))
    return float((ranked[k] + ranked[k + 1]) / 2)


def exact_cut(strengths: DataFrame, below: int) -> float:
    """Midway between number ``below`` and the next of all values of column ``strength`` in order.

    Values are counted in bins, and the bin that holds the wanted number is divided anew until it
    holds one value; ``BINS`` rows at most reach the driver.
    """
    value = F.col("strength")
    low, high = strengths.agg(F.min(value), F.max(value)).first()
    passed = 0
    while low < high:
        place = F.floor((value - F.lit(low)) / F.lit(high - low) * BINS)
        bins = (
            strengths.where(value.between(low, high))
            .groupBy(F.least(place, F.lit(BINS - 1)).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        for r in sorted(bins.collect(), key=lambda r: r.bin):
            if passed + r.n >= below:
                low, high = r.low, r.high
                break
            passed += r.n
    upto, above = strengths.agg(F.count_if(value <= low), F.min(F.when(value > low, value))).first()
    return low if upto > below or above is None else (low + above) / 2


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> Ranker:
    """Learn a ranker from labelled documents. With one label or none, all documents are good.

    The weights are fitted to a sample; threshold and scale are taken over all documents with a usable
    label. Of documents that share an id the lowest score counts.
    """
    sample = labelled_sample(docs, labels, rows, F.arrow_udf(_features, "binary")(F.col("text")), label_col)
    target = np.array([label for _, label, _ in sample], np.int64)
    if len(set(target.tolist())) < 2:
        return Ranker(np.zeros(SIZE), np.zeros(SIZE), -1.0, 1.0)
    x = np.array([np.frombuffer(f, np.float32) for _, _, f in sample], np.float64)
    weights, centre = fit(x, target)
    # Scored before the join, so no texts are shuffled.
    scored = docs.select("doc_id", _strength(F.col("text"), weights, centre).alias("strength"))
    strengths = materialize(
        scored.join(usable_labels(labels, label_col), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("strength").alias("strength")).select("label", "strength"),
        "preference-strengths",
    )
    threshold = exact_cut(strengths, strengths.where("label = 0").count())
    spread = strengths.agg(F.avg(F.abs(F.col("strength") - F.lit(threshold)))).first()[0]
    return Ranker(weights, centre, threshold, max(1e-6, spread / 3))


def _strength(text: Column, weights: np.ndarray, centre: np.ndarray) -> Column:
    ranker = Ranker(weights, centre, 0.0, 1.0)

    @F.arrow_udf("double")
    def strength(texts: pa.Array) -> pa.Array:
        return pa.array([float(ranker.strength(features(t.as_py()))) for t in texts], pa.float64())

    return strength(text)


def score(text: Column, ranker: Ranker) -> Column:
    """Quality score of the whole text, 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            out[k] = ranker.score(features(text.as_py()))
        return pa.array(out)

    return scored(text)


def split_labels(labels: DataFrame) -> DataFrame:
    """The rows to learn from: those whose crc32 of the id, modulo 4, is not 2."""
    return labels.where(crc_part("doc_id", 4) != 2)


def classify(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score and predicted. All rows and columns stay; null counts as empty."""
    return docs.withColumns({
        "held_out": crc_part("doc_id", 4) == 2,
        "score": score(F.col(text_col), ranker),
    }).withColumn("predicted", (F.col("score") >= GOOD_AT).cast("int"))


def keep_good(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are predicted to be good, with their columns."""
    scored = docs.withColumn("__score", score(F.col(text_col), ranker))
    return scored.where(F.col("__score") >= GOOD_AT).select(*[scored[c] for c in docs.columns])
