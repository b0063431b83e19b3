"""Quality rules: fixed counting rules and a trained, calibrated classifier over hashed n-grams.

Features are relative frequencies of word 1- and 2-grams and of character 3- and 4-grams, hashed
into fixed tables. A logistic regression is fitted to a bounded sample of labelled rows, its scores
are calibrated on rows that it has not seen, weighted to the labels' real shares, and texts are scored
in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sitefold.llm.common import MIX_1, WordHash, mix, utf8, windows

#: Labelled rows used for fitting and calibration, half of each label. The only bound of this module.
TRAIN_ROWS = 2_400
#: Hash tables: words first, then characters.
WORD_SLOTS, CHAR_SLOTS = 1 << 12, 1 << 12
#: Feature entries that the fit on the driver goes through at once.
PIECE = 1 << 16
#: Holds the number of any slot.
SLOT = np.uint16
#: A document is kept when its calibrated probability of good quality reaches this.
KEEP_AT = 0.5
#: Base rule: fewer words fail; more than this share of words in repeated 5-word windows fails.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: Fixed value: symbols that are counted.
_SYMBOLS = b"#*$%&|<>"
_BLOCKS = ((0, WORD_SLOTS), (WORD_SLOTS, WORD_SLOTS + CHAR_SLOTS))

_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- base counts -------------------------------------------------------------------------------


def base_counts(raw: bytes, hashes: np.ndarray, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The five counts of one text; ``hashes`` are its words' hashes."""
    points = sum(map(len, words)) - _continuations(raw)
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()] if b"\n" in raw else ()
    runs = windows(hashes, 5)
    repeated = 0
    if len(runs) > 1:
        order = np.argsort(runs)
        ranked = runs[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            twice = np.zeros(len(runs), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            marks = np.zeros(len(words) + 1, np.int64)
            starts = np.flatnonzero(twice)
            np.add.at(marks, starts, 1)
            np.add.at(marks, starts + 5, -1)
            repeated = int((np.cumsum(marks) > 0).sum())
    return len(words), points, symbols, len(lines) - len(set(lines)), repeated


def _continuations(raw: bytes) -> int:
    return int(((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80).sum())


# --- features ----------------------------------------------------------------------------------


def _slots(raw: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the word n-grams and of the character n-grams of a text."""
    word = np.concatenate((mix(hashes), windows(hashes, 2)))
    codes = np.frombuffer(raw, np.uint8).astype(np.uint64)
    parts = []
    for size in (3, 4):
        count = len(codes) - size + 1
        if count > 0:
            value = codes[:count]
            for step in range(1, size):
                value = (value << np.uint64(8)) | codes[step : step + count]
            parts.append(mix(value * MIX_1 + np.uint64(size)))
    char = np.concatenate(parts) if parts else codes[:0]
    return (
        (word >> np.uint64(40)).astype(np.int64) % WORD_SLOTS,
        (char >> np.uint64(40)).astype(np.int64) % CHAR_SLOTS + WORD_SLOTS,
    )


@dataclass(frozen=True)
class Model:
    """Weights of the hashed n-grams and the calibration line (slope, offset)."""

    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, raw: bytes, hashes: np.ndarray) -> float:
        margin = sum(float(self.weights[s].mean()) if len(s) else 0.0 for s in _slots(raw, hashes))
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35))))


def _sparse_features(texts: pa.Array) -> pa.Array:
    """Relative frequency of each slot within its block, as packed int32 and float32."""
    cache, out = WordHash(), []
    for text in texts:
        raw = utf8(text.as_py())
        slots, shares = [], []
        for part in _slots(raw, cache.of(raw.split())):
            found, counts = np.unique(part, return_counts=True)
            slots.append(found)
            shares.append(counts / max(1, len(part)))
        out.append({
            "slots": np.concatenate(slots).astype(np.int32).tobytes(),
            "shares": np.concatenate(shares).astype(np.float32).tobytes(),
        })
    return pa.array(out, pa.struct([("slots", pa.binary()), ("shares", pa.binary())]))


def sparse_features(text: Column) -> Column:
    return F.arrow_udf(_sparse_features, "struct<slots:binary,shares:binary>")(text)


# --- training ----------------------------------------------------------------------------------


def usable_labels(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(doc_id, label), one row per id. Null ids and labels, and ids with two labels, are left out."""
    return (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )


def label_counts(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> dict[int, int]:
    """Number of ids of each label among all usable labels of ``docs``."""
    known = usable_labels(labels, label_col).join(docs.select("doc_id"), "doc_id", "left_semi")
    return {r.label: r["count"] for r in known.groupBy("label").count().collect()}


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, feature: Column, label_col: str = "quality"
) -> list[tuple[int, int, object]]:
    """The rows of ``labelled_rows`` as a list, in the order of their ids."""
    found = labelled_rows(docs, labels, rows, feature, label_col)
    return sorted(((r.doc_id, r.label, r.feature) for r in found.toLocalIterator()), key=lambda r: r[0])


def labelled_rows(docs: DataFrame, labels: DataFrame, rows: int, feature: Column, label_col: str = "quality") -> DataFrame:
    """(doc_id, label, feature) of at most ``rows`` labelled documents, half of each label.

    The ids are chosen by hash, so all labelled rows have the same chance; only the chosen texts
    are turned into features. Ids with two different labels and null labels are left out, and of
    documents that share an id the one with the smallest text counts.
    """
    clean = usable_labels(labels, label_col)
    chosen = None
    for label in (0, 1):
        part = clean.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
        chosen = part if chosen is None else chosen.unionAll(part)
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")  # ``rows`` rows at most
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))  # one row of an id, however many share it
        .select("doc_id", "label", feature.alias("feature"))
    )


class Entries:
    """Feature entries of labelled rows, one after another in two buffers: an object for each row would
    leave the driver's memory in pieces that it can't give back."""

    def __init__(self, found: Iterable[Row]) -> None:
        self.rows: list[tuple[int, object, int]] = []  # label, doc_id and place, which is that in ``ends`` too
        self.ends, self._slots, self._shares = [0], bytearray(), bytearray()
        for r in found:
            self.rows.append((r.label, r.doc_id, len(self.rows)))
            self._slots += np.frombuffer(r.feature.slots, np.int32).astype(SLOT).tobytes()
            self._shares += r.feature.shares
            self.ends.append(len(self._shares) // 4)
        self.rows.sort()

    def matrix(self, rows: list[tuple[int, object, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """indptr, slots, shares and labels of some of ``self.rows``."""
        spans = [(self.ends[k], self.ends[k + 1]) for _, _, k in rows]
        every = np.frombuffer(self._slots, SLOT), np.frombuffer(self._shares, np.float32)
        slots, shares = (np.concatenate([part[low:high] for low, high in spans]) for part in every)
        indptr = np.cumsum([0] + [high - low for low, high in spans])
        return indptr, slots, shares, np.array([label for label, _, _ in rows], np.float64)


def _pieces(indptr: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first entry, end, row of each entry) of runs of whole rows with about ``PIECE`` entries."""
    start = 0
    while start < len(indptr) - 1:
        end = max(start + 1, int(np.searchsorted(indptr, indptr[start] + PIECE, "right")) - 1)
        yield indptr[start], indptr[end], np.repeat(np.arange(start, end), np.diff(indptr[start : end + 1]))
        start = end


def margins(indptr: np.ndarray, slots: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of value times weight over the entries of each row."""
    out = np.zeros(len(indptr) - 1)
    for low, high, row in _pieces(indptr):
        np.add.at(out, row, values[low:high] * weights[slots[low:high]])
    return out


def fit_logistic(
    indptr: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray, size: int,
    rounds: int = 150, rate: float = 0.5, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Sparse logistic regression by full-batch Adam; returns weights and intercept.

    Entries are gone through in pieces of whole rows, in their order: besides the input, the driver holds
    one piece.
    """
    weights, intercept = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        error = 1.0 / (1.0 + np.exp(-np.clip(margins(indptr, slots, values, weights) + intercept, -35, 35))) - labels
        by_slot = np.zeros(size)
        for low, high, row in _pieces(indptr):
            np.add.at(by_slot, slots[low:high], values[low:high] * error[row])
        gradient = np.append(by_slot / len(labels) + decay * weights, error.mean())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        step = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weights -= step[:-1]
        intercept -= step[-1]
    return weights, float(intercept)


def calibrate(
    margins: np.ndarray, labels: np.ndarray, rounds: int = 100, mass: np.ndarray | None = None
) -> tuple[float, float]:
    """Platt's line (slope, offset) with smoothed targets, by Newton's method. ``mass`` weights the rows."""
    mass = np.ones(len(labels)) if mass is None else mass
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = margins.std() or 1.0
    x = np.column_stack((margins / scale, np.ones(len(margins))))
    line = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ line, -35, 35)))
        hessian = (x * (mass * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (mass * (p - target)) + 1e-6 * line)
        line -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0] / scale), float(line[1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fit on two thirds of the sample, calibrate on the rest. With one label or none: keeps all.

    The sample has as many rows of each label; for calibration they weigh as much as their label does
    among all usable labels.
    """
    found = labelled_rows(docs, labels, rows, sparse_features(F.col("text")), label_col)
    sample = Entries(found.toLocalIterator())
    if len({label for label, _, _ in sample.rows}) < 2 or len(sample.rows) < 6:
        return Model(np.zeros(WORD_SLOTS + CHAR_SLOTS), 0.0, 35.0)
    fitted = sample.matrix([r for k, r in enumerate(sample.rows) if k % 3])
    held = sample.matrix(sample.rows[::3])
    del sample  # the same entries once more
    weights, _ = fit_logistic(*fitted, WORD_SLOTS + CHAR_SLOTS)
    indptr, slots, shares, target = held
    counts = label_counts(docs, labels, label_col)
    real = np.where(target == 1, counts[1], counts[0]) / (counts[0] + counts[1])
    mass = real / np.where(target == 1, target.mean(), 1 - target.mean())
    slope, offset = calibrate(margins(indptr, slots, shares, weights), target, mass=mass)
    return Model(weights, slope, offset)


# --- the operator ------------------------------------------------------------------------------


def score(text: Column, model: Model) -> Column:
    """Struct of the base counts and the calibrated probability of good quality."""

    @F.arrow_udf(f"struct<{','.join(f'{name}:long' for name in _NAMES)},probability:double>")
    def scored(texts: pa.Array) -> pa.Array:
        cache, rows = WordHash(), []
        for text in texts:
            raw = utf8(text.as_py())
            words = raw.split()
            hashes = cache.of(words)
            rows.append((*base_counts(raw, hashes, words), model.probability(raw, hashes)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.float64())]
        return pa.StructArray.from_arrays(arrays, [*_NAMES, "probability"])

    return scored(text)


def _verdict(keep_at: float) -> tuple[Column, Column]:
    state = F.col("__rules")
    failed = (state["n_words"] < MIN_WORDS) | (
        100 * state["n_repeat_words"] > MAX_REPEAT_PERCENT * state["n_words"]
    )
    return failed, ~failed & (state["probability"] >= keep_at)


def assess(docs: DataFrame, model: Model, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with the base counts, probability, base_failed and kept. All rows and columns stay.

    A null or empty text has no words and fails the base rule. Columns whose names clash with the
    result's are replaced; ``keep_good`` returns rows in their own columns.
    """
    failed, kept = _verdict(keep_at)
    return docs.withColumn("__rules", score(F.col(text_col), model)).withColumns({
        **{name: F.col("__rules")[name] for name in (*_NAMES, "probability")},
        "base_failed": failed,
        "kept": kept,
    }).drop("__rules")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """Rows of ``docs`` that neither the base rules nor the classifier reject, with their columns."""
    scored = docs.withColumn("__rules", score(F.col(text_col), model))
    return scored.where(_verdict(keep_at)[1]).select(*[scored[c] for c in docs.columns])
