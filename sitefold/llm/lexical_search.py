"""Ranked lexical search: every item's best documents, by hybrid term-at-a-time and document-at-a-time.

Documents are cut into blocks. A block's inverted index holds the posting lists of the terms that items
ask for, and is written once with the block's share of the corpus statistics. When these are known,
each block answers each item: the lists of an item's rare terms are summed term at a time into
accumulators, which are then one more sorted list with a bounded score. That list and the lists of
frequent terms are walked document at a time, in runs: a list whose bound, with those of the weaker
lists, can't reach the item's k-th best score so far brings in no documents, and a document is left
as soon as its sum and the bounds of the lists still to be looked up stay below that score.

Scores are whole numbers, so sums do not depend on their order. No document text leaves its task; a
task passes on k rows for each item and term statistics for each block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefold.llm.common import utf8
from sitefold.session import materialize

#: Documents returned for an item.
TOP = 10
#: Fixed values of the score: saturation and length normalisation in hundredths, scale of weights.
LENGTH_PERCENT, WEIGHT_SCALE, UNIT = 90, 1000, 1_000_000_000
#: A block of the index ends at this many documents or bytes of text; a longer document is one.
BLOCK_DOCS, BLOCK_BYTES = 8_192, 32 << 20
#: Lists shorter than one posting for this many documents of the block are summed term at a time.
SHORT = 32
#: Candidates that are looked up between two updates of an item's threshold.
RUN = 64
#: Bytes of item text that are searched for at once; more are searched for in several rounds.
ITEM_BYTES = 2 << 20

#: A-Z are lower-cased; digits, letters and all bytes of non-ASCII characters are parts
#: of terms; all else separates.
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256))

_BLOCKS = (
    "n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<int>, sizes array<int>,"
    " places array<int>, counts array<int>"
)
_BLOCK_TYPES = [
    pa.int64(), pa.int64(), *(pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))
]
_FOUND = "item int, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order; null has none."""
    return utf8(text).translate(_FOLD).split()


# --- index -------------------------------------------------------------------------------------


def _index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """One row per block: documents with terms, terms in all, and for the asked-for documents their ids,
    lengths and posting lists (term, length of its list; places in ``ids`` and counts, list by list)."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        n_docs = n_terms = size = 0
        ids, lengths, found = [], [], []

        def block() -> pa.RecordBatch:
            postings = np.array(found, np.int64).reshape(-1, 3)
            postings = postings[np.lexsort((postings[:, 1], postings[:, 0]))]
            named, sizes = np.unique(postings[:, 0], return_counts=True)
            lists = (x.astype(np.int32) for x in (named, sizes, postings[:, 1], postings[:, 2]))
            columns = (n_docs, n_terms, ids, lengths, *lists)
            return pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(columns, _BLOCK_TYPES, strict=True)],
                names=[c.split()[0] for c in _BLOCKS.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                asked = [n for n in map(number, words) if n is not None]
                if asked:
                    which, times = np.unique(np.array(asked, np.int64), return_counts=True)
                    found.extend((t, len(ids), c) for t, c in zip(which.tolist(), times.tolist(), strict=True))
                    ids.append(doc_id)
                    lengths.append(len(words))
                size += len(words) * 8
                if n_docs >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    n_docs = n_terms = size = 0
                    ids, lengths, found = [], [], []
        if n_docs:
            yield block()

    return docs.mapInArrow(indexed, _BLOCKS)


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _impacts(block: Callable[[str], np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """term -> (places of its documents in the block, score it adds to each)."""
    sizes, places, counts = block("sizes"), block("places"), block("counts")
    norm = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * block("lengths") * n_docs) // n_terms
    score = weights[np.repeat(block("terms"), sizes)] * ((UNIT * counts) // (1000 * counts + 8 * norm[places]))
    ends = np.cumsum(sizes)
    return {
        t: (places[end - n : end], score[end - n : end])
        for t, n, end in zip(block("terms").tolist(), sizes.tolist(), ends.tolist(), strict=True)
    }


# --- search ------------------------------------------------------------------------------------


class Best:
    """The best (score, doc_id) of one item so far, at most ``top``; ties go to the smaller id, and a
    null id comes after all others."""

    def __init__(self, top: int) -> None:
        self.top, self.rows, self.threshold = top, [], 1

    def offer(self, rows: list[tuple[int, int | None]]) -> None:
        self.rows = sorted(self.rows + rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.top]
        if len(self.rows) == self.top:
            self.raise_to(self.rows[-1][0])

    def raise_to(self, score: int) -> None:
        """As many documents as are asked for score at least this."""
        self.threshold = max(self.threshold, score)


def _accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the sum of some lists as one list."""
    places, scores = np.concatenate([p for p, _ in lists]), np.concatenate([s for _, s in lists])
    merged, at = np.unique(places, return_inverse=True)
    sums = np.zeros(len(merged), np.int64)
    np.add.at(sums, at, scores)
    return merged, sums


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], ids: list, best: Best, short: int) -> None:
    """Offer ``best`` all documents of a block that may be among the best of the item whose posting
    lists (places, scores) these are. Lists of up to ``short`` postings are accumulated first."""
    few = [x for x in lists if len(x[0]) <= short]
    many = [x for x in lists if len(x[0]) > short]
    if few:
        many.append(_accumulated(few))
    for _, scores in many:  # partial sums of as many documents as are asked for bound the last one's score
        if len(scores) >= best.top:
            best.raise_to(int(np.partition(scores, -best.top)[-best.top]))
    many.sort(key=lambda x: int(x[1].max()))
    reach = np.cumsum([int(s.max()) for _, s in many])  # bound of the sum of this list and all weaker ones
    first, candidates, start = -1, np.empty(0, np.int64), 0
    last = -1
    while True:
        # Documents come in by the lists from ``first`` on: the weaker ones can't make a result alone.
        now = int(np.searchsorted(reach, best.threshold))
        if now == len(many):
            return
        if now != first:
            first = now
            candidates = np.unique(np.concatenate([p for p, _ in many[first:]]))
            start = int(np.searchsorted(candidates, last, "right"))
        run = candidates[start : start + RUN]
        if not len(run):
            return
        start, last = start + RUN, int(run[-1])
        sums = np.zeros(len(run), np.int64)
        for k in range(len(many) - 1, -1, -1):  # strongest list first, skipping to the run's documents
            alive = sums + reach[k] >= best.threshold
            if not alive.all():
                run, sums = run[alive], sums[alive]
                if not len(run):
                    break
            places, scores = many[k]
            at = np.searchsorted(places, run)
            at[at == len(places)] = 0
            sums += np.where(places[at] == run, scores[at], 0)
        good = sums >= best.threshold
        if good.any():
            best.offer([(s, ids[p]) for p, s in zip(run[good].tolist(), sums[good].tolist(), strict=True)])


def _search(index: DataFrame, asked: list[list[int]], weights: list[int], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item among the blocks of each task."""
    shared = index.sparkSession.sparkContext.broadcast((asked, np.array(weights, np.int64)))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, of_term = shared.value
        best = [Best(top) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                impacts = _impacts(
                    lambda c: batch.column(c)[row].values.to_numpy().astype(np.int64), of_term, n_docs, n_terms  # noqa: B023
                )
                ids = batch.column("ids")[row].as_py()
                for numbers, kept in zip(items, best, strict=True):
                    lists = [impacts[t] for t in numbers if t in impacts]
                    if lists:
                        search_block(lists, ids, kept, len(ids) // SHORT)
        rows = [(i, doc_id, score) for i, kept in enumerate(best) for score, doc_id in kept.rows]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)],
            names=["item", "doc_id", "score"],
        )

    return index.drop("n_docs", "n_terms").mapInArrow(searched, _FOUND)


def _round(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """(item, doc_id, score) for some items of a bounded size."""
    numbers: dict[bytes, int] = {}
    asked = [[numbers.setdefault(t, len(numbers)) for t in dict.fromkeys(terms(text))] for _, text in items]
    index = materialize(_index(docs, numbers), "search-index")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    counts = dict(
        index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
        .groupBy("x.terms").agg(F.sum("x.sizes")).collect()  # a row for each term of these items
    )
    weights = [weight(n_docs or 0, counts.get(t, 0)) for t in range(len(numbers))]
    found = _search(index, asked, weights, n_docs or 0, n_terms or 1, top)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The ``top`` best documents of every item: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id and text, ``items`` an id and a text; other columns are not read. A null or
    empty text has no terms: such a document is in no list and in no count, such an item finds nothing.
    Rows that repeat a doc_id are documents of their own, rows that repeat an item are items of their own;
    equal scores rank by doc_id, a null one last. Only scores above 0 are listed. An empty table gives
    no rows. Items are searched for in rounds of about ``item_bytes`` of text, which is what the driver
    and a task hold of them; an item that is longer is a round of its own. Each round reads ``docs`` once.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // item_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds))
    out = None
    for k in range(rounds):
        block = [(r.item_id, r.text) for r in asked.where(part == k).collect()]
        names = asked.sparkSession.createDataFrame(
            [(i, r[0]) for i, r in enumerate(block)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}"
        )
        found = _round(docs, block, top).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
