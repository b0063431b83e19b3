"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised test items (questions and answers) are cut into windows of 13 words, and one
automaton over all windows scans each text once. It runs over word numbers, so a match is a run of
words; runs are mapped back to code point offsets of the original text.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.llm.common import utf8
from sitefold.session import materialize

#: Words in a window; an item of fewer words is one window.
WINDOW = 13
#: Windows per automaton, about 1 KB of a worker's memory each. A larger benchmark is scanned for in blocks.
BLOCK_WINDOWS = 200_000
#: A document is contaminated when hit words make up one word in this many.
SHARE = 20

#: A-Z lower-cased; digits, letters and all bytes of non-ASCII characters are parts of
#: words; all else separates.
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256)
)

STATE = "struct<n_words:long,hits:array<struct<first:long,last:long>>,items:array<string>>"
_STATE_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def fold(text: str | None) -> bytes:
    """Lower-cased text with one space for each separating character; byte offsets stay."""
    return utf8(text).translate(_FOLD)


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks, [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


class Scanner:
    """The automaton over the windows of some items. Built once in each Python worker."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in fold(text).split())
            for start in range(max(1, len(ids) - window + 1)) if ids else ():
                owners.setdefault(ids[start : start + window], set()).add(name)
        self.automaton = None
        if owners:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, names in owners.items():
                self.automaton.add_word(key, (len(key), tuple(names)))
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words in the text, runs of hit words (first, last), items found."""
        words = fold(text).split()
        found: set[str] = set()
        if self.automaton is None or not words:
            return len(words), [], found
        number = self.numbers.get
        marks = None
        for last, (length, names) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            if marks is None:
                marks = np.zeros(len(words), np.int8)
            marks[last - length + 1 : last + 1] = 1
            found.update(names)
        return len(words), [] if marks is None else _runs(marks), found


def _scan_column(items: list[tuple[str, str]], window: int, text: Column) -> Column:
    """State of each text after a scan for the items."""
    built: list[Scanner] = []

    @F.arrow_udf(STATE)
    def scanned(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Scanner(items, window))
        out = []
        for text in texts:
            n_words, hits, found = built[0].scan(text.as_py())
            runs = [{"first": a, "last": b} for a, b in hits]
            out.append({"n_words": n_words, "hits": runs, "items": sorted(found)})
        return pa.array(out, type=_STATE_ARROW)

    return scanned(text)


def _merged(hits: pa.Array) -> pa.Array:
    """Runs of several blocks as runs that neither overlap nor touch."""
    out = []
    for runs in hits:
        merged: list[list[int]] = []
        for first, last in sorted((h["first"], h["last"]) for h in runs.as_py() or ()):
            if merged and first <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        out.append([{"first": a, "last": b} for a, b in merged])
    return pa.array(out, type=_STATE_ARROW.field("hits").type)


def _pieces(items: DataFrame, window: int, limit: int) -> DataFrame:
    """(name, piece, n_windows) of items (name, item_text): folded words of at most ``limit`` windows.
    A longer item gives several pieces, each beginning with the windows that follow the last one's."""

    def cut(batches):
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("name"), batch.column("item_text"), strict=True):
                words = fold(text.as_py()).split()
                count = max(1, len(words) - window + 1) if words else 0
                for start in range(0, count, limit):
                    taken = min(limit, count - start)
                    piece = b" ".join(words[start : start + taken + window - 1]).decode("utf-8")
                    rows.append({"name": name.as_py(), "piece": piece, "n_windows": taken})
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("name", pa.string()), ("piece", pa.string()), ("n_windows", pa.int64())])
            )

    return items.mapInArrow(cut, "name string, piece string, n_windows long").distinct()


def blocks_of(items: DataFrame, window: int = WINDOW, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """Pieces of items (name, item_text) with the block each belongs to: (bucket, part).

    Pieces are hashed into buckets of ``limit`` windows on average, and a running sum cuts a bucket where
    the next piece would begin beyond ``limit``: no block has more than twice that, whatever the items.
    """
    pieces = materialize(_pieces(items, window, limit), "pieces")
    total = pieces.agg(F.sum("n_windows")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("name", "piece"), F.lit(max(1, -(-total // limit)))).cast("int")
    inside = Window.partitionBy("bucket").orderBy("name", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_windows").over(inside), F.lit(0))
    return pieces.withColumn("bucket", bucket).withColumn("part", F.floor(before / limit).cast("int"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    out_col: str = "found",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct column ``out_col`` (n_words, hits as runs of word numbers, item names).

    All rows and columns of ``docs`` stay. A null or empty text has no words and no hits; an item
    without words is found nowhere; items that share a name count as one; a null item name is "null".
    A worker holds the automaton of one block at a time (see ``blocks_of``). A benchmark of several
    blocks writes ``docs`` once under row numbers, reads it for each block, writes only rows with hits,
    and joins the hits of all blocks to their rows.
    """
    named = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("name"),
        F.col(item_text_col).alias("item_text"),
    )
    blocked = materialize(blocks_of(named, window, block_windows), "blocks")
    keys = blocked.select("bucket", "part").distinct().orderBy("bucket", "part").collect()  # a row for each block

    def block(key) -> list[tuple[str, str]]:  # 2 * block_windows at most
        rows = blocked.where((F.col("bucket") == key.bucket) & (F.col("part") == key.part))
        return [(r.name, r.piece) for r in rows.select("name", "piece").collect()]

    if len(keys) < 2:
        return docs.withColumn(out_col, _scan_column(block(keys[0]) if keys else [], window, F.col(text_col)))
    row, state = "__row", "__state"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    found = []
    for key in keys:
        scanned = numbered.select(row, _scan_column(block(key), window, F.col(text_col)).alias(state))
        hit = scanned.where(F.size(f"{state}.hits") > 0).select(row, f"{state}.hits", f"{state}.items")
        found.append(materialize(hit, "hits"))
    gathered = reduce(DataFrame.unionByName, found).groupBy(row).agg(
        _flat("hits").alias("hits"), F.array_sort(F.array_distinct(_flat("items"))).alias("items")
    )
    merged = gathered.select(row, F.arrow_udf(_merged, "array<struct<first:long,last:long>>")("hits").alias("__hits"), F.col("items").alias("__items"))
    none = _scan_column([], window, F.col(text_col))  # counts words
    whole = numbered.withColumn(state, none).join(merged, row, "left").withColumn(
        out_col,
        F.struct(
            F.col(f"{state}.n_words").alias("n_words"),
            F.coalesce("__hits", f"{state}.hits").alias("hits"),
            F.coalesce("__items", f"{state}.items").alias("items"),
        ),
    )
    return whole.select(*[c for c in docs.columns if c != out_col], out_col)


def _flat(column: str) -> Column:
    return F.flatten(F.collect_list(column))


def n_hit(found: str = "found") -> Column:
    """Words inside any occurrence of a window."""
    return F.aggregate(
        F.col(f"{found}.hits"), F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1
    )


def is_contaminated(found: str = "found", share: int = SHARE) -> Column:
    return (n_hit(found) > 0) & (share * n_hit(found) >= F.col(f"{found}.n_words"))


def _original_spans(texts: pa.Array, hits: pa.Array) -> pa.Array:
    out = []
    for text, runs in zip(texts, hits, strict=True):
        runs = runs.as_py()
        if not runs:
            out.append([])
            continue
        raw = np.frombuffer(utf8(text.as_py()), np.uint8)
        inside = np.frombuffer(fold(text.as_py()), np.uint8) != 32
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        out.append([
            {"start": int(points[starts[r["first"]]]), "end": int(points[ends[r["last"]]])} for r in runs
        ])
    return pa.array(out, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def original_spans(text: Column, hits: Column) -> Column:
    """Runs of hit words as code point offsets [start, end) of the original text."""
    return F.arrow_udf(_original_spans, "array<struct<start:long,end:long>>")(text, hits)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    state = "__found"
    found = find_items(docs, items, text_col, out_col=state)
    return found.where(~is_contaminated(state)).select(*[found[c] for c in docs.columns])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found, their digest, verdict and spans."""
    found = find_items(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("found.items")).cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        original_spans(F.col("text"), F.col("found.hits")).alias("spans"),
    )
