"""I-Match fingerprints, in DataFrame operations only.

The lexicon is the terms within a band of inverse document frequency: neither those that more than a
hundredth of the documents hold, nor those of one document alone. A text keeps its terms of the lexicon,
sorted and distinct, and hashes them once for each of several random subsets of the lexicon: 32
subsets that split a random part of the lexicon among them. A text with more terms takes a smaller
part, a half, a quarter and so on, so a subset holds about one of its terms whatever its length, and
survives an edit that leaves that term alone. Each text is hashed at its own level and at the next one,
so texts whose levels differ by one still compare.

The likeness of two fingerprints is the share of subsets with equal hashes among those that hold a
term of either text. Two texts that differ by a factor of more than about four in their terms have none.

Which terms a text may keep is known before the lexicon is: its level follows from the number of its
terms. So only the few dozen terms of its subsets travel, and no text with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.operators.keys import dense_row_number
from sitefold.session import materialize

#: Subsets of a level, and the terms of a text that a subset holds at most on average.
SUBSETS, PER_SUBSET = 32, 1.5
#: The band: a term of the lexicon is held by ``MIN_DOCS`` documents or more, and by no more than one
#: document in ``MAX_SHARE`` (or ``FEW_DOCS`` documents, where these are more).
MIN_DOCS, MAX_SHARE, FEW_DOCS = 2, 100, 10
#: Hex digits of a subset's hash; a subset without terms has dots instead.
DIGITS = 4

#: A-Z are lower-cased; ASCII other than digits and letters separates terms.
_UPPER, _LOWER, _SEPARATORS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_TEXT, _EDITED, _EDITED_BY_COPY = 0, 1, 2


def distinct_terms(text: Column) -> Column:
    """The distinct terms of a text, as an array of strings."""
    return F.array_remove(F.array_distinct(F.split(F.translate(text, _UPPER, _LOWER), _SEPARATORS)), "")


def level_of(n_terms: Column) -> Column:
    """Level of a text with so many distinct terms: the lexicon is halved that often."""
    halvings = F.ceil(F.log2(F.greatest(n_terms, F.lit(1)) / F.lit(SUBSETS * PER_SUBSET)))
    return F.greatest(halvings, F.lit(0)).cast("int")


def _with_candidates(rows: DataFrame, *texts: str) -> DataFrame:
    """``rows`` with each text column replaced by a struct (level, whole, terms): hashes of the terms that
    are in the text's subsets if they are in the lexicon, and a hash of all of it, for a text without any.
    A null text gives null.

    Each step is a projection of its own, so that no text is split again for each of its terms.
    """
    steps = (
        ("words", lambda t: distinct_terms(F.col(t))),
        ("level", lambda t: level_of(F.size(f"_words_{t}"))),
        # Zero in the hashes of the level's part of the lexicon; the bits below name the subset.
        ("mask", lambda t: (F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"_level_{t}")) - 1) * SUBSETS),
        ("all", lambda t: F.transform(f"_words_{t}", lambda w: F.xxhash64(w))),
        ("terms", lambda t: F.filter(f"_all_{t}", lambda g: g.bitwiseAND(F.col(f"_mask_{t}")) == 0)),
    )
    out = rows
    for name, step in steps:
        out = out.withColumns({f"_{name}_{t}": step(t) for t in texts})
    described = lambda t: F.when(F.col(t).isNotNull(), F.struct(
        F.col(f"_level_{t}").alias("level"), F.md5(F.col(t).cast("binary")).alias("whole"), F.col(f"_terms_{t}").alias("terms"),
    ))
    return out.select(*(described(c).alias(c) if c in texts else F.col(c) for c in rows.columns))


# --- lexicon -----------------------------------------------------------------------------------


def lexicon(docs: DataFrame) -> DataFrame:
    """(term, df): hashes of the terms that ``MIN_DOCS`` documents or more hold, over all ``docs`` (text)."""
    words = docs.select(F.explode(distinct_terms(F.coalesce("text", F.lit("")))).alias("word"))
    return (
        words.select(F.xxhash64("word").alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= MIN_DOCS)
    )


def _in_lexicon(rows: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """Rows whose term is in the band. Terms above it go first, so no term is on more than a hundredth
    of the documents when rows are shuffled by term. Documents hold ``d`` distinct terms on average, so
    fewer than ``d * MAX_SHARE`` terms can be above: that table is broadcast."""
    most = max(n_docs // MAX_SHARE, FEW_DOCS)
    above, within = terms.where(F.col("df") > most), terms.where(F.col("df") <= most)
    rows = rows.join(F.broadcast(above.select("term")), "term", "left_anti")
    return rows.join(within.select("term"), "term", "left_semi")


# --- neighbours --------------------------------------------------------------------------------


def _with_next(docs: DataFrame) -> DataFrame:
    """Distinct rows of ``docs`` with the start of the next one's text: key, doc_id, text, copies,
    next_key, following.

    The order is by descending doc_id (a null one last), then by a hash; the last is followed by the first.
    Only keys are numbered and only starts of texts are sent to the row before.
    """
    keyed = docs.select(
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    groups = keyed.select("key", "doc_id", F.length("text").alias("n_chars")).groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies")
    ).withColumn("sort", -F.col("doc_id").cast("decimal(20,0)"))
    numbered = materialize(dense_row_number(groups, ["sort", "key"]), "imatch-order")
    last = numbered.count()
    after = numbered.select(
        F.col("key").alias("next_key"), F.when(F.col("rn") == 1, last).otherwise(F.col("rn") - 1).alias("rn")
    )
    pairs = materialize(
        numbered.join(after, "rn").select(
            "key", "doc_id", "copies", "next_key", F.floor(F.col("n_chars") / 3).cast("int").alias("need")
        ),
        "imatch-pairs",
    )
    # Both sides take the same columns of the documents, so that texts are shuffled once for both.
    rows = keyed.groupBy("key").agg(F.first("text").alias("text"))
    starts = rows.join(pairs.withColumnsRenamed({"key": "before", "next_key": "key"}), "key").select(
        F.col("before").alias("key"), "doc_id", "copies", F.col("key").alias("next_key"),
        F.expr("substring(text, 1, need)").alias("following"),
    )
    return rows.join(starts, "key")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by the first as many characters of ``following``."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.left(text, n - third), F.left(following, third))


# --- fingerprints ------------------------------------------------------------------------------


def _hashed(rows: DataFrame) -> DataFrame:
    """(key, hashes): of rows (key, what, level, term), a map from what * SUBSETS + subset to the hashes at
    the text's level and the next. One shuffle by key serves both steps."""
    deep = (F.col("term").bitwiseAND(F.expr(f"shiftleft({SUBSETS}L, level)"))) == 0
    digest = lambda terms: F.when(
        F.size(terms) > 0, F.left(F.md5(F.array_join(F.array_sort(terms), ",").cast("binary")), F.lit(DIGITS))
    ).otherwise("." * DIGITS)
    return (
        rows.withColumn("subset", (F.col("what") * SUBSETS + F.col("term").bitwiseAND(F.lit(SUBSETS - 1))).cast("int"))
        .repartition("key")
        .groupBy("key", "subset")
        .agg(F.collect_set("term").alias("all"), F.collect_set(F.when(deep, F.col("term"))).alias("half"))
        .select("key", "subset", F.concat(digest(F.col("all")), digest(F.col("half"))).alias("hash"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("subset", "hash"))).alias("hashes"))
    )


def _with_prints(rows: DataFrame, **sides: int) -> DataFrame:
    """``rows`` with the struct of each side (column=what) replaced by its fingerprint: level and hashes as
    text; of a text without terms of the lexicon, the hash of the whole text."""
    blank = "." * (2 * DIGITS)
    places = lambda what: F.sequence(F.lit(what * SUBSETS), F.lit(what * SUBSETS + SUBSETS - 1))
    bodies = rows.withColumns({
        f"_body_{c}": F.array_join(F.transform(places(what), lambda s: F.coalesce(F.col("hashes")[s], F.lit(blank))), "")
        for c, what in sides.items()
    })
    printed = lambda c: F.when(F.replace(f"_body_{c}", F.lit(".")) != "", F.concat(
        F.lpad(F.hex(F.col(c)["level"]), 2, "0"), F.lit(":"), F.col(f"_body_{c}")
    )).otherwise(F.concat(F.lit("text:"), F.col(c)["whole"]))
    return bodies.select(*(printed(c).alias(c) if c in sides else F.col(c) for c in rows.columns if c != "hashes"))


def with_likeness(rows: DataFrame, out: str, a: str, b: str) -> DataFrame:
    """``rows`` with the likeness of two columns of fingerprints, from 0 to 1; equal ones have 1."""
    level = lambda f: F.when(~F.col(f).startswith("text:"), F.conv(F.left(f, F.lit(2)), 16, 10).cast("int"))
    rows = rows.withColumns({"_la": level(a), "_lb": level(b)})
    rows = rows.withColumns({
        f"_from_{s}": 4 + DIGITS * (F.greatest("_la", "_lb") - F.col(f"_l{s}")) for s in "ab"
    })
    at = lambda f, s, k: F.substring(f, F.col(f"_from_{s}") + 2 * DIGITS * k, F.lit(DIGITS))
    dots, subsets = F.lit("." * DIGITS), F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    near = (F.abs(F.col("_la") - F.col("_lb")) <= 1) & (F.col(a) != F.col(b))
    pairs = F.when(near, F.transform(subsets, lambda k: F.struct(at(a, "a", k).alias("a"), at(b, "b", k).alias("b"))))
    rows = rows.withColumn("_pairs", pairs)
    same = F.size(F.filter("_pairs", lambda p: (p["a"] == p["b"]) & (p["a"] != dots)))
    held = F.size(F.filter("_pairs", lambda p: (p["a"] != dots) | (p["b"] != dots)))
    value = F.when(F.col(a) == F.col(b), 1.0).when(F.col("_pairs").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(same.cast("double"), held.cast("double")), F.lit(0.0))
    )
    return rows.withColumn(out, value).drop("_la", "_lb", "_from_a", "_from_b", "_pairs")


def fingerprint(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every distinct (key_col, text_col) of ``docs``; other columns are not read.

    A null text is empty; a text without terms of the lexicon, an empty one too, has the hash of all
    of it as its fingerprint. An empty table has no rows.
    """
    rows = docs.select(F.col(key_col).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    told = rows.select(F.xxhash64("key", "text").alias("row"), "key", F.col("text").alias("t"))
    base = materialize(_with_candidates(told, "t").dropDuplicates(["row"]), "imatch-texts")
    terms = materialize(lexicon(rows), "imatch-lexicon")
    kept = _in_lexicon(
        base.select(F.col("row").alias("key"), F.lit(_TEXT).alias("what"), "t.level", F.explode("t.terms").alias("term")), terms, rows.count()
    )
    hashes = _hashed(kept).withColumnRenamed("key", "row")
    return _with_prints(base.join(hashes, "row", "left"), t=_TEXT).select("key", F.col("t").alias("fingerprint"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text; others are not read) and of its edited text.

    One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited (likeness
    of the two), near_next (likeness to the next document's). The edited text has its last third replaced
    by the start of the next document by descending doc_id. A null text is empty; an empty one is its own
    edit. A null id comes last; rows of one id follow each other by a hash of their text, equal rows are
    next to each other, and a single row is next to itself. An empty table has no rows.
    """
    docs = docs.select("doc_id", "text")
    again = F.col("copies") > 1  # all but the last of equal rows are followed by one of themselves
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    told = _with_next(docs).select(
        "key", "doc_id", "copies", "next_key", F.col("text").alias("t"), edited(F.col("text"), F.col("following")).alias("e"),
        F.when(again, edited(F.col("text"), F.col("text"))).alias("o"),
    ).withColumns({"n_chars": F.length("t").cast("long"), "sha": digest("e"), "own_sha": digest("o")})
    base = materialize(_with_candidates(told, "t", "e", "o"), "imatch-texts")
    terms = materialize(lexicon(docs), "imatch-lexicon")
    n_docs = base.agg(F.sum("copies")).first()[0] or 0
    sides = {"t": _TEXT, "e": _EDITED, "o": _EDITED_BY_COPY}
    side = F.array(*(F.struct(F.lit(what).alias("what"), F.col(c).alias("c")) for c, what in sides.items()))
    rows = base.select("key", F.explode(side).alias("s")).select(
        "key", "s.what", F.col("s.c.level").alias("level"), F.explode("s.c.terms").alias("term")
    )
    hashes = _hashed(_in_lexicon(rows, terms, n_docs))
    prints = materialize(_with_prints(base.join(hashes, "key", "left"), **sides), "imatch-prints")
    nexts = prints.select(F.col("key").alias("next_key"), F.col("t").alias("next"))
    last = F.struct(F.col("sha").alias("sha"), F.col("e").alias("e"), F.col("next").alias("next"), F.lit(1).cast("long").alias("times"))
    copy = F.struct(F.col("own_sha").alias("sha"), F.col("o").alias("e"), F.col("t").alias("next"), (F.col("copies") - 1).alias("times"))
    found = (
        prints.join(nexts, "next_key")
        .select("doc_id", "n_chars", "t", F.explode(F.filter(F.array(last, copy), lambda v: v["times"] > 0)).alias("v"))
        .select("doc_id", "n_chars", "t", "v.sha", "v.e", "v.next", "v.times")
    )
    found = with_likeness(with_likeness(found, "near_edited", "t", "e"), "near_next", "t", "next")
    return found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_copy")).select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), F.col("t").alias("fingerprint"),
        F.col("e").alias("edited_fingerprint"), "near_edited", "near_next",
    )
