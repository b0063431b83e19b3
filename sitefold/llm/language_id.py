"""Language of web pages by Bayesian fusion of evidence.

A page's posterior is proportional to a prior of its host times the likelihoods of its text, of the
language its markup declares, of its address suffix and of a language code in its path. The text model
is counted over all labelled documents. How far declarations, suffixes and path codes can be trusted
is counted over all pages, and so are the host priors: hosts are smoothed towards their domain, and
domains towards the whole. All counts are sums of the pages' text posteriors, in grouped aggregations,
and a page's own share is taken out of the counts that judge it.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.llm.common import MIX_1, mix, utf8
from sitefold.session import materialize

#: Hashed character 3-grams of the text model.
SLOTS = 1 << 13
#: Languages whose counts a task or the driver holds at once; more are passed over block after block.
LANGUAGE_BLOCK = 64
#: Characters of text evidence that count in full; beyond, more text adds nothing (3-grams depend on
#: each other, so their product overstates).
FULL_TEXT = 200
#: Weight, in pages, of the level above in a host's or domain's prior, and of even odds in the tables.
PRIOR_PAGES, TABLE_PAGES = 5.0, 1.0
#: Posterior below which a page is undetermined.
SURE = 0.5
UNDETERMINED = "und"

_SILENT = re.compile(r"(?i)<(script|style)\b")
_SILENT_END = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style")}
_LANG = re.compile(r"(?i)\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")
_META_LANGUAGE = re.compile(r"(?i)http-equiv\s*=\s*[\"']?content-language[\"']?")
_CONTENT = re.compile(r"(?i)content\s*=\s*[\"']?\s*([a-z]{2,3})\b")
_ADDRESS = re.compile(r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?(?:/([a-z]{2})(?=[/?#-]|$))?")


# --- features of a page ------------------------------------------------------------------------


def visible_text(html: str) -> str:
    """Text without scripts, styles, comments and tags. An unclosed script, style or comment lasts to the
    end; a "<" without any ">" after it is text. One pass: what is searched for from a place is either
    found, and the pass goes on behind it, or is nowhere."""
    pieces, at = [], 0
    while (opened := html.find("<", at)) >= 0:
        pieces.append(html[at:opened])
        if html.startswith("<!--", opened):
            closed = html.find("-->", opened + 4)
            at = closed + 3 if closed >= 0 else len(html)
        elif silent := _SILENT.match(html, opened):
            closer = _SILENT_END[silent[1].lower()].search(html, silent.end())
            at = closer.end() if closer else len(html)
        else:
            closed = html.find(">", opened + 1)
            if closed < 0:
                at = opened
                break
            at = closed + 1
    pieces.append(html[at:])
    return html_entities.unescape(" ".join(pieces))


def gram_slots(text: str) -> np.ndarray:
    """Slot of each byte 3-gram of the lower-cased text, white space and digits made one space."""
    codes = np.frombuffer(utf8(re.sub(r"[\W\d_]+", " ", text.lower())), np.uint8).astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    grams = (codes[:-2] << np.uint64(16)) | (codes[1:-1] << np.uint64(8)) | codes[2:]
    return (mix(grams * MIX_1) >> np.uint64(40)).astype(np.int64) % SLOTS


def _tags(html: str, name: re.Pattern) -> Iterator[str]:
    """The tags of a name, one after another; a tag ends at the next ">"."""
    at = 0
    while opened := name.search(html, at):
        at = html.find(">", opened.end()) + 1
        if not at:
            return
        yield html[opened.end() : at]


def declared_language(html: str) -> str | None:
    """Language that the html tag or a content-language meta tag declares."""
    for tag in _tags(html, re.compile(r"(?i)<html\b")):
        if found := _LANG.search(tag):
            return found[1].lower()
    for tag in _tags(html, re.compile(r"(?i)<meta\b")):
        if said := _META_LANGUAGE.search(tag):
            for found in reversed(list(_CONTENT.finditer(tag, said.end()))):
                return found[1].lower()
    return None


def address_parts(url: str | None) -> tuple[str | None, str | None, str | None, str | None]:
    """Host, domain (its last two labels), suffix (the last), and a two-letter code that starts the path."""
    found = _ADDRESS.match(url.strip()) if url else None
    if not found or not found[1]:
        return None, None, None, None
    host = found[1].lower().rstrip(".")
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1], found[2].lower() if found[2] else None


# --- text model --------------------------------------------------------------------------------


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    log_likelihood: np.ndarray | None  # languages x slots; None when they are read in blocks
    counts: DataFrame | None = None  # (lang, slot, n), written

    def blocks(self) -> Iterator[TextModel]:
        """Models of at most ``LANGUAGE_BLOCK`` languages each, in order."""
        if self.counts is None:
            yield self
            return
        for at in range(0, len(self.languages), LANGUAGE_BLOCK):
            yield _dense(self.languages[at : at + LANGUAGE_BLOCK], self.counts)

    def evidence(self, text: str) -> np.ndarray:
        """Log-likelihood of each language, of at most ``FULL_TEXT`` 3-grams' worth."""
        return self.of_slots(gram_slots(text))

    def of_slots(self, slots: np.ndarray) -> np.ndarray:
        if not len(slots):
            return np.zeros(len(self.languages))
        mean = self.log_likelihood[:, slots].mean(axis=1)
        return mean * min(len(slots), FULL_TEXT)


def _dense(languages: list[str], counts: DataFrame) -> TextModel:
    """The model of a few languages from their written counts."""
    place = {lang: k for k, lang in enumerate(languages)}
    table = np.full((len(languages), SLOTS), 0.5)
    for row in counts.where(F.col("lang").isin(languages)).toLocalIterator():
        table[place[row.lang], row.slot] += row.n
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def train_text(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> TextModel:
    """3-gram counts per language over all documents with a language and a text, however many languages."""
    most = LANGUAGE_BLOCK

    def passed_on(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            slots = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots), pa.array(counts[slots])],
                ["lang", "slot", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                name = lang.as_py()
                if name not in sums and len(sums) == most:
                    yield from passed_on(sums)
                    sums = {}
                own = sums.setdefault(name, np.zeros(SLOTS, np.int64))
                own += np.bincount(gram_slots(text.as_py()), minlength=SLOTS)
        yield from passed_on(sums)

    usable = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    counts = usable.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")
    )
    counts = materialize(counts, "language-counts")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if len(languages) > LANGUAGE_BLOCK:
        return TextModel(languages, None, counts)
    return _dense(languages, counts)


# --- fusion ------------------------------------------------------------------------------------

_PAGE = (
    "page_id long, host string, domain string, suffix string, code string, declared string, "
    "evidence array<double>, own array<double>"
)


def _softmax(scores: np.ndarray) -> np.ndarray:
    power = np.exp(scores - scores.max())
    return power / power.sum()


def _observe(pages: DataFrame, model: TextModel) -> DataFrame:
    schema = pa.schema([
        ("page_id", pa.int64()), *((n, pa.string()) for n in ("host", "domain", "suffix", "code", "declared")),
        ("evidence", pa.list_(pa.float64())), ("own", pa.list_(pa.float64())),
    ])

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, url, html in zip(*batch.columns, strict=True):
                source = html.as_py() or ""
                evidence = model.evidence(visible_text(source))
                rows.append((page.as_py(), *address_parts(url.as_py()), declared_language(source),
                             evidence.tolist(), _softmax(evidence).tolist()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    read = pages.select(F.col("page_id").cast("long"), "url", "html")
    if model.counts is None:
        return read.mapInArrow(observe, _PAGE)
    return _observe_in_blocks(read, model)


def _observe_in_blocks(pages: DataFrame, model: TextModel) -> DataFrame:
    """The same for more languages than a task holds: 3-grams are written once, then scored by block."""

    @F.arrow_udf("struct<host:string,domain:string,suffix:string,code:string,declared:string,grams:binary>")
    def parts(urls: pa.Array, htmls: pa.Array) -> pa.Array:
        names = ("host", "domain", "suffix", "code", "declared")
        rows = []
        for url, html in zip(urls, htmls, strict=True):
            source = html.as_py() or ""
            known = dict(zip(names, (*address_parts(url.as_py()), declared_language(source)), strict=True))
            rows.append({**known, "grams": gram_slots(visible_text(source)).astype(np.int16).tobytes()})
        return pa.array(rows, pa.struct([*((n, pa.string()) for n in names), ("grams", pa.binary())]))

    def evidence(block: TextModel) -> Column:
        @F.arrow_udf("array<double>")
        def scored(grams: pa.Array) -> pa.Array:
            found = [block.of_slots(np.frombuffer(g.as_py(), np.int16)).tolist() for g in grams]
            return pa.array(found, pa.list_(pa.float64()))

        return scored(F.col("grams"))

    seen = pages.select("page_id", parts("url", "html").alias("p")).select("page_id", "p.*")
    seen = materialize(seen.withColumn("evidence", F.array().cast("array<double>")), "language-grams")
    for block in model.blocks():
        seen = materialize(seen.withColumn("evidence", F.concat("evidence", evidence(block))), "language-block")
    powers = F.transform("evidence", lambda e: F.exp(e - F.array_max("evidence")))
    whole = lambda p: F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    return (
        seen.drop("grams").withColumn("powers", powers).withColumn("whole", whole(F.col("powers")))
        .withColumn("own", F.transform("powers", lambda p: p / F.col("whole"))).drop("powers", "whole")
    )


def _sums(observed: DataFrame, keys: list[str], size: int, out: str) -> DataFrame:
    """Sum of the text posteriors of each key: an array over the languages."""
    if size > LANGUAGE_BLOCK:  # rows instead of columns
        summed = observed.select(*keys, F.posexplode("own")).groupBy(*keys, "pos").agg(F.sum("col").alias("s"))
        ranked = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("ranked"))
        return ranked.select(*keys, F.col("ranked.s").alias(out))
    return observed.groupBy(*keys).agg(
        F.array(*[F.sum(F.element_at("own", k + 1)) for k in range(size)]).alias(out)
    )


def _log_table(observed: DataFrame, column: str, size: int, total: list[float]) -> DataFrame:
    """Rows of ``observed`` with log P(column's value | language), the page itself left out. A missing
    value is a value like any other; a value seen on no other page says nothing."""
    counts = _sums(observed, [column], size, "sums").withColumnRenamed(column, "value")
    everything = F.array(*[F.lit(float(t)) for t in total])
    log = F.zip_with(
        F.zip_with("sums", "own", lambda s, o: F.greatest(s - o, F.lit(0.0))),
        F.zip_with(everything, F.col("own"), lambda t, o: F.greatest(t - o, F.lit(0.0))),
        lambda s, t: F.log((s + TABLE_PAGES / size) / (t + TABLE_PAGES)),
    )
    joined = observed.join(counts, F.col(column).eqNullSafe(F.col("value")), "left")
    return joined.withColumn(f"log_{column}", log).drop("value", "sums")


def _prior(observed: DataFrame, size: int, total: list[float]) -> DataFrame:
    """Rows with log of the host prior: host counts smoothed by the domain's, the domain's by all."""

    def smooth(counts: Column, above: Column) -> Column:
        return F.zip_with(counts, above, lambda c, a: c + PRIOR_PAGES * a)

    def without_own(sums: str) -> Column:
        empty = F.array(*[F.lit(0.0)] * size)
        return F.zip_with(F.coalesce(sums, empty), F.col("own"), lambda s, o: F.greatest(s - o, F.lit(0.0)))

    def normal(values: Column) -> Column:
        return F.transform(values, lambda v: v / F.aggregate(values, F.lit(0.0), lambda a, b: a + b))

    domains = _sums(observed.where("domain IS NOT NULL"), ["domain"], size, "domain_sums")
    hosts = _sums(observed.where("host IS NOT NULL"), ["host"], size, "host_sums")
    all_pages = F.array(*[F.lit(float(t)) for t in total])
    everywhere = F.zip_with(all_pages, F.col("own"), lambda t, o: F.greatest(t - o, F.lit(0.0)) + 1.0)
    joined = observed.join(domains, "domain", "left").join(hosts, "host", "left")
    return (
        joined.withColumn("p_all", normal(everywhere))
        .withColumn("p_domain", normal(smooth(without_own("domain_sums"), F.col("p_all"))))
        .withColumn("p_host", normal(smooth(without_own("host_sums"), F.col("p_domain"))))
        .withColumn("log_prior", F.transform("p_host", lambda p: F.log(p)))
        .drop("domain_sums", "host_sums", "p_all", "p_domain", "p_host")
    )


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """One row per page: page_id, host, declared, text_lang, lang and probability.

    ``text_lang`` is what the text alone says; ``lang`` is the most probable language by all evidence,
    ties to the first in alphabetical order, or "und" below a posterior of one half. Null or empty html
    has no text evidence and no declaration; a null or odd url has no host, which leaves the prior of
    all pages. Other columns are not read. Without labelled documents every page is undetermined.
    """
    size = len(model.languages)
    if not size:
        return pages.select(
            F.col("page_id").cast("long"), F.lit(None).cast("string").alias("host"),
            F.lit(None).cast("string").alias("declared"), F.lit(UNDETERMINED).alias("text_lang"),
            F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("probability"),
        )
    observed = materialize(_observe(pages, model), "language-pages")
    sums = _sums(observed.withColumn("all", F.lit(0)), ["all"], size, "sums").first()
    total = list(sums.sums) if sums else [0.0] * size
    judged = observed
    for column in ("declared", "suffix", "code"):
        judged = _log_table(judged, column, size, total)
    judged = _prior(judged, size, total)
    score = F.col("evidence")
    for part in ("log_declared", "log_suffix", "log_code", "log_prior"):
        score = F.zip_with(score, F.col(part), lambda a, b: a + b)
    names = F.array(*[F.lit(name) for name in model.languages])
    top = F.array_max("score")
    return judged.withColumn("score", score).select(
        "page_id", "host", "declared",
        F.when(F.array_max("evidence") > F.array_min("evidence"),
               F.element_at(names, F.array_position("evidence", F.array_max("evidence")).cast("int")))
        .otherwise(F.lit(UNDETERMINED) if size > 1 else names[0]).alias("text_lang"),
        F.element_at(names, F.array_position("score", top).cast("int")).alias("best"),
        (1.0 / F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - top))).alias("probability"),
    ).withColumn("lang", F.when(F.col("probability") >= SURE, F.col("best")).otherwise(F.lit(UNDETERMINED))).drop("best")
