"""Language fusion against a plain computation; licence scan on known and unknown paragraphs."""

import time
import math
import random
from collections import defaultdict

import pytest

from sitefold.llm import language_id as L
from sitefold.llm import license_scan as S

PAGES = "page_id long, url string, html string, lang string, own string"
WORDS = {"en": "the of and with that from this".split(), "de": "der die und mit das von nicht".split(), "fr": "le la et avec que des dans".split()}


def text(draw, lang, n):
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "s", "en", "x"]) for _ in range(n))


def model(spark):
    draw = random.Random(1)
    rows = [(k, text(draw, lang, 60), lang, "x") for k, lang in enumerate(list(WORDS) * 20)] + [(99, None, "en", "x"), (98, "a", None, "x")]
    return L.train_text(spark.createDataFrame(rows, "doc_id long, text string, lang string, slot string"))


def pages():
    draw = random.Random(4)
    rows = []
    for k in range(120):
        lang = draw.choice(list(WORDS))
        host = f"{'www' if k % 2 else 'blog'}.{lang}{k % 5}.example" if k % 3 else "HOT.example:80"
        said = draw.choice([lang, lang, "en"])
        path = draw.choice([f"/{lang}/x", "/x", "/zz/y?z"])
        body = text(draw, lang, draw.choice((0, 1, 3, 50)))
        rows.append((k, f"http://{host}{path}", f'<html lang="{said}-XX"><style>the the</style><p>{body}</p><!-- le -->', "x", "y"))
    rows += [(200, None, None, "x", "y"), (201, "not a url", "", "x", "y"), (202, "//h", "<p>" + "der und " * 20000, "x", "y"), (202, "//h", "<p>", "x", "y")]
    return rows


def plain(rows, trained):
    """The same fusion, one page after the other."""
    n, seen = len(trained.languages), []
    for page, url, html, *_ in rows:
        evidence = trained.evidence(L.visible_text(html or "")).tolist()
        own = [math.exp(e - max(evidence)) for e in evidence]
        own = [o / sum(own) for o in own]
        host, domain, suffix, code = L.address_parts(url)
        seen.append((page, host, domain, suffix, code, L.declared_language(html or ""), evidence, own))

    def sums(index, value, but):
        return [max(0.0, sum(s[7][k] for s in seen if s[index] == value) - but[k]) for k in range(n)]

    total = [sum(s[7][k] for s in seen) for k in range(n)]
    out = []
    for s in seen:
        own, rest = s[7], [max(0.0, t - o) for t, o in zip(total, s[7], strict=True)]
        score = list(s[6])
        for index in (5, 3, 4):
            c = sums(index, s[index], own)
            score = [x + math.log((c[k] + 1 / n) / (rest[k] + 1)) for k, x in enumerate(score)]
        p = [(r + 1) / (sum(rest) + n) for r in rest]
        for index in (2, 1):
            c = [0.0] * n if s[index] is None else sums(index, s[index], own)
            p = [(c[k] + L.PRIOR_PAGES * p[k]) for k in range(n)]
            p = [x / sum(p) for x in p]
        score = [x + math.log(q) for x, q in zip(score, p, strict=True)]
        best = max(score)
        probability = 1 / sum(math.exp(x - best) for x in score)
        out.append((s[0], trained.languages[score.index(best)] if probability >= L.SURE else "und", round(probability, 6)))
    return sorted(out, key=repr)


def test_fusion_against_plain_computation(spark):
    trained = model(spark)
    assert trained.languages == ["de", "en", "fr"]
    rows = pages()
    found = L.identify(spark.createDataFrame(rows, PAGES), trained)
    got = sorted(((r.page_id, r.lang, round(r.probability, 6)) for r in found.collect()), key=repr)
    assert got == plain(rows, trained)


def test_many_languages(spark):
    draw = random.Random(2)
    rows = [(k, text(draw, "en", 5) + f" only{chr(97 + k % 26)}{chr(97 + k // 26)}", f"l{k:03}", "x") for k in range(150)]
    trained = L.train_text(spark.createDataFrame(rows, "doc_id long, text string, lang string, slot string").repartition(2))
    assert len(trained.languages) == 150
    some = [(k, f"http://h{k % 3}.example/", f"<p>{rows[k * 9][1]}</p>", "x", "y") for k in range(12)]
    found = L.identify(spark.createDataFrame(some, PAGES), trained)
    whole = L._dense(trained.languages, trained.counts)
    got = sorted(((r.page_id, r.lang, round(r.probability, 6)) for r in found.collect()), key=repr)
    assert got == plain(some, whole)


def test_evidence_outweighs_a_wrong_declaration(spark):
    trained = model(spark)
    draw = random.Random(9)
    rows = [(k, f"http://h{k % 7}.example/", f"<html lang=en>{text(draw, 'de', 60)}", "x", "y") for k in range(40)]
    assert {r.lang for r in L.identify(spark.createDataFrame(rows, PAGES), trained).collect()} == {"de"}


def test_no_pages_and_no_languages(spark):
    none = spark.createDataFrame([], PAGES)
    assert L.identify(none, model(spark)).count() == 0
    bare = L.train_text(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang for r in L.identify(spark.createDataFrame(pages()[:3], PAGES), bare).collect()] == ["und"] * 3


@pytest.mark.parametrize("url, parts", [
    ("https://user@Blog.Site.example.com:8080/de/x", ("blog.site.example.com", "example.com", "com", "de")),
    ("//a.fr", ("a.fr", "a.fr", "fr", None)), ("/only/path", (None,) * 4), (None, (None,) * 4), ("http://x/eng/", ("x", "x", "x", None)),
])
def test_address(url, parts):
    assert L.address_parts(url) == parts


# --- licences ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier():
    draw = random.Random(3)
    return S.fit([" ".join(draw.choice(sum(WORDS.values(), [])) + draw.choice(["", "ing"]) for _ in range(30)) for _ in range(300)])


@pytest.mark.parametrize("paragraph, family", [
    ("Released under the MIT License.", "MIT"), ("This file is licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD"), (" ".join(S.TEMPLATES["MIT"][-1].upper().split()[:40]), "MIT"),
])
def test_families(classifier, paragraph, family):
    found, probability, confirmed = classifier.judge(paragraph)
    assert found == family and confirmed and 0.6 <= probability <= 1


@pytest.mark.parametrize("paragraph", [
    "", "mit", "Mit der und die.", "the work of the public and the terms of use", "software copies without the free use of general terms",
    "with that from this the of and", "He got his driving license from the general office in person.",
])
def test_unknown(classifier, paragraph):
    judged = classifier.judge(paragraph)
    assert judged is None or not judged[2]


def test_scan_of_documents(spark, classifier):
    line = "Released under the MIT License."
    wrapped = S.TEMPLATES["BSD"][-1].replace(" with or", "\nwith or").replace("provided", "\nprovided")
    long = "filler words\n" * 20000 + line
    rows = [(1, f"é text\n{line}\nmore"), (2, wrapped), (3, None), (4, ""), (5, "nothing here"), (6, long), (6, long)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, found string, families string")
    got = S.scan_licences(docs, classifier).collect()
    families = sorted((r.doc_id, tuple(r.families)) for r in got)
    assert families == [(1, ("MIT",)), (2, ("BSD",)), (3, ()), (4, ()), (5, ()), (6, ("MIT",)), (6, ("MIT",))]
    texts = dict(rows)
    for r in got:
        assert all(f.end <= len(texts[r.doc_id]) for f in r.found)
        assert r.n_paragraphs == 0 if not texts[r.doc_id] else r.n_paragraphs > 0
    [one] = next(r.found for r in got if r.doc_id == 1)[:1]
    assert line in texts[1][one.start : one.end]
    assert S.scan_licences(docs.limit(0), classifier).count() == 0


def test_training_from_documents(spark):
    rows = [(k, f"plain words {k} and others") for k in range(20)] + [(99, None), (98, "")]
    trained = S.train(spark.createDataFrame(rows, "doc_id long, text string"))
    assert trained.judge("Released under the MIT License.")[0] == "MIT"


def test_counts_by_language_are_sums(spark):
    rows = [(1, "aaaa", "x"), (2, "aaaa", "x"), (3, "bbb", "y")]
    trained = L.train_text(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    table = defaultdict(float)
    for lang, t in (("x", "aaaa"), ("x", "aaaa"), ("y", "bbb")):
        for slot in L.gram_slots(t):
            table[lang, slot] += 1
    for k, lang in enumerate(trained.languages):
        counts = [0.5 + table[lang, s] for s in range(L.SLOTS)]
        assert abs(trained.log_likelihood[k][int(L.gram_slots("aaaa")[0])] - math.log(counts[int(L.gram_slots("aaaa")[0])] / sum(counts))) < 1e-9


@pytest.mark.parametrize("piece", ["<meta http-equiv=content-language ", "<!-- ", "<script ", "<html lang ", "< ", "</script  ", "<style>x</"])
def test_pages_of_unclosed_markup_are_read_in_one_pass(piece):
    page = "<p>before</p>" + piece * (5_000_000 // len(piece))
    began = time.perf_counter()
    assert L.visible_text(page).split()[0] == "before"
    assert L.declared_language(page) is None
    assert time.perf_counter() - began < 2


def test_visible_text_and_declared_language():
    page = "<html><META content='xx' http-equiv=\"Content-Language\" content='fr-CA'>a<!-- b > --><b>c</b><style>d</style  >e &lt; 1 < 2"
    assert L.visible_text(page).split() == ["a", "c", "e", "<", "1", "<", "2"]
    assert L.declared_language(page) == "fr"
    assert L.declared_language("<html class=x><html data='>' lang=de>") is None
    assert L.declared_language("<HTML class=x LANG = 'De-at'>") == "de"
    assert L.visible_text("a<script>b") .split() == ["a"]


def test_wrapped_passages_across_the_cut_of_a_long_run():
    from sitefold.llm.license_scan import WRAP_LINES, paragraphs

    text = "\n".join(f"line {k}" for k in range(3 * WRAP_LINES + 5))
    spans = [text[a:b].split("\n") for a, b in paragraphs(text)]
    runs = [s for s in spans if len(s) > 1]
    assert max(map(len, runs)) == WRAP_LINES and [s for s in spans if len(s) == 1] == [[x] for x in text.split("\n")]
    for first in range(3 * WRAP_LINES + 5 - WRAP_LINES // 2 + 1):
        wanted = [f"line {k}" for k in range(first, first + WRAP_LINES // 2)]
        assert any(wanted == r[k : k + len(wanted)] for r in runs for k in range(len(r)))


def test_background_comes_from_whole_texts(spark, monkeypatch):
    from sitefold.llm import license_scan

    seen = []
    monkeypatch.setattr(license_scan, "fit", seen.extend)
    rows = [(f"same first line\nsecond of {k}\n\nthird of {k}\nMIT License",) for k in range(40)] + [(None,), ("",)]
    rows += [("x" * 9000 + "\n",), ("Copyright only",)]
    license_scan.train(spark.createDataFrame(rows, "text string"), rows=100)
    assert len(seen) == 41 and any(p.startswith("second") for p in seen) and any(p.startswith("third") for p in seen)
    assert not any("MIT" in p or "Copyright" in p for p in seen) and max(map(len, seen)) <= 4000
