"""Lexical search against scoring every document of small tables."""

import math
import random
import re

import numpy as np
import pytest

from sitefold.llm import lexical_search as ls


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top=10):
    split = [(i, words(t)) for i, t in docs]
    split = [(i, w) for i, w in split if w]
    n_docs, n_terms = len(split), sum(len(w) for _, w in split)
    out = []
    for item, text in items:
        scored = []
        for doc_id, w in split:
            m = 10 + (90 * len(w) * n_docs) // n_terms
            score = 0
            for t in set(words(text)):
                df, tf = sum(t in v for _, v in split), w.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    found = ls.search(
        spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, item int").repartition(3),
        spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string"), **options,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed):
    draw = random.Random(seed)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(400)]
    text = lambda n: " ".join(draw.choice(common if draw.random() < 0.7 else rare) for _ in range(n))
    docs = [(k, text(draw.choice((1, 5, 40, 200)))) for k in draw.sample(range(9999), 150)]
    docs += [(k + 20000, t) for k, t in docs[:30]]  # ties
    docs += [(5, None), (6, ""), (7, " .,\n"), (8, "C1 Éa-éA c1"), (None, "r1 r2"), (None, "r1 r2"), (3, "r1"), (3, "r1")]
    items = [(k, text(draw.choice((1, 3, 30)))) for k in range(25)] + [(50, None), (51, ""), (52, "nowhere"), (53, "éA r1 r1")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_scoring_everything(spark, seed, monkeypatch):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_and_rounds_do_not_matter(spark):
    docs, items = corpus(3)
    items += [items[3]]  # a repeated item is an item of its own
    assert run(spark, docs, items, item_bytes=300) == brute(docs, items)


def test_no_rows(spark):
    docs, items = corpus(4)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == []


@pytest.mark.parametrize("seed", range(20))
def test_one_block_after_another(seed):
    """Skipping finds what adding up all lists finds, whatever is accumulated and in whatever runs."""
    draw = random.Random(seed)
    size = 500
    for short in (0, 40, size):
        best, every = ls.Best(5), []
        for block in range(3):
            lists = []
            for _ in range(draw.choice((1, 4, 9))):
                places = np.array(sorted(draw.sample(range(size), draw.choice((1, 20, 300)))))
                lists.append((places, np.array([draw.randrange(1, 30) for _ in places])))
            ids = [block * size + k for k in range(size)]
            sums = np.zeros(size, np.int64)
            for places, scores in lists:
                sums[places] += scores
            every += [(-int(s), i) for s, i in zip(sums, ids, strict=True) if s]
            ls.search_block(lists, ids, best, short)
        assert [(-s, i) for s, i in best.rows] == sorted(every)[:5]
