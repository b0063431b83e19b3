"""The Jaccard join against all pairs of small tables."""

import random
import re
import time

import pytest

from sitefold.llm import jaccard_join
from sitefold.llm.jaccard_join import components, keep_one, link_components, word_hashes
from sitefold.session import materialize, release

SCHEMA = "doc_id long, text string, sid long, n long, gram string"


def grams(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """{row number: (set size, smallest id reached)} by comparing all pairs."""
    sets = [grams(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted((rows[k][0], len(sets[k]), least[root(k)]) for k in range(len(rows)))


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)


def run(spark, rows):
    found = link_components(table(spark, rows))
    assert found.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())


def corpus(seed):
    """Originals, copies with a few to many edits, shared passages, copies of copies, short texts."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [f"p{k}" for k in range(60)]
    texts = [[draw.choice(words) for _ in range(draw.choice((3, 8, 30, 120, 200)))] for _ in range(25)]
    for _ in range(90):
        base = list(draw.choice(texts))
        for _ in range(draw.choice((0, 1, 1, 2, 4, 8))):
            base[draw.randrange(len(base))] = draw.choice(words)
        if draw.random() < 0.3:
            at = draw.randrange(len(base) + 1)
            base[at:at] = passage[: draw.choice((10, 30, 60))]
        if draw.random() < 0.2:
            base = base[: max(1, len(base) - draw.randrange(20))]
        texts.append(base)
    texts += [[], ["one"], ["One"], ["a", "b"], passage, passage[:-3], passage[1:]]
    ids = draw.sample(range(1000), len(texts))
    return [(i, " ".join(t) if k % 3 else "\n".join(t).upper()) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(5000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (5, long), (4, long + " y"), (4, long + " y"), (7, "b"), (6, "B")]
    assert run(spark, rows) == brute(rows)


def test_null_id(spark):
    rows = table(spark, [(None, "a b"), (9, "a b"), (None, "c")])
    found = {(r.doc_id, r.component_id) for r in link_components(rows).collect()}
    assert found == {(None, 9), (9, 9), (None, None)}


def test_no_rows(spark):
    assert run(spark, []) == []
    assert keep_one(table(spark, [])).count() == 0


def test_many_near_copies_of_one_text(spark):
    draw = random.Random(5)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(300):
        text = list(base)
        text[draw.randrange(100)] = f"e{k}"
        rows.append((k, " ".join(text)))
    assert {r[2] for r in run(spark, rows)} == {0}


def test_keep_one_of_each_group(spark):
    rows = corpus(4) + [(2000, "same text here"), (2000, "same text here")]
    kept = keep_one(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "sid", "n", "gram"]
    got = sorted(r.doc_id for r in kept.collect())
    want = sorted({i for i, size, least in brute(rows) if i == least or size == 0})
    assert got == want


def near(name):
    """A text and a near copy of it."""
    words = [f"{name}{k}" for k in range(60)]
    return " ".join(words), " ".join([*words[:-1], "other"])


def test_keep_one_by_row_where_ids_repeat(spark):
    (a, a2), (b, b2), (c, c2) = near("a"), near("b"), near("c")
    rows = [(5, a), (7, a2), (5, b), (3, b2), (8, c), (8, c2), (8, c.upper()), (9, ""), (9, ""), (9, " ")]
    kept = keep_one(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text[:1].lower()) for r in kept) == [(3, "b"), (5, "a"), (8, "c"), (9, ""), (9, " ")]


def test_null_ids_are_compared(spark):
    (a, a2), (b, b2), (c, _) = near("a"), near("b"), near("c")
    rows = [(None, a), (None, a2), (None, a), (4, b), (None, b2), (None, c), (None, ""), (None, None)]
    found = link_components(table(spark, rows)).collect()
    assert sorted(str(r.component_id) for r in found) == ["4", "4"] + ["None"] * 6
    kept = keep_one(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), (r.text or "")[:1]) for r in kept) == [
        ("4", "b"), ("None", ""), ("None", ""), ("None", "a"), ("None", "c"),
    ]


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(21)}, **{k: 100 for k in range(100, 130)}}


@pytest.mark.parametrize("seed", [6, 7])
def test_family_of_many_components(spark, seed):
    """Variants of a text that is not there: their head links with few of them, and pairs link here and there."""
    draw = random.Random(seed)
    base = [f"b{k}" for k in range(110)]
    passage = [f"p{k}" for k in range(25)]
    variants = []
    for k in range(70):
        text = list(draw.choice(variants)) if variants and draw.random() < 0.4 else list(base)
        for _ in range(draw.choice((1, 2, 3, 4, 5))):
            text[draw.randrange(len(text))] = f"e{draw.randrange(40)}"
        if draw.random() < 0.3:
            at = draw.randrange(len(text))
            text[at:at] = passage
        variants.append(text[: draw.choice((None, None, -15))])
    rows = [(k, " ".join(t)) for k, t in enumerate(variants)]
    want = brute(rows)
    assert len({c for _, _, c in want}) > 15
    assert run(spark, rows) == want


def test_word_hashes_follow_split(monkeypatch):
    """A hash for each word that split finds, the same wherever the word stands and however texts are cut."""
    draw = random.Random(8)
    parts = ["a", "B", "b", " ", "\t", "\x0b", "\x1c", "\x00", "é", "\u2003", "x" * 63, "Y" * 65]
    seen = {}
    for _ in range(2000):
        raw = "".join(draw.choice(parts) for _ in range(draw.randrange(60))).encode()
        monkeypatch.setattr(jaccard_join, "PIECE", draw.choice((1, 7, 100, 1 << 20)))
        words, hashes = raw.lower().split(), word_hashes(raw).tolist()
        assert len(words) == len(hashes)
        for word, value in zip(words, hashes, strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_heads_that_share_a_passage(spark):
    """Texts of which half is one passage: they meet in lists, and few of them link."""
    draw = random.Random(9)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for k in range(60):
        own = [f"o{k // 3}x{i}" for i in range(70)]
        for _ in range(draw.choice((1, 4, 9))):
            own[draw.randrange(70)] = f"e{draw.randrange(30)}"
        rows.append((k, " ".join([*own, *passage])))
    assert run(spark, rows) == brute(rows)


def test_components_are_read_without_their_steps(spark):
    """What is returned is a scan of written rows: plans that use it don't hold the rounds once more."""
    links = spark.createDataFrame([(3, 2), (2, 1), (5, 4)], "a long, b long")
    found = components(links)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Aggregate", "Union", "Join")), plan
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]


def test_shuffles_are_dropped_on_the_way(spark, monkeypatch):
    """A join that has run many steps leaves the driver few of their shuffles."""
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    made, left = [], []

    def written(df, label):
        out = materialize(df, label)
        made.append(label)
        if label == "gram-undecided":
            time.sleep(1)  # the cleaner works beside
            left.append(tracker.shuffleStatuses().size())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", written)
    release(spark)
    time.sleep(1)
    before = tracker.shuffleStatuses().size()
    link_components(table(spark, corpus(1)))
    assert left[0] - before < len(made), (before, left, len(made))


def test_steps_without_rows_are_left_out(spark, monkeypatch):
    """No families in several components and no heads left undecided: nothing is joined for them."""
    written = []
    monkeypatch.setattr(jaccard_join, "materialize", lambda df, label: (written.append(label), materialize(df, label))[1])
    rows = [(k, " ".join(f"{k}-{w}" for w in range(20))) for k in range(4)] + [(9, " ".join(f"0-{w}" for w in range(20)) + " x")]
    assert run(spark, rows) == brute(rows)
    assert not {"gram-offers", "gram-inside", "gram-open", "gram-derived"} & set(written), written
