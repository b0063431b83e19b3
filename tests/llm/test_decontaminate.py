"""Decontamination against a plain search for every window."""

import hashlib
import random
import re

from sitefold.llm.decontaminate import blocks_of, decontaminate, find_items, n_hit, report

ITEMS = "item_id long, text string, hits string"
DOCS = "doc_id long, text string, found string, n_words string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        parts = words(item)
        size = min(13, len(parts))
        for start in range(len(parts) - size + 1) if parts else ():
            for at in range(len(own) - size + 1):
                if own[at : at + size] == parts[start : start + size]:
                    hit.update(range(at, at + size))
                    found.add(str(name))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


def cases():
    draw = random.Random(3)
    vocabulary = ["the", "Été", "o'clock", "x1", "naïve", "B", "c_d", "ß", "中文", "end."]
    line = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(k, line(draw.choice((3, 12, 13, 14, 40)))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "?!"), (0, "other text under the same name as the first one"), (60, items[3][1])]
    docs = []
    for k in range(60):
        parts = [line(draw.randrange(60))]
        if k % 2:
            parts.insert(draw.randrange(2), draw.choice(items)[1] or "")
        docs.append((k, ", ".join(parts).swapcase() if k % 5 == 0 else "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, "..."), (103, " ".join(["filler"] * 5000) + " " + items[2][1]), (3, "repeated")]
    return docs, items


def test_against_plain_search(spark):
    docs, items = cases()
    found = report(
        spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS), spark.createDataFrame([(*i, "z") for i in items], ITEMS)
    )
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect())
    assert got == sorted((i, *brute(text, items)) for i, text in docs)


def test_blocks_give_the_same(spark):
    docs, items = cases()
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for limit in (1 << 20, 20):
        found = find_items(docs, items, block_windows=limit)
        rows.append(sorted((r.doc_id, r.n, r.found) for r in found.select("doc_id", n_hit().alias("n"), "found").collect()))
    assert rows[0] and rows[0] == rows[1]


def test_blocks_are_bounded(spark):
    draw = random.Random(5)
    line = lambda n: " ".join(f"w{draw.randrange(1000)}" for _ in range(n))
    items = [("long", line(5000)), ("again", line(30)), *[("again", line(30))] * 50, ("short", "two words"), ("none", "?")]
    items += [(f"q{k}", line(20)) for k in range(200)]
    blocked = blocks_of(spark.createDataFrame(items, "name string, item_text string"), limit=300)
    sizes = [r["sum(n_windows)"] for r in blocked.groupBy("bucket", "part").sum("n_windows").collect()]
    assert max(sizes) <= 600 and len(sizes) >= 20
    windows = {(r.name, " ".join(r.piece.split()[k : k + 13])) for r in blocked.collect() for k in range(r.n_windows)}
    assert windows == {
        (name, " ".join(text.split()[k : k + 13])) for name, text in items if text != "?"
        for k in range(max(1, len(text.split()) - 12))
    }


def test_spans_lie_in_the_original(spark):
    item = "Wörter die als Frage gelten"
    text = f"Vorher: «ä» 😀 {item.upper()}! Nachher."
    found = report(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, item.upper())], "item_id long, text string"))
    [span] = found.first().spans
    assert text[span.start : span.end] == item.upper()


def test_rows_that_stay(spark):
    docs, items = cases()
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    kept = decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in docs if not brute(t, items)[4])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert report(none, no_items).count() == 0
    assert report(one, no_items).first().n_hit == 0 and decontaminate(one, no_items).count() == 1
