"""I-Match fingerprints against a plain version in Python, and what they tell apart."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import xxhash

from sitefold.llm import imatch
from sitefold.llm.imatch import SUBSETS, compare_edits, fingerprint


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered))


def signed(text):
    value = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def plain_print(text, df, n_docs):
    found = words(text)
    level = max(0, math.ceil(math.log2(max(1, len(found)) / (SUBSETS * 1.5))))
    kept = [signed(w) for w in found if 2 <= df[w] <= max(n_docs // 100, 10)]
    hashes = []
    for subset in range(SUBSETS):
        for deep in (level, level + 1):
            inside = sorted(g for g in kept if g % SUBSETS == subset and (g // SUBSETS) % 2**deep == 0)
            hashes.append(hashlib.md5(",".join(map(str, inside)).encode()).hexdigest()[:4] if inside else "....")
    if all(h == "...." for h in hashes):
        return "text:" + hashlib.md5((text or "").encode()).hexdigest()
    return f"{level:02X}:" + "".join(hashes)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if a.startswith("text:") or b.startswith("text:") or abs(int(a[:2], 16) - int(b[:2], 16)) > 1:
        return 0.0
    top = max(int(a[:2], 16), int(b[:2], 16))
    sides = [[f[3 + 8 * k + 4 * (top - int(f[:2], 16)) :][:4] for k in range(SUBSETS)] for f in (a, b)]
    same = sum(x == y != "...." for x, y in zip(*sides, strict=True))
    held = sum(x != "...." or y != "...." for x, y in zip(*sides, strict=True))
    return same / held if held else 0.0


def plain(rows):
    df = Counter(w for _, t in rows for w in words(t))
    hashed = lambda r: xxhash.xxh64_intdigest((r[1] or "").encode(), seed=int.from_bytes(
        (xxhash.xxh64_intdigest((r[0]).to_bytes(8, "little", signed=True), seed=42) if r[0] is not None else 42).to_bytes(8, "little"), "little"))
    key = lambda r: hashed(r) - (1 << 64) if hashed(r) >> 63 else hashed(r)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), key(r)))
    out = []
    for k, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edit = text[: len(text) - third] + after[:third]
        f, e, n = (plain_print(t, df, len(rows)) for t in (text, edit, after))
        out.append((doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest(), f, e, plain_likeness(f, e), plain_likeness(f, n)))
    return sorted(out, key=str)


def run(spark, rows):
    made = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, level int, key string")
    found = compare_edits(made.repartition(3))
    assert found.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    ]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(600)] + ["É", "naïve", "Straße", "日本"]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice((1, 4, 20, 60, 300)))) for _ in range(60)]
    texts += [t.upper() for t in texts[:5]] + texts[:8]
    return list(zip(draw.sample(range(-50, 900), len(texts)), texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_version(spark, seed):
    rows = corpus(seed) + [(1000, None), (1001, ""), (1002, " .\n"), (1003, "ab"), (None, "w1 w2 w3"), (None, "w4 w5"),
                           (7777, "w1 w2 w3 w9"), (7777, "w1 w2 w3 w9"), (7777, "w1 w2 w3 w9"), (7777, "w5 w6")]
    assert run(spark, rows) == plain(rows)


def test_one_row_and_none(spark):
    assert run(spark, [(1, "a b c d e f")]) == plain([(1, "a b c d e f")])
    assert run(spark, []) == []
    assert run(spark, [(4, "a b c"), (4, "a b c")]) == plain([(4, "a b c"), (4, "a b c")])


def test_edits_are_told_from_other_texts(spark):
    draw = random.Random(8)
    vocabulary = [f"v{k}" for k in range(20000)]
    rows = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.choice((60, 200, 900))))) for k in range(200)]
    found = run(spark, rows)
    edits, others = [r[5] for r in found], [r[6] for r in found]
    assert sum(e > 0.15 for e in edits) >= 190
    assert sum(o > 0.15 for o in others) <= 10


def test_fingerprint_alone_agrees(spark):
    rows = corpus(3)
    made = spark.createDataFrame(rows, "doc_id long, text string")
    alone = {r.key: r.fingerprint for r in fingerprint(made).collect()}
    assert alone == {r[0]: r[3] for r in run(spark, rows)}


def test_native_path(spark, monkeypatch):
    """No Python worker on the main path: neither in the last plan nor in one that is written on the way."""
    plans = []
    written = imatch.materialize

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(imatch, "materialize", noted)
    found = compare_edits(spark.createDataFrame(corpus(4), "doc_id long, text string").limit(20).sort("doc_id"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 4
    assert not any(word in plan for plan in plans for word in ("Python", "Arrow", "Pandas"))
