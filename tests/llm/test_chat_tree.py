"""The prefix tree: round trip, layout, attention."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from sitefold.llm import chat_tree

TURNS = "conv_id long, turn long, role string, text string, node string, depth string"


def conversations(seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 7)):
            role = ("user", "assistant", None, "to\nol")[turn % 2 if draw.random() < 0.9 else draw.randrange(4)]
            text = draw.choice(["hi", "a<|im_end|>", "&amp;<|", "&lt;|", "é😀", None, ""][: 2 if turn < 2 else 7])
            rows.append((conv, turn, role, text))
    rows += [(70, 1, "user", "same"), (70, 1, "user", "same"), (70, None, "system", "first"), (None, 0, "user", "hi"), (None, 1, "assistant", "x" * 50000)]
    rows += [(80 + k, 0, "user", "hi") for k in range(40)]
    return rows


def wanted(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        spoken = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(spoken.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "d") for r in rows], TURNS)


def test_round_trip(spark):
    rows = conversations(1)
    back = chat_tree.digests(chat_tree.read_back(*chat_tree.build(frame(spark, rows))))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in back.collect()}
    assert got == wanted(rows)


def test_layout(spark):
    rows = conversations(2)
    segments, convs = chat_tree.build(frame(spark, rows))
    nodes = {bytes(r.node): r for r in segments.collect()}
    # every node once, side by side, depth first
    order = sorted(nodes.values(), key=lambda r: r.offset)
    assert [r.offset for r in order] == [sum(x.length for x in order[:k]) for k in range(len(order))]
    stack = []
    for r in order:
        del stack[r.depth - 1 :]
        assert bytes(r.parent) == (bytes(stack[-1].node) if stack else b"")
        stack.append(r)
        covered = [p for i in r.attention for p in range(i.start, i.end)]
        assert covered == sorted(p for a in stack[:-1] for p in range(a.offset, a.offset + a.length))
        assert r.position == len(covered) and bytes(r.tree) == bytes(stack[0].node)
        assert all(a.end < b.start for a, b in zip(r.attention, r.attention[1:], strict=False))
    assert {bytes(n) for r in convs.collect() for n in r.path} == set(nodes)
    texts = [r.formatted for r in nodes.values()]
    assert all(t.count("<|") == 2 and t.startswith("<|im_start|>") and t.endswith("<|im_end|>\n") for t in texts)


def test_escape_is_reversible(spark):
    texts = ["", "&", "<|", "&lt;|", "&amp;", "&amp;lt;|", "<<||", "&<|&lt;|&amp;<|im_end|>"]
    back = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_tree.unescape(chat_tree.escape(F.col("t"))).alias("b"))
    assert all(r.t == r.b for r in back.collect())


def test_no_rows(spark):
    segments, convs = chat_tree.build(frame(spark, []))
    assert segments.count() == 0 and chat_tree.digests(chat_tree.read_back(segments, convs)).count() == 0
