"""Structure repair against an exhaustive search over edits, conversation by conversation."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from sitefold.llm import structure_repair as sr

WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over positions and the pattern read so far; each
    row is (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, read, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch(r"(s?(ua)+)?", read):
            return cost, audit, list(out)
        known = (at, read[-2:] if len(read) > 2 else read)
        if known in seen:
            continue
        seen.add(known)

        def push(more, letter, to, symbol, line, cost=cost, audit=audit, read=read, out=out):
            if symbol and not re.fullmatch(r"s?(ua)*u?", read + symbol):
                return
            heapq.heappush(heap, (cost + more, audit + letter, to, read + symbol, out + ((line,) if line is not None else ())))

        for role in ("user", "assistant"):
            push(3, "I", at, role[0], f"{role}:")
        if at < len(rows):
            role, text, fault = rows[at]
            push(4, "D", at + 1, "", None)
            if fault not in ("blank", "duplicate"):
                short = 3 if fault == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    push(short, "K", at + 1, role[:1], f"{role}:{text}")
                for new in ("user", "assistant"):
                    push(3 + short, "R", at + 1, new[0], f"{new}:{text}")


def brute(rows):
    """The report of every conversation of damaged rows by the plain rules."""
    told = lambda v: " " if v is None else str(v)
    damaged = []
    for conv, turn, role, text in rows:
        role, text = told(role), told(text)
        fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in damaged if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        judged, seen = [], set()
        for _, role, text in mine:
            found = WORD.findall(text)
            judged.append((role, text, "blank" if not found else "duplicate" if (role, text) in seen else
                           "truncated" if found[-1] not in ".!?" else ""))
            seen.add((role, text))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, lines = cheapest(judged)
        count = [sum(j[2] == f for j in judged) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    made = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place long, edit string"
    ).repartition(3)
    found = sr.damage_and_repair(made)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, conversations=120):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = draw.choice((0, 0, 1, -3))
        for k in range(draw.choice((0, 1, 2, 3, 4, 6, 9))):
            role = draw.choice(("user", "assistant") * 4 + ("system", "tool", "", None)) if draw.random() < 0.4 else (
                "user" if k % 2 else "assistant")
            text = draw.choice((f"Said {k}.", "Again!", "no end", "Ends? \n", "", None, " \t", "é…", f"x{k} ", "a.b"))
            rows.append((conv, None if draw.random() < 0.05 else turn, role, text))
            turn += draw.choice((1, 1, 1, 0, 3))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, None, "system", "S."), (999, None, "user", "Alone.")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_search(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_pieces_do_not_matter(spark, monkeypatch):
    """Conversations over many pieces, one of which holds most rows."""
    monkeypatch.setattr(sr, "PIECE_BITS", 1)
    rows = corpus(4, 30)
    rows += [(500, k, r, t) for k, (_, _, r, t) in enumerate(corpus(5, 60)) if r]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows(spark):
    rows = [(1, 0, "user", "Same.")] * 40 + [(1, 1, "assistant", "Same.")] * 3 + [(2, 5, "x", "")] * 9
    assert run(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert run(spark, []) == []
    repaired, report = sr.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert repaired.count() == report.count() == 0


def test_repaired_rows(spark):
    rows = [(7, 0, "system", "S."), (7, 1, "user", "A?"), (7, 3, "user", "B?"), (7, 4, "user", "C."), (7, 5, "assistant", "cut")]
    repaired, report = sr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = report.first()
    assert (found.gaps, found.truncated, found.illegal, found.cost, found.audit) == (1, 1, 2, 6, "KKRKK")
    lines = [(r.role, r.text, r.action) for r in repaired.orderBy("place", "step").collect()]
    assert lines == [("system", "S.", "K"), ("user", "A?", "K"), ("assistant", "B?", "R"), ("user", "C.", "K"), ("assistant", "cut", "K")]
