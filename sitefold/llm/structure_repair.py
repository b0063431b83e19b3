"""Conversation structure repair by generalised LR parsing of the roles, with weighted edits.

A conversation is read as a sentence of role initials. Its grammar, an optional system turn and then
pairs of user and assistant, has an LR table; the parser keeps all stacks that edits could lead to, as
one graph: stacks share what lies below their tops, and of stacks with equal tops only the one with
the smallest (cost, audit) goes on, since whatever follows, all of them take it alike. A turn may be kept,
given another role or deleted, and empty turns inserted.

Long conversations are not gathered in one task. Turns are sorted across tasks and cut into pieces of a
bounded number of lines. A piece is parsed once from each top that its predecessor may leave, which gives
the cheapest edits from top to top; chaining these finds the whole conversation's edits, which then go
back to the turns by a join. What one row holds of a conversation is its edits, a letter for each turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.session import materialize

#: Costs of edits; ``SHORTENED`` is added for a truncated turn that is not deleted.
REROLE, DELETE, INSERT, SHORTENED = 3, 4, 3, 3
#: Lines of a piece at most.
PIECE_BITS = 12
#: Parsed pieces that a Python worker remembers; most conversations look alike.
REMEMBERED = 1 << 14

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLES = {"u": "user", "a": "assistant"}

#: LR table of  C -> (empty) | L | s L,  L -> u a | L u a.  A reduction pops that many nodes.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 6, (3, "u"): 5, (4, "u"): 5, (5, "a"): 7}
REDUCE = {6: (2, "L"), 7: (3, "L")}
GOTO = {(0, "L"): 3, (1, "L"): 4}
ACCEPT = (0, 3, 4)

#: A stack for each top; those with the same top differ only in what no later turn can tell.
_BOTTOM = (0, None)
STACKS = {
    0: _BOTTOM, 1: (1, _BOTTOM), 2: (2, _BOTTOM), 3: (3, _BOTTOM), 4: (4, (1, _BOTTOM)), 5: (5, (3, _BOTTOM)),
}

Stack = tuple[int, "Stack | None"]
Frontier = dict[int, tuple[int, str, Stack]]  # top -> (cost, audit, stack)


# --- parser ------------------------------------------------------------------------------------


def _shift(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and the reductions that follow; None where it can't be read."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        count, symbol = REDUCE[stack[0]]
        for _ in range(count):
            stack = stack[1]
        stack = (GOTO[stack[0], symbol], stack)
    return stack


def _offer(tops: Frontier, cost: int, audit: str, stack: Stack | None) -> bool:
    """Merge a stack into the tops; True if it is now the best of its top."""
    if stack is None:
        return False
    was = tops.get(stack[0])
    if was is not None and was[:2] <= (cost, audit):
        return False
    tops[stack[0]] = (cost, audit, stack)
    return True


def _with_inserts(tops: Frontier) -> Frontier:
    todo = list(tops)
    while todo:
        cost, audit, stack = tops[todo.pop()]
        for symbol in ROLES:
            after = _shift(stack, symbol)
            if _offer(tops, cost + INSERT, audit + "I", after):
                todo.append(after[0])
    return tops


def _read(tops: Frontier, code: str, copies: int) -> Frontier:
    """The tops after a line: ``code`` is a role initial and a fault; equal lines after the first go."""
    initial, fault = code
    after: Frontier = {}
    extra = SHORTENED if fault == "t" else 0
    for cost, audit, stack in tops.values():
        _offer(after, cost + DELETE, audit + "D", stack)
        if fault in "bd":
            continue
        _offer(after, cost + extra, audit + "K", _shift(stack, initial))
        for symbol in ROLES:
            _offer(after, cost + extra + REROLE, audit + "R", _shift(stack, symbol))
    if copies > 1:
        more = copies - 1
        after = {top: (cost + DELETE * more, audit + "D" * more, stack) for top, (cost, audit, stack) in after.items()}
    return _with_inserts(after)


@lru_cache(REMEMBERED)
def parse(entry: int, codes: tuple[str, ...], copies: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """The cheapest edits (cost, audit) of some lines from one top to each top that they can leave."""
    tops: Frontier = {entry: (0, "", STACKS[entry])}
    for code, n in zip(codes, copies, strict=True):
        tops = _read(tops, code, n)
    return {top: (cost, audit) for top, (cost, audit, _) in tops.items()}


def chain(pieces: list[tuple[tuple[str, ...], tuple[int, ...]]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation that is cut into pieces."""
    reached = {top: (cost, audit) for top, (cost, audit, _) in _with_inserts({0: (0, "", _BOTTOM)}).items()}
    for codes, copies in pieces:
        after: dict[int, tuple[int, str]] = {}
        for top, (cost, audit) in reached.items():
            for to, (more, edits) in parse(top, codes, copies).items():
                if to not in after or (cost + more, audit + edits) < after[to]:
                    after[to] = (cost + more, audit + edits)
        reached = after
    return min(reached[top] for top in ACCEPT if top in reached)


def edits_of_lines(audit: str, codes: list[str], copies: list[int]) -> list[str]:
    """What becomes of each line: K kept, u or a kept with that role, D deleted, U or A a turn of that
    role inserted; turns inserted before the first line are at its start."""
    out, at, stack = [], 0, _BOTTOM

    def inserted() -> str:
        nonlocal at, stack
        made = ""
        while at < len(audit) and audit[at] == "I":
            symbol = next(s for s in ROLES if _shift(stack, s))
            stack, at, made = _shift(stack, symbol), at + 1, made + symbol.upper()
        return made

    made = inserted()
    for code, n in zip(codes, copies, strict=True):
        action = audit[at]
        if action == "K":
            stack = _shift(stack, code[0])
        elif action == "R":
            action = next(s for s in ROLES if _shift(stack, s))
            stack = _shift(stack, action)
        at += n
        out.append(made + action + inserted())
        made = ""
    return out


# --- lines -------------------------------------------------------------------------------------


def _lines(turns: DataFrame) -> DataFrame:
    """Distinct rows of each conversation in order, with their number (``place``), code and copies."""
    rows = (
        turns.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
        .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("said", F.xxhash64("role", "text"))
    )
    # Only what is said in more than one turn of a conversation is looked up.
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (
        rows.groupBy(F.col("conv_id").alias("of"), F.col("said").alias("what"))
        .agg(F.count(F.lit(1)).alias("times"), F.min(when).alias("first")).where("times > 1").select("of", "what", "first")
    )
    initial = F.left("role", F.lit(1))
    text = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(text == "", "b")
        .when(F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn")), "d")
        .when(~F.right(text, F.lit(1)).isin(*ENDS), "t").otherwise("-")
    )
    coded = rows.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what")), "left").select(
        "conv_id", "turn", "role", "text", "copies",
        F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"), fault).alias("code"),
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("conv_id", "turn", "role", "text")
    return materialize(
        coded.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "repair-lines",
    )


def _chained(pieces: pa.Array) -> pa.Array:
    """Edits, gaps and illegal neighbours of conversations, each a list of pieces in order."""
    out = []
    for conversation in pieces.to_pylist():
        codes = [tuple(x["code"] for x in p["lines"]) for p in conversation]
        copies = [tuple(x["copies"] for x in p["lines"]) for p in conversation]
        cost, audit = chain(list(zip(codes, copies, strict=True)))
        flat, times = [c for p in codes for c in p], [n for p in copies for n in p]
        illegal = sum(times) - len(times) + sum(  # equal lines never may follow each other
            a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(flat, flat[1:], strict=False)
        )
        known = [(p["low"], p["high"], p["turns"]) for p in conversation if p["low"] is not None]
        gaps = 0
        if known:
            shared = sum(a[1] == b[0] for a, b in zip(known, known[1:], strict=False))  # a turn over two pieces
            gaps = known[-1][1] - known[0][0] + 1 - (sum(k[2] for k in known) - shared)
        places = [x["place"] for p in conversation for x in p["lines"]]
        edits = [{"place": p, "edit": e} for p, e in zip(places, edits_of_lines(audit, flat, times), strict=True)]
        out.append({"gaps": gaps, "illegal": illegal, "cost": cost, "audit": audit, "edits": edits})
    return pa.array(out, pa.struct([
        ("gaps", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
        ("edits", pa.list_(pa.struct([("place", pa.int64()), ("edit", pa.string())]))),
    ]))


def _count(fault: str) -> Column:
    """Rows of a piece with a fault; equal lines after the first are duplicates, or blank too."""
    ends = F.col("code").endswith(fault)
    if fault == "b":
        return F.sum(F.when(ends, F.col("copies")).otherwise(0))
    if fault == "d":
        return F.sum(F.when(ends, F.col("copies")).when(F.col("code").endswith("b"), 0).otherwise(F.col("copies") - 1))
    return F.sum(ends.cast("long"))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired, report) of ``turns`` (conv_id, turn, role, text; other columns are not read).

    ``repaired`` has a row per turn of the mended conversations: conv_id, place and step (their order),
    role, text and action (K, R or I). ``report`` has a row per conversation with a row: conv_id, gaps
    (turn numbers missing between its first and last), blank, duplicate, truncated (rows by their first
    fault), illegal (neighbours whose roles may not follow each other), cost and audit (the cheapest
    edits, Keep, Rerole, Delete or Insert, in order; of equally cheap ones the least as text).

    Rows are ordered by turn (null first), then role, then text. A null role or text is one space, a text
    of white space is blank; blank and repeated rows are always deleted. Rows with a null conv_id are one
    conversation. A table without rows gives none.
    """
    lines = _lines(turns)
    listed = F.array_sort(F.collect_list(F.struct("place", "code", "copies"))).alias("lines")
    pieces = lines.groupBy("conv_id", F.shiftright("place", PIECE_BITS).alias("piece")).agg(
        listed, F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"),
        *(_count(fault).alias(name) for name, fault in (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))),
    )
    chained = F.arrow_udf(
        _chained, "struct<gaps:long,illegal:long,cost:long,audit:string,edits:array<struct<place:long,edit:string>>>"
    )
    solved = materialize(
        pieces.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("piece", "lines", "low", "high", "turns"))).alias("pieces"),
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        )
        .select("conv_id", "blank", "duplicate", "truncated", chained("pieces").alias("s")),
        "repair-solved",
    )
    report = solved.select("conv_id", "s.gaps", "blank", "duplicate", "truncated", "s.illegal", "s.cost", "s.audit")
    edits = solved.select(F.explode("s.edits").alias("e")).select("e.place", "e.edit").where("edit != 'D'")
    step = F.col("what")
    kept = ~step.isin("U", "A")
    named = F.when(F.lower(step) == "u", "user").when(F.lower(step) == "a", "assistant").otherwise(F.col("role"))
    repaired = (
        lines.join(edits, "place")
        .select("conv_id", "place", "role", "text", F.posexplode(F.split("edit", "")).alias("step", "what"))
        .where("what NOT IN ('D', '')")
        .select(
            "conv_id", "place", "step", named.alias("role"), F.when(kept, F.col("text")).otherwise("").alias("text"),
            F.when(step == "K", "K").when(kept, "R").otherwise("I").alias("action"),
        )
    )
    return repaired, report


# --- damage and digests ------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the faults that crc32 of ``conv_id:turn`` modulo 20 names: 0
    drops the row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's.
    A null counts as one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    rows = turns.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), fault.alias("fault"))
    return rows.where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hex digest of a conversation's ``role:text``, joined by newlines.

    Such a digest is made in order, so one task reads all of a conversation, row after row.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, None
        for batch in batches:
            done = []
            for conv_id, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = line.as_py().encode("utf-8", "surrogatepass")
                if running is None or conv_id != current:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = conv_id, hashlib.sha256(raw)
                else:
                    running.update(b"\n" + raw)
            yield _rows(done, schema)
        if running is not None:
            yield _rows([(current, running.hexdigest())], schema)

    parts = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = repaired.select(F.col("conv_id").cast("long"), "place", "step", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "place", "step")
    return ordered.select("conv_id", "line").mapInArrow(digested, "conv_id long, repaired_sha256 string")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """The report of every conversation of ``turns`` after its damage, with the digest of its repaired form.

    One that lost all its rows, or is repaired to none, has zeros where nothing was counted, and the digest
    of an empty text.
    """
    repaired, report = repair(damage(turns))
    known = turns.select("conv_id").distinct()
    for other in (report, digests(repaired)):
        other = other.withColumnRenamed("conv_id", "of")
        known = known.join(other, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return known.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
