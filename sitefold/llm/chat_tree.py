"""Chat formatting as a prefix tree: what conversations share at their start is emitted once.

Turns are nodes; two conversations share a node when all turns up to it are equal. Nodes are laid out
depth first. Each carries its place in that layout, the position its first character has within its
conversations, and the intervals of the layout that hold its ancestors, which is all it may attend to.

Depth-first order needs no walk: conversations are numbered in the order of their paths, a node
belongs to the first conversation that passes it, and the nodes of one conversation follow each other.
So a first turn that a third of all conversations share is one group of counters, not one task's tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.operators.keys import dense_row_number
from sitefold.session import materialize

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Role whose texts are trained on.
TRAINED_ROLE = "assistant"

_ROWS = "conv_id long, depth long, parent binary, node binary, role string, text string"
#: Conversations whose running sums are made in one group.
_BUCKET = 4096


# --- template ----------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    """No control string is left in the text; ``unescape`` gives it back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


# --- the tree ----------------------------------------------------------------------------------


def _with_nodes(turns: DataFrame) -> DataFrame:
    """Rows in turn order with depth and the keys of their node and its parent.

    A key is a hash of all turns so far, so a conversation is read as a stream, whatever its length.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent", pa.binary()), ("node", pa.binary()),
        ("role", pa.string()), ("text", pa.string()),
    ])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, depth, running, last = object(), 0, None, None
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if depth == 0 or conv != current:
                    current, depth, running, last = conv, 0, hashlib.blake2b(digest_size=16), b""
                for part in (role, text):
                    raw = part.encode("utf-8", "surrogatepass")
                    running.update(len(raw).to_bytes(8, "little") + raw)
                depth += 1
                node = running.digest()
                for column, value in zip(out, (conv, depth, last, node, role, text), strict=True):
                    column.append(value)
                last = node
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    rows = turns.select(
        F.col("conv_id").cast("long"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text").mapInArrow(keyed, _ROWS)


def build(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree of ``turns`` (conv_id, turn, role, text): (segments, conversations).

    ``segments`` has one row per node: tree (its first node), node, parent, depth, offset and length in
    the depth-first layout, position of its first character, attention (intervals [start, end) of its
    ancestors, neighbours merged), formatted text, start and end of the turn's text in it, and trained
    (whether that text is under the loss mask). ``conversations`` has conv_id, leaf and path (node keys).

    Rows are ordered by turn, then role, then text; repeated rows are turns of their own. Null roles and
    texts are empty; rows with a null conv_id form one conversation; a null turn comes first. Columns
    other than the four are not read. No rows give no segments and no conversations.
    """
    rows = materialize(_with_nodes(turns), "chat-rows")
    conversations = materialize(
        rows.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("turns"))
        .select(
            "conv_id",
            F.element_at("turns", -1)["node"].alias("leaf"),
            F.transform("turns", lambda t: t["node"]).alias("path"),
        ),
        "chat-conversations",
    )
    nodes = (
        rows.groupBy("node")
        .agg(*(F.first(c).alias(c) for c in ("parent", "depth", "role", "text")))
        .select(
            "node", "parent", "depth",
            F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body"),
            (F.col("role") == TRAINED_ROLE).alias("trained"),
        )
        .select(
            "node", "parent", "depth", "trained",
            F.concat("head", "body", F.lit(END + "\n")).alias("formatted"),
            F.length("head").cast("long").alias("text_start"),
            (F.length("head") + F.length("body")).cast("long").alias("text_end"),
        )
        .withColumn("length", F.length("formatted").cast("long"))
    )

    # The conversations' paths in order; a node is owned by the first path through it.
    paths = conversations.groupBy("leaf").agg(F.first("path").alias("path"))
    ranked = dense_row_number(paths.select("path"), ["path"], out="rank")
    passed = ranked.select("rank", F.posexplode("path").alias("at", "node"))
    owned = materialize(
        passed.groupBy("node").agg(F.min("rank").alias("owner")).join(nodes, "node"), "chat-nodes"
    )

    # Places: the owner's start, by sums over buckets of owners, then the owner's nodes in depth order.
    runs = owned.groupBy("owner").agg(F.sum("length").alias("run")).withColumn(
        "bucket", F.floor(F.col("owner") / _BUCKET)
    )
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.groupBy("bucket").agg(F.sum("run").alias("sum")).select(
        "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("bucket").orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        runs.withColumn("within", F.coalesce(F.sum("run").over(inside), F.lit(0)))
        .join(bases, "bucket")
        .select("owner", (F.col("base") + F.col("within")).alias("run_start"))
    )
    above = Window.partitionBy("owner").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(
        owned.join(starts, "owner").withColumn(
            "offset", F.col("run_start") + F.coalesce(F.sum("length").over(above), F.lit(0))
        ),
        "chat-placed",
    )

    # Ancestors that other paths own, once for each path; those of its own run lie before a node.
    shared = (
        passed.join(placed.select("node", "owner", "offset", "length"), "node")
        .where(F.col("owner") < F.col("rank"))
        .groupBy("rank")
        .agg(
            F.sum("length").alias("shared_length"),
            F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("pieces"),
            F.min_by("node", "at").alias("first_node"),
        )
        .select(F.col("rank").alias("owner"), "shared_length", "first_node", _merged("pieces").alias("outside"))
    )
    own_first = Window.partitionBy("owner").orderBy("depth")
    own_run = F.when(
        F.col("offset") > F.col("run_start"),
        F.array(F.struct(F.col("run_start").alias("start"), F.col("offset").alias("end"))),
    ).otherwise(F.array().cast("array<struct<start:long,end:long>>"))
    segments = placed.join(shared, "owner", "left").select(
        F.coalesce("first_node", F.first("node").over(own_first)).alias("tree"),
        "node", "parent", "depth", "offset", "length",
        (F.coalesce("shared_length", F.lit(0)) + F.col("offset") - F.col("run_start")).alias("position"),
        _merged(
            F.transform(
                F.concat(F.coalesce("outside", F.array().cast("array<struct<start:long,end:long>>")), own_run),
                lambda i: F.struct(i["start"].alias("offset"), (i["end"] - i["start"]).alias("length")),
            )
        ).alias("attention"),
        "formatted", "text_start", "text_end", "trained",
    )
    return materialize(segments, "chat-segments"), conversations


def _merged(pieces: Column | str) -> Column:
    """Sorted (offset, length) pieces as intervals [start, end), neighbours joined."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def add(done: Column, piece: Column) -> Column:
        end = piece["offset"] + piece["length"]
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] == piece["offset"])
        return F.when(
            touches,
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"), end.alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(piece["offset"].alias("start"), end.alias("end")))))

    column = F.col(pieces) if isinstance(pieces, str) else pieces
    return F.aggregate(column, empty, add)


# --- reading back ------------------------------------------------------------------------------


def read_back(segments: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation, from the emitted segments: formatted text, turns (role, text), trained texts."""
    leaves = conversations.groupBy("leaf").agg(F.first("path").alias("path"))
    steps = leaves.select("leaf", F.posexplode("path").alias("at", "node"))
    start, end = F.col("text_start"), F.col("text_end")
    parsed = segments.select(
        "node", "formatted", "trained",
        _unescape_role(
            F.substr("formatted", F.lit(len(START) + 1), (start - len(START) - 1).cast("int"))
        ).alias("role"),
        unescape(F.substr("formatted", (start + 1).cast("int"), (end - start).cast("int"))).alias("text"),
    )
    read = (
        steps.join(parsed, "node")
        .groupBy("leaf")
        .agg(F.array_sort(F.collect_list(F.struct("at", "formatted", "role", "text", "trained"))).alias("turns"))
    )
    return conversations.select("conv_id", "leaf").join(read, "leaf").select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.array_join(
            F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: t["text"]), ""
        ).alias("loss_text"),
    )


def digests(back: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
