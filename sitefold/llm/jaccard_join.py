"""Exact n-gram Jaccard join, reported as connected components, by set-relation skipping.

Each text is the set of its distinct word 5-grams. Two sets link when their Jaccard similarity
reaches the threshold. The exact join runs over an inverted index of prefixes: in one global order of
the grams, rarest first, linked sets share a gram among their first few. Two kinds of skipping keep
lists with many entries cheap:

* Lists are cut into blocks by set size and position. Blocks that can't hold a linked pair, by the
  sizes and positions at their ends, are skipped against each other as a whole.
* Similar sets gather around a head, the most central of them, and get their answers from the head's.
  What two sets of one head share is what the head has, less what each lacks, plus what they agree in of
  their differences to the head; so it is computed from these differences alone. What a set shares with
  one outside is at most what the heads share, plus the grams each has beyond its head; so heads are
  compared, and members of different heads only where this leaves a link open. Sets that are known to be in
  one component are not compared.

Heads, and members that bounds leave open, are first held against each other by the grams that their
prefixes share: beyond their prefixes linked sets can't have more in common than what is left of either.

Identities are 64-bit hashes of grams and of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.llm.common import MIX_1, mix, utf8, windows
from sitefold.session import materialize, release

#: Words of a gram, and the similarity (percent) at which sets link.
WORDS, PERCENT = 5, 80
#: Grams whose unsigned hash is below this come first in the global order, by how many sets have them.
EARLY = 1 << 63  # half of all grams: rare ones fill a prefix, a fifth, unless 3/5 of a set are in frequent passages
#: Counts are told apart up to this; more frequent grams are alike, and come last among the early.
COUNT_CAP = 64
#: Grams that a task gathers before it passes them on; within them a gram is counted up to the cap.
GATHER = 1 << 18
#: Similarity (percent) from which a set may get its answers from a head's.
FAMILY = 50
#: Partners with which a member of a family is compared before all pairs that are left.
PARTNERS = 16
#: Slots of the filter that spares texts outside the join a shuffle: a table of fixed size.
FILTER_WORDS = 1 << 18


# --- sets --------------------------------------------------------------------------------------


#: Bytes of a word that are hashed by place; longer words are hashed by themselves.
LONG = 64
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 20
_CODES = np.arange(256)
_SOLID = (_CODES != 0x20) & ((_CODES < 0x09) | (_CODES > 0x0D))
_LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 32, _CODES)
#: A number for each byte (capitals as small letters, nothing for blanks) and for each place in a word.
_LETTER = np.where(_SOLID, mix(mix((_LOWER + 1).astype(np.uint64) * MIX_1) * MIX_1), np.uint64(0))
_PLACE = mix(mix((np.arange(LONG) + 1001).astype(np.uint64) * MIX_1) * MIX_1) | np.uint64(1)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z taken as a-z: the sum of byte number times place number."""
    codes = np.frombuffer(raw, np.uint8)
    if not len(codes):
        return np.empty(0, np.uint64)
    solid = _SOLID[codes]
    turns = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    edges = np.concatenate(([0] if solid[0] else [], turns, [len(codes)] if solid[-1] else [])).astype(np.int64)
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(codes) + PIECE, PIECE))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low == high:
            continue
        first, last = starts[low], min(ends[high - 1], starts[high - 1] + LONG)
        at = starts[low:high] - first
        place = np.arange(last - first) - np.repeat(at, np.diff(np.append(at, last - first)))
        out[low:high] = np.add.reduceat(_LETTER[codes[first:last]] * _PLACE[np.minimum(place, LONG - 1)], at)
    out = mix(out + (ends - starts).astype(np.uint64) * MIX_1)
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : ends[k]].lower())
    return out


def gram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct gram hashes; of fewer words one hash of all; of no words none."""
    raw = utf8(text)
    hashes = word_hashes(raw)
    if not len(hashes):
        return hashes
    if len(hashes) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(raw.lower().split()), 1)], np.uint64)
    grams = np.sort(windows(hashes, words))
    return grams[np.concatenate(([True], grams[1:] != grams[:-1]))]


def set_id(grams: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes()))))


def _describe(texts: pa.Array) -> pa.Array:
    sizes, early, ids = [], [], []
    for text in texts:
        grams = gram_set(text.as_py())
        sizes.append(len(grams))
        early.append(int(np.searchsorted(grams, np.uint64(EARLY))))
        ids.append(set_id(grams) if len(grams) else None)
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(early, pa.int64()), pa.array(ids, pa.int64())], ["n", "early", "sid"]
    )


def _sets(texts: pa.Array) -> pa.Array:
    sets = [gram_set(text.as_py()) for text in texts]
    ids = pa.array([set_id(grams) if len(grams) else None for grams in sets], pa.int64())
    return pa.StructArray.from_arrays([ids, pa.array([grams.tobytes() for grams in sets], pa.binary())], ["sid", "grams"])


def _held(grams: pa.Scalar) -> np.ndarray:
    """A set from its stored bytes."""
    return np.frombuffer(grams.as_py(), np.uint64)


def _spare(n: np.ndarray | int) -> np.ndarray | int:
    """Grams of a set of ``n`` that a linked set may lack."""
    return n - (PERCENT * n + 99) // 100


def _spare_column(n: Column) -> Column:
    return n - F.floor((PERCENT * n + 99) / 100)


def _need(total: Column) -> Column:
    """Least overlap of linked sets whose sizes add up to ``total``."""
    return F.ceil(PERCENT * total / (100 + PERCENT))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, sid, salt) of the early grams of each set, or of its first grams if these are too few.

    Equal sets gathered together are passed on once. Of a gram that more than ``COUNT_CAP`` of the
    gathered sets have, the rest gets a salt of its own: those rows need no counting, and a gram that
    all sets have stays a bounded share of any task's rows.
    """

    def pass_on(parts: list[np.ndarray], ids: list[int]) -> pa.RecordBatch:
        grams = np.concatenate(parts)
        sids = np.repeat(np.array(ids, np.int64), [len(p) for p in parts])
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        place = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
        sids = sids[order]
        salt = np.where(place < COUNT_CAP, 0, sids | 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(ranked.view(np.int64)), pa.array(sids), pa.array(salt)], ["gram", "sid", "salt"]
        )

    parts, ids, seen, count = [], [], set(), 0
    for batch in batches:
        for text in batch.column(0):
            grams = gram_set(text.as_py())
            if not len(grams):
                continue
            sid = set_id(grams)
            if sid in seen:
                continue
            seen.add(sid)
            early = int(np.searchsorted(grams, np.uint64(EARLY)))
            part = grams[: max(early, _spare(len(grams)) + 1)]
            parts.append(part)
            ids.append(sid)
            count += len(part)
            if count >= GATHER:
                yield pass_on(parts, ids)
                parts, ids, seen, count = [], [], set(), 0
    if parts:
        yield pass_on(parts, ids)


# --- the index ---------------------------------------------------------------------------------


def _prefixes(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The index: (gram, sid, n, lone, pos) for the grams of each set's prefix that another set has too.

    Prefixes are taken in the order (early grams by count, then the others by hash). Grams that only
    one set has come first; they are not stored, but they use up the prefix, so a set with enough of
    them is out.
    """
    counted = Window.partitionBy("gram", "salt")
    shared = (
        texts.mapInArrow(_postings, "gram long, sid long, salt long")
        .select(
            "gram", "sid", "salt", F.count(F.lit(1)).over(counted).alias("c"),
            F.min("sid").over(counted).alias("a"), F.max("sid").over(counted).alias("b"),
        )
        .where("salt != 0 OR a != b")
        .select("gram", "sid", F.when(F.col("salt") != 0, COUNT_CAP).otherwise(F.least("c", F.lit(COUNT_CAP))).alias("c"))
    )
    sign = -(1 << 63)  # hashes are compared without sign
    is_early = F.col("gram").bitwiseXOR(F.lit(sign)) < F.lit(EARLY + sign)
    by_set = Window.partitionBy("sid")
    ranked = Window.partitionBy("sid", "is_early").orderBy("c", "gram")
    with_rank = (
        shared.join(classes.select("sid", "n", "early"), "sid")
        .groupBy("sid", "gram")
        .agg(F.max("c").alias("c"), F.first("n").alias("n"), F.first("early").alias("early"))
        .withColumn("is_early", is_early)
        .withColumn("lone", F.col("early") - F.sum(F.col("is_early").cast("long")).over(by_set))
        .withColumn("at", F.row_number().over(ranked))
    )
    room = _spare_column(F.col("n")) + 1 - F.col("lone")
    return with_rank.where(~F.col("is_early") | (F.col("at") <= room)).select(
        "gram", "sid", "n", "lone",
        F.when(F.col("is_early"), F.col("lone") + F.col("at") - 1).otherwise(F.col("early")).cast("long").alias("pos"),
    )


def _sizes_fit(small: Column, large: Column) -> Column:
    return 100 * small >= PERCENT * large


# --- verification ------------------------------------------------------------------------------


def _overlaps(left: pa.Array, right: pa.Array) -> pa.Array:
    """Overlap and sizes of two sets and, where they are a family, the grams that only one of them has."""
    out, apart = [], []
    for a, b in zip(map(_held, left), map(_held, right), strict=True):
        both = len(np.intersect1d(a, b, assume_unique=True))
        out.append((both, len(a), len(b)))
        family = 100 * both >= FAMILY * (len(a) + len(b) - both)
        apart.append(np.setxor1d(a, b, assume_unique=True).view(np.int64) if family else None)
    columns = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))]
    return pa.StructArray.from_arrays([*columns, pa.array(apart, pa.list_(pa.int64()))], ["both", "na", "nb", "apart"])


def _verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with their exact overlap ``both``, their sizes, and the grams ``apart`` that
    only one of them has, where the two are a family."""
    overlap = F.arrow_udf(_overlaps, "struct<both:long,na:long,nb:long,apart:array<long>>")
    return (
        pairs.join(held.select(F.col("sid").alias("a"), F.col("grams").alias("grams_a")), "a")
        .join(held.select(F.col("sid").alias("b"), F.col("grams").alias("grams_b")), "b")
        .select("a", "b", overlap("grams_a", "grams_b").alias("o"))
        .select("a", "b", "o.both", "o.na", "o.nb", "o.apart")
    )


def _is_link() -> Column:
    return 100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both"))


def _sets_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(sid, grams) of the needed sets (sid, doc_id of a row that has it; null if only rows without an
    id do). A filter of fixed size drops most other texts before they are split; where it is full, it lets
    them pass and the join alone decides."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS * 64))
    bits = (
        needed.select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))  # FILTER_WORDS rows at most
    )
    # Declared so that no condition on what it returns is moved below the filter, where all texts would be split.
    split = F.arrow_udf(_sets, "struct<sid:long,grams:binary>").asNondeterministic()
    likely = (
        docs.withColumns({"word": F.shiftright(slot, 6), "bit": (slot % 64).cast("int")})
        .join(F.broadcast(bits), "word")
        .where(F.getbit("bits", "bit") == 1)
        .select("doc_id", split("text").alias("s"))
        .select("doc_id", "s.sid", "s.grams")
    )
    # An id that is repeated with other texts has several sets, and so has the null id.
    wanted = needed.select("sid", F.col("doc_id").alias("holder"))
    return (
        likely.join(wanted, "sid").where(F.col("doc_id").eqNullSafe(F.col("holder")))
        .dropDuplicates(["sid"])
        .select("sid", "grams")
    )


def _shared_front(pairs: DataFrame, fronts: DataFrame, a: str, b: str, n_a: Column, n_b: Column) -> DataFrame:
    """``pairs`` with ``bound``: the most grams that the sets ``a`` and ``b`` can have in common.

    In the one order of all grams, the prefix that ends first lies within the other's: what both have of it
    is among the grams that the prefixes share, and the rest of that set can't be more than what its prefix
    leaves, which is its size less the grams it may lack and one.
    """
    left = fronts.select(F.col("sid").alias(a), F.col("front").alias("front_a"))
    right = fronts.select(F.col("sid").alias(b), F.col("front").alias("front_b"))
    rest = F.greatest(n_a - _spare_column(n_a), n_b - _spare_column(n_b)) - 1
    shared = F.coalesce(F.size(F.array_intersect("front_a", "front_b")), F.lit(0))
    return pairs.join(left, a, "left").join(right, b, "left").withColumn("bound", shared + rest).drop("front_a", "front_b")


# --- components --------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the graph with edges (a, b): the smallest node each node can reach.

    Alternating star contraction. Each round is written to the shared folder; a node with very many
    neighbours is split by the joins, as its smallest neighbour is found by aggregation first.
    """

    def larger(edges: DataFrame) -> DataFrame:
        """Each node's larger neighbours move to its smallest one."""
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def smaller(edges: DataFrame) -> DataFrame:
        """Each node and its smaller neighbours move to the smallest of them."""
        smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(smallest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()

    def forest(edges: DataFrame) -> bool:
        """All edges point from a node that has one edge to a node that has none of its own."""
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("out")),
                                              F.struct(F.col("b").alias("node"), F.lit(0).alias("out")))).alias("e"))
        seen = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.count(F.lit(1)).alias("all"))
        return seen.where("out > 1 OR (out = 1 AND all > 1)").isEmpty()

    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while not forest(edges):
        # Written half by half: a plan that reads a step several times holds all of its joins as often.
        moved = materialize(larger(edges).where("a != b"), "components-larger")
        edges = materialize(smaller(moved), "components")
        # A node's edge to itself tells nothing: it is its own component or has another edge.
        edges = edges.where("a != b")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
    return materialize(stars, "components-found")


def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further (written) links: ``groups`` are stars already, so few rounds are left."""
    if links.isEmpty():
        return groups
    return components(links.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))


# --- the join ----------------------------------------------------------------------------------


def _near(index: DataFrame) -> DataFrame:
    """A pair (a, b) for each set: b is the most central set (fewest lone grams, then largest) of the
    lists that a is in, the one a shares most lists with."""
    central = F.struct("lone", (-F.col("n")).alias("minus"), F.col("sid").alias("head"))
    firsts = index.groupBy("gram").agg(F.min(central).alias("f")).select(
        "gram", "f.head", (-F.col("f.minus")).alias("m")
    )
    return (
        index.join(firsts, "gram")
        .where((F.col("sid") != F.col("head")) & _sizes_fit(F.col("n"), F.col("m")) & _sizes_fit(F.col("m"), F.col("n")))
        .groupBy("sid", "head")
        .agg(F.count(F.lit(1)).alias("lists"))
        .groupBy("sid")
        .agg(F.max_by("head", F.struct("lists", "head")).alias("head"))
        .select(F.col("sid").alias("a"), F.col("head").alias("b"))
    )


def _is_family() -> Column:
    return F.col("apart").isNotNull()


def _gather(index: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets around heads: (compared pairs, members). ``members`` has sid, head, n, n_head, share (grams that
    both have) and apart (grams that only one of them has) for each set whose head is another."""
    near = materialize(_verified(_near(index), held), "gram-near")
    families = components(near.where(_is_family()).select("a", "b"))
    sets = index.select("sid", "n", "lone").distinct()
    central = F.struct("lone", (-F.col("n")).alias("minus"), F.col("sid").alias("head"))
    roots = families.join(sets.withColumnRenamed("sid", "node"), "node").withColumnRenamed("node", "sid")
    heads = roots.groupBy("component").agg(F.min(central)["head"].alias("head"))
    wanted = (
        families.join(heads, "component").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    )
    again = materialize(_verified(wanted.join(near.select("a", "b"), ["a", "b"], "left_anti"), held), "gram-again")
    members = (
        wanted.join(near.unionByName(again), ["a", "b"])
        .where(_is_family())
        .select(F.col("a").alias("sid"), F.col("b").alias("head"), F.col("na").alias("n"), F.col("nb").alias("n_head"),
                F.col("both").alias("share"), "apart")
    )
    return near.unionByName(again).select("a", "b", "both", "na", "nb"), materialize(members, "gram-members")


def _with_families(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Components after all links between members of one head, from what tells each member from the head.

    Let a and b lack L_a and L_b grams of the head h, have B_a and B_b grams beyond it, and agree in o of
    these differences (both lack the gram, or both have it). Then |a and b| = |h| - L_a - L_b + o. With
    cost = 100 * L + P * B for P = PERCENT, they link when

        (100 + P) * o >= cost_a + cost_b - (100 - P) * |h|

    and the head itself is a member of cost 0. So members are joined by their differences, which are few
    where sets are alike, and not by their grams. Where the right side is not positive, both link to
    the head. Elsewhere they agree in as many differences as the right side asks for: one of them is among the
    rarest of either, in the order of how many members of the head have it. How many of the rarest depends
    on the other's cost, so each member offers them once for each band of costs that its family has.
    """
    lacks, beyond = F.col("n_head") - F.col("share"), F.col("n") - F.col("share")
    placed = (
        members.join(groups.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .select(
            "sid", "head", F.coalesce("component", "sid").alias("component"), "apart", ((100 - PERCENT) * F.col("n_head")).alias("free"),
            (100 * lacks + PERCENT * beyond).alias("cost"),
        )
        .withColumn("width", F.greatest(F.lit(100 + PERCENT), F.floor(F.col("free") / 8)))
        .withColumn("band", F.floor(F.col("cost") / F.col("width")))
    )
    families = placed.groupBy("head").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.collect_set("band").alias("bands"),
    ).where("x != y").select("head", "bands")
    mixed = materialize(placed.join(families, "head"), "gram-families")
    if mixed.isEmpty():
        return groups

    # Differences in the order of how many members have them; only those that several have can be shared.
    each = mixed.select("head", "sid", F.explode("apart").alias("gram"))
    shared = each.groupBy("head", "gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    of_set = Window.partitionBy("sid")
    ranked = (
        each.join(shared, ["head", "gram"])
        # Differences of one member only come first, so this many are left from this one on.
        .withColumn("left", F.count(F.lit(1)).over(of_set) + 1 - F.row_number().over(of_set.orderBy("times", "gram")))
        .select("sid", "gram", "left")
    )
    asked = F.greatest(F.lit(1), F.ceil((F.col("cost") + F.col("other") * F.col("width") - F.col("free")) / (100 + PERCENT)))
    offered = materialize(
        ranked.join(mixed.drop("apart"), "sid")
        .withColumn("other", F.explode("bands"))
        .where(F.col("left") >= asked)
        .select("head", "gram", "sid", "component", "cost", "free", "band", "other", "left"),
        "gram-offers",
    )
    release(members.sparkSession)
    told = lambda s: mixed.select(
        F.col("sid").alias(s), F.col("apart").alias(f"apart_{s}"), F.col("cost").alias(f"cost_{s}"), F.col("free").alias(f"free_{s}")
    )
    agree = F.size(F.array_intersect("apart_a", "apart_b"))

    def linked(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(told("a"), "a").join(told("b"), "b")
            .where((100 + PERCENT) * agree >= F.col("cost_a") + F.col("cost_b") - F.col("free_a"))
            .select("a", "b")
        )

    # First a few partners for each set, a random one of each of some lists: where many sets of a family
    # link, this leaves few components.
    listed = offered.withColumns({"low": F.least("band", "other"), "high": F.greatest("band", "other")})
    key = ["head", "gram", "low", "high"]
    drawn = listed.groupBy(*key).agg(F.min_by(F.struct("sid", "component"), F.xxhash64("gram", "sid")).alias("p"))
    by_chance = Window.partitionBy("sid").orderBy(F.xxhash64("sid", "partner"))
    few = (
        listed.join(drawn, key).where(F.col("component") != F.col("p.component"))
        .select("sid", F.col("p.sid").alias("partner")).distinct()
        .withColumn("k", F.row_number().over(by_chance)).where(F.col("k") <= PARTNERS)
        .select(F.col("sid").alias("a"), F.col("partner").alias("b"))
    )
    groups = joined(groups, materialize(linked(few), "gram-partners"))
    release(members.sparkSession)

    # Then all pairs that are still in different components.
    moved = materialize(
        listed.drop("component").join(groups.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .withColumn("component", F.coalesce("component", "sid")),
        "gram-moved",
    )
    lists = moved.groupBy(*key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select(*key)
    side = lambda s: moved.select(*key, "free", "band", *(F.col(c).alias(f"{c}_{s}") for c in ("sid", "component", "cost", "left")))
    pairs = (
        side("a").where("band = low").drop("band").join(lists, key)
        .join(side("b").where("(low = high) OR (band = high)").drop("free", "band"), key)
        .where(
            (F.col("component_a") != F.col("component_b"))
            & ((F.col("low") != F.col("high")) | (F.col("sid_a") < F.col("sid_b")))
            & ((100 + PERCENT) * F.least("left_a", "left_b") >= F.col("cost_a") + F.col("cost_b") - F.col("free"))
        )
        .select(F.greatest("sid_a", "sid_b").alias("a"), F.least("sid_a", "sid_b").alias("b"))
        .distinct()
    )
    return joined(groups, materialize(linked(pairs), "gram-inside"))


def _block_pairs(lists: DataFrame) -> DataFrame:
    """Blocks of one list that may hold a linked pair, by the sizes and positions at their ends."""
    blocks = lists.groupBy("gram", "block").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("pos").alias("pos"),
        F.min("c0").alias("c0"), F.max("c1").alias("c1"),
    )
    left, right = (
        blocks.select("gram", *(F.col(c).alias(f"{c}_{side}") for c in ("block", "low", "high", "pos", "c0", "c1")))
        for side in "ab"
    )
    return left.join(right, "gram").where(
        (F.col("block_a") <= F.col("block_b")) & _may_link("a", "b") & _not_one("a", "b")
    ).select("gram", "block_a", "block_b")


def _not_one(a: str, b: str) -> Column:
    """Not all members of both are in one component (the smallest and largest are known)."""
    return F.least(f"c0_{a}", f"c0_{b}") != F.greatest(f"c1_{a}", f"c1_{b}")


def _may_link(a: str, b: str) -> Column:
    """Sizes in [low, high] fit, and the first shared gram can lie at ``pos`` or later in both."""
    low_a, high_a, low_b, high_b = (F.col(f"{c}_{s}") for s in (a, b) for c in ("low", "high"))
    apart = F.col(f"pos_{a}") + F.col(f"pos_{b}")  # grams before the first shared one
    return (
        _sizes_fit(high_a, low_b) & _sizes_fit(high_b, low_a)
        & ((100 + PERCENT) * apart <= (100 - PERCENT) * (high_a + high_b))
    )


def _head_pairs(lists: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of heads that meet in a list, whose members may link and aren't known to
    be in one component."""
    blocks = _block_pairs(lists)
    columns = ("head", "c0", "c1", "low", "high", "pos")
    left, right = (
        lists.select("gram", *(F.col(c).alias(f"{c}_{side}") for c in ("block", *columns))) for side in "ab"
    )
    met = (
        blocks.join(left, ["gram", "block_a"])
        .join(right, ["gram", "block_b"])
        .where(
            _may_link("a", "b") & _not_one("a", "b") & (F.col("head_a") != F.col("head_b"))
            & ((F.col("block_a") != F.col("block_b")) | (F.col("head_a") < F.col("head_b")))
        )
    )
    return met.select(
        F.greatest("head_a", "head_b").alias("a"), F.least("head_a", "head_b").alias("b")
    ).distinct()


def _between(
    undecided: DataFrame, open_rows: DataFrame, groups: DataFrame, fronts: DataFrame, held: DataFrame
) -> DataFrame:
    """Links (a, b) between sets of the ``undecided`` pairs of heads that are still in different components."""
    rows = (
        open_rows.drop("component")
        .join(groups.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .select("gram", "head", "sid", "n", "pos", "over", F.coalesce("component", "sid").alias("component"))
    )
    row = lambda s: rows.select(F.col("head").alias(s), "gram", *(F.col(c).alias(f"{c}_{s}") for c in ("sid", "n", "pos", "over", "component")))
    total = F.col("n_a") + F.col("n_b")
    met = (
        undecided.join(row("a"), "a")
        .where(F.col("both") + F.col("over_a") + F.col("over_b") >= _need(F.col("n_a") + F.col("least_b")))
        .drop("over_b")
        .join(row("b"), ["b", "gram"])
        .where(
            (F.col("component_a") != F.col("component_b"))
            & (F.col("both") + F.col("over_a") + F.col("over_b") >= _need(total))
            & _sizes_fit(F.col("n_a"), F.col("n_b")) & _sizes_fit(F.col("n_b"), F.col("n_a"))
            & (F.col("pos_a") + F.col("pos_b") <= total - 2 * _need(total))
            & ((F.col("sid_a") != F.col("a")) | (F.col("sid_b") != F.col("b")))
        )
        .select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"), "n_a", "n_b")
        .distinct()
    )
    open_pairs = materialize(met, "gram-open")
    likely = _shared_front(open_pairs, fronts, "a", "b", F.col("n_a"), F.col("n_b")).where(F.col("bound") >= _need(total))
    return materialize(_verified(likely.select("a", "b"), held).where(_is_link()).select("a", "b"), "gram-derived")


def link_components(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text; other columns are not read): doc_id, n_shingles, component_id.

    One row per row of ``docs``. component_id is the smallest doc_id that links reach. A null or empty
    text, or one without words, has no grams and links with nothing. Equal sets are one class and are
    compared once. Rows with a null id are linked like others; component_id is null where links reach no
    id. Rows that repeat an id count each with their own text. Without rows there is no result.
    """
    return _linked(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _linked(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n, sid, component (null without words) and component_id."""
    docs = docs.select("doc_id", "text")
    described = F.arrow_udf(_describe, "struct<n:long,early:long,sid:long>")
    sets = materialize(docs.select("doc_id", described("text").alias("s")).select("doc_id", "s.*"), "grams")
    classes = materialize(
        sets.where("sid IS NOT NULL").groupBy("sid").agg(
            F.first("n").alias("n"), F.first("early").alias("early"), F.min("doc_id").alias("doc_id")
        ),
        "gram-classes",
    )
    index = materialize(_prefixes(docs.select("text"), classes), "gram-prefixes")
    lists = index.groupBy("gram").agg(F.count(F.lit(1)).alias("entries")).where("entries > 1").select("gram")
    index = materialize(index.join(lists, "gram"), "gram-index")
    release(docs.sparkSession)
    needed = classes.join(index.select("sid").distinct(), "sid", "left_semi").select("sid", "doc_id")
    held = materialize(_sets_of(docs, needed), "gram-sets")
    fronts = materialize(index.groupBy("sid").agg(F.collect_list("gram").alias("front")), "gram-fronts")
    release(docs.sparkSession)

    tried, members = _gather(index, held)
    release(docs.sparkSession)
    groups = components(tried.where(_is_link()).select("a", "b"))
    groups = _with_families(members, groups)
    release(docs.sparkSession)
    placed = materialize(
        index.join(members.select("sid", F.col("head").alias("to"), (F.col("n") - F.col("share")).alias("over")), "sid", "left")
        .join(groups.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .select(
            "gram", "sid", "n", "pos", F.coalesce("to", "sid").alias("head"), F.coalesce("over", F.lit(0)).alias("over"),
            F.coalesce("component", "sid").alias("component"),
        ),
        "gram-placed",
    )
    mixed = placed.groupBy("gram").agg(F.min("head").alias("x"), F.max("head").alias("y")).where("x != y")
    open_rows = placed.join(mixed.select("gram"), "gram")
    by_head = open_rows.groupBy("gram", "head").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos"),
        F.min("component").alias("c0"), F.max("component").alias("c1"),
    )
    block = F.floor(F.log(F.col("high").cast("double")) / F.log(F.lit(100 / PERCENT))) * 8 + F.floor(
        8 * F.col("pos") / (_spare_column(F.col("high")) + 1)
    )
    by_head = materialize(by_head.withColumn("block", block.cast("long")), "gram-lists")
    spans = materialize(
        placed.groupBy("head").agg(
            F.min("n").alias("least"), F.max("over").alias("over"), F.max(F.when(F.col("sid") == F.col("head"), F.col("n"))).alias("size")
        ),
        "gram-spans",
    )
    release(docs.sparkSession)
    side = lambda s: spans.select(F.col("head").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("least", "over", "size")))
    asked = _need(F.col("least_a") + F.col("least_b")) - F.col("over_a") - F.col("over_b")
    # Heads whose prefixes share too little for any link of theirs or of their members are not compared.
    pairs = materialize(
        _shared_front(_head_pairs(by_head).join(side("a"), "a").join(side("b"), "b"), fronts, "a", "b", F.col("size_a"), F.col("size_b"))
        .where(F.col("bound") >= asked).select("a", "b"),
        "gram-pairs",
    )
    before = tried.select("a", "b").unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    new = _verified(pairs.join(before, ["a", "b"], "left_anti"), held).drop("apart")
    known = tried.unionByName(
        tried.select(F.col("b").alias("a"), F.col("a").alias("b"), "both", F.col("nb").alias("na"), F.col("na").alias("nb"))
    ).join(pairs, ["a", "b"], "left_semi").dropDuplicates(["a", "b"])
    compared = materialize(new.unionByName(known), "gram-compared")
    release(docs.sparkSession)

    # Members of different heads: only where the bounds leave it open.
    groups = joined(groups, compared.where(_is_link()).select("a", "b"))
    undecided = materialize(
        compared.join(side("a"), "a").join(side("b"), "b").where(F.col("both") >= asked)
        .select("a", "b", "both", "over_b", "least_b"),
        "gram-undecided",
    )
    release(docs.sparkSession)
    reached = groups if undecided.isEmpty() else joined(groups, _between(undecided, open_rows, groups, fronts, held))

    named = classes.join(reached.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "doc_id", F.coalesce("component", "sid").alias("component")
    )
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(least, "component").select("sid", "component", "component_id")
    return sets.join(of_set, "sid", "left").select(
        "doc_id", "n", "sid", "component",
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one row of each component: the one with the smallest doc_id.

    Columns stay as they are. Rows are told apart by id and text: of rows that repeat the smallest id
    the one with the smallest set hash stays, and a null id comes after all others. Documents without
    words all stay, but rows that repeat an id and its text are one document.
    """
    found = materialize(_linked(docs), "gram-components")
    release(docs.sparkSession)
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = materialize(again, "gram-again")
    # An id of one row: the id alone decides.
    gone = found.where("doc_id != component_id").select("doc_id").unionByName(again).distinct()
    kept = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").select(*docs.columns)
    parts = []
    if not again.isEmpty():
        parts.append(docs.join(again, "doc_id", "left_semi").select(*docs.columns))
    if not found.where("doc_id IS NULL").isEmpty():
        parts.append(docs.where("doc_id IS NULL"))
    if not parts:
        return kept
    # Otherwise id and set decide.
    stay = (
        found.where(F.col("sid").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component", "doc_id").agg(F.min("sid").alias("sid"))
        .select(F.col("doc_id").alias("__doc_id"), F.col("sid").alias("__stay"))
    )
    described = F.arrow_udf(_describe, "struct<n:long,early:long,sid:long>")
    for part in parts:
        part = part.withColumn("__sid", described("text")["sid"])
        same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__sid") == F.col("__stay"))
        worded = part.where("__sid IS NOT NULL").dropDuplicates(["doc_id", "__sid"]).join(stay, same, "left_semi")
        bare = part.where("__sid IS NULL")
        once = bare.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
        for rows in (worded, once, bare.where("doc_id IS NULL")):
            kept = kept.unionByName(rows.select(*docs.columns))
    return kept
