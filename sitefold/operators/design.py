"""Finding fragments: a minimal set of predicates for a horizontal split, groups of columns for a vertical one.

Spark counts; what comes to the driver is one row per combination of predicates, or per set of columns,
that occurs. Their number depends on how many predicates and columns are asked about, not on the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Predicates and applications together; their combinations are what the driver may have to hold.
MOST_BITS = 20
#: Up to so many columns the best order is searched among all; beyond, columns are inserted one by one.
EXACT_COLUMNS = 7
MOST_COLUMNS = 200


# --- horizontal --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Minterm:
    """A fragment: which of the chosen predicates hold, its rows, and the rows each application reads."""

    holds: tuple[bool, ...]
    rows: int
    read: tuple[int, ...]


@dataclass(frozen=True)
class HorizontalDesign:
    """Chosen predicates (a complete and minimal set, in the given order) and the fragments that have rows."""

    names: tuple[str, ...]
    predicates: tuple[Column, ...]
    minterms: tuple[Minterm, ...]

    def label(self, minterm: Minterm) -> str:
        return " AND ".join(n if h else f"NOT {n}" for n, h in zip(self.names, minterm.holds, strict=True)) or "all"

    def fragments(self) -> dict[str, Column]:
        """A predicate for each fragment, for ``fragment_horizontal``, and one named ``rest`` for the
        combinations that no row had when the design was made. Together they are complete and disjoint
        on any data."""
        out = {}
        for m in self.minterms:
            terms = [p if h else ~p for p, h in zip(self.predicates, m.holds, strict=True)]
            out[self.label(m)] = reduce(Column.__and__, terms) if terms else F.lit(True)
        out["rest"] = ~reduce(Column.__or__, out.values()) if out else F.lit(True)
        return out


def _split(cells: dict, chosen: list[int]) -> dict[tuple[bool, ...], list[tuple]]:
    """Counted cells by the chosen predicates."""
    out: dict[tuple[bool, ...], list[tuple]] = {}
    for (holds, read), rows in cells.items():
        out.setdefault(tuple(holds[k] for k in chosen), []).append((holds, read, rows))
    return out


def _is_relevant(cells: dict, chosen: list[int], k: int, n_apps: int) -> bool:
    """Does predicate ``k`` cut a fragment of the chosen ones into parts that an application reads to
    different shares?"""
    for part in _split(cells, chosen).values():
        sides = [[c for c in part if c[0][k] is side] for side in (True, False)]
        sizes = [sum(c[2] for c in side) for side in sides]
        if not all(sizes):
            continue
        for app in range(n_apps):
            read = [sum(c[2] for c in side if c[1][app]) for side in sides]
            if read[0] * sizes[1] != read[1] * sizes[0]:
                return True
    return False


def minterm_design(
    df: DataFrame, predicates: dict[str, Column], applications: dict[str, Column]
) -> HorizontalDesign:
    """Primary horizontal fragments by the predicates that matter to the applications.

    ``predicates`` are simple predicates that might split ``df``, ``applications`` the rows that each
    application reads. A predicate is relevant beside others if it cuts one of their fragments into
    parts of which some application reads different shares. Relevant ones are taken in until no further
    is (the set is complete: an application reads any two rows of a fragment alike, as far as these
    predicates can tell), and those that the later ones made irrelevant are taken out again (it is minimal).

    One pass over ``df`` counts its rows for each combination of predicates and applications; the rest
    works on these counts. A predicate that is NULL does not hold. An empty table has no fragments.
    """
    if len(predicates) + len(applications) > MOST_BITS:
        raise ValueError(f"more than {MOST_BITS} predicates and applications")
    bit = lambda c: F.coalesce(c, F.lit(False))
    pred_names, app_names = list(predicates), list(applications)
    holds = F.array(*(bit(predicates[n]) for n in pred_names)) if pred_names else F.array().cast("array<boolean>")
    read = F.array(*(bit(applications[n]) for n in app_names)) if app_names else F.array().cast("array<boolean>")
    counted = df.select(holds.alias("holds"), read.alias("read")).groupBy("holds", "read").agg(F.count(F.lit(1)).alias("rows"))
    cells = {(tuple(r["holds"]), tuple(r["read"])): r["rows"] for r in counted.collect()}

    chosen: list[int] = []
    while (more := next((k for k in range(len(pred_names)) if k not in chosen and _is_relevant(cells, chosen, k, len(app_names))), None)) is not None:
        chosen.append(more)
    for k in list(chosen):
        others = [c for c in chosen if c != k]
        if not _is_relevant(cells, others, k, len(app_names)):
            chosen = others
    chosen.sort()
    minterms = [
        Minterm(key, sum(c[2] for c in part), tuple(sum(c[2] for c in part if c[1][a]) for a in range(len(app_names))))
        for key, part in _split(cells, chosen).items()
    ]
    return HorizontalDesign(
        tuple(pred_names[k] for k in chosen), tuple(bit(predicates[pred_names[k]]) for k in chosen),
        tuple(sorted(minterms, key=lambda m: m.holds, reverse=True)),
    )


def minterm_fragments(df: DataFrame, design: HorizontalDesign, out: str = "fragment") -> DataFrame:
    """``df`` with the name of each row's fragment; a row of no fragment is in ``rest``."""
    fragments = design.fragments()
    named = F.lit("rest")
    for name, predicate in fragments.items():
        if name != "rest":
            named = F.when(predicate, F.lit(name)).otherwise(named)
    return df.withColumn(out, named)


# --- vertical ----------------------------------------------------------------------------------


def usage_patterns(usage: DataFrame) -> DataFrame:
    """(columns, times) of ``usage`` (application, attribute, times): how often a set of attributes is read
    together. ``times`` is the application's frequency, the same on each of its rows; applications that
    read the same attributes are added up."""
    return (
        usage.groupBy("application").agg(F.array_sort(F.collect_set("attribute")).alias("columns"), F.max("times").alias("times"))
        .groupBy("columns").agg(F.sum("times").alias("times"))
    )


def affinity(patterns: DataFrame) -> DataFrame:
    """(a, b, together): how often two attributes are read by one application; a row per pair that ever is."""
    each = patterns.select("times", "columns", F.explode("columns").alias("a"))
    return each.select("times", "a", F.explode("columns").alias("b")).groupBy("a", "b").agg(F.sum("times").alias("together"))


def _bonds(columns: list[str], together: dict[tuple[str, str], int]) -> dict[tuple[str, str], int]:
    at = lambda a, b: together.get((a, b), 0)
    return {(x, y): sum(at(z, x) * at(z, y) for z in columns) for x in columns for y in columns}


def bond_order(columns: list[str], together: dict[tuple[str, str], int]) -> list[str]:
    """The order of columns in which neighbours have the strongest bonds (products of affinities), read from
    the end that comes first by name; of equally strong orders the first by name.

    All orders are tried for up to ``EXACT_COLUMNS`` columns. Beyond, each column in turn goes to the
    place where it adds most.
    """
    columns, bond = sorted(columns), _bonds(columns, together)
    strength = lambda order: sum(bond[x, y] for x, y in zip(order, order[1:], strict=False))
    if len(columns) <= EXACT_COLUMNS:
        return list(max(permutations(columns), key=strength, default=()))
    order: list[str] = []
    for column in columns:
        places = [[*order[:k], column, *order[k:]] for k in range(len(order) + 1)]
        order = max(places, key=strength)
    return min(order, order[::-1])


def best_split(order: list[str], patterns: list[tuple[frozenset, int]]) -> tuple[list[str], list[str]]:
    """Two groups of neighbouring columns (the order's ends are neighbours too) with the largest
    T * B - O * O: times of applications that need only one group, only the other, and both. Of equal
    splits the one with the longest first group, then the first."""
    splits = []
    for i in range(1, len(order)):
        for j in range(i + 1, len(order) + 1):
            inner = set(order[i:j])
            only = sum(n for columns, n in patterns if columns <= inner)
            rest = sum(n for columns, n in patterns if columns.isdisjoint(inner))
            both = sum(n for _, n in patterns) - only - rest
            splits.append((only * rest - both * both, len(order) - (j - i), -i, i, j))
    if not splits:
        return list(order), []
    *_, i, j = max(splits)
    return [*order[:i], *order[j:]], order[i:j]


def affinity_split(usage: DataFrame) -> DataFrame:
    """Vertical fragments by how a workload uses attributes: position (from 1), attribute, fragment (1 or 2).

    ``usage`` has application, attribute and times, a row for each attribute an application reads. Sets of
    attributes are counted in Spark; the order of the attributes and the split are found from the counted
    sets. Rows without an application, an attribute or times do not count; a repeated row counts once.
    A single attribute is one fragment; without usage there are no rows.
    """
    known = usage.where("application IS NOT NULL AND attribute IS NOT NULL AND times IS NOT NULL")
    patterns = usage_patterns(known)
    names = sorted(r.attribute for r in known.select("attribute").distinct().limit(MOST_COLUMNS + 1).collect())
    if len(names) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} attributes")
    together = {(r.a, r.b): r.together for r in affinity(patterns).collect()}
    order = bond_order(names, together)
    _, second = best_split(order, [(frozenset(r.columns), r.times) for r in patterns.collect()])
    rows = [(k, name, 2 if name in second else 1) for k, name in enumerate(order, 1)]
    return usage.sparkSession.createDataFrame(rows, "position int, attribute string, fragment int")
