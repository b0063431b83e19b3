"""Fragmentation design against plain versions on small inputs."""

import random
from itertools import combinations, permutations

import pytest
from pyspark.sql import functions as F

from sitefold.operators import design as ds
from sitefold.operators import fragment as fr


@pytest.fixture
def items(spark):
    rows = [(k, ("AM", "EU", None)[k % 3], k % 7, k) for k in range(84)]
    return spark.createDataFrame(rows, "id long, region string, kind int, rows long").repartition(4)


@pytest.fixture
def predicates(spark):
    return {
        "low": F.col("kind") < 3, "am": F.col("region") == "AM", "eu": F.col("region") == "EU", "all": F.col("id") >= 0,
    }


def labels(design):
    return {design.label(m): m.rows for m in design.minterms}


def test_only_relevant_predicates_stay(items, predicates):
    design = ds.minterm_design(items, predicates, {"desk": F.col("region") == "AM"})
    assert design.names == ("am",)
    assert labels(design) == {"am": 28, "NOT am": 56}
    assert [m.read for m in design.minterms] == [(28,), (0,)]


def test_a_predicate_that_later_ones_replace_is_taken_out(items, predicates):
    near = {"near": F.expr("region = 'AM' OR id = 1"), **predicates}
    design = ds.minterm_design(items, near, {"a": F.col("region") == "AM", "b": F.expr("region = 'EU' AND kind < 3")})
    assert design.names == ("low", "am", "eu")


def test_fragments_are_complete_and_disjoint_on_other_rows(items, predicates):
    design = ds.minterm_design(items.where("region = 'AM' AND kind < 3 OR region = 'EU'"), predicates,
                               {"a": F.col("region") == "AM", "b": F.expr("region = 'EU' AND kind < 3")})
    fragments = design.fragments()
    assert set(fragments) == set(labels(design)) | {"rest"}
    found = fr.verify_fragmentation(items, fr.fragment_horizontal(items, fragments), "id").collect()
    assert all(r.ok for r in found) and len(found) == 3
    named = {r.fragment: r["count"] for r in ds.minterm_fragments(items, design).groupBy("fragment").count().collect()}
    assert named == {n: items.where(p).count() for n, p in fragments.items() if items.where(p).count()}


def test_complete_and_minimal_by_search(spark):
    """No smaller set tells the applications apart as well; the chosen one tells all that can be told."""
    draw = random.Random(3)
    rows = [(k, draw.randrange(16)) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, v int")
    for seed in range(4):
        draw = random.Random(seed)
        sets = [frozenset(draw.sample(range(16), draw.choice((2, 8)))) for _ in range(5)]
        apps = [sets[0] & sets[1], sets[2]]
        design = ds.minterm_design(
            df, {f"p{k}": F.col("v").isin(*s) for k, s in enumerate(sets)}, {f"a{k}": F.col("v").isin(*s) for k, s in enumerate(apps)}
        )

        def uniform(chosen, sets=sets, apps=apps):
            parts = {}
            for _, v in rows:
                parts.setdefault(tuple(v in sets[k] for k in chosen), set()).add(tuple(v in a for a in apps))
            return all(len(p) == 1 for p in parts.values())

        chosen = [int(n[1:]) for n in design.names]
        assert uniform(chosen)
        assert not any(uniform(c) for k in range(len(chosen)) for c in combinations(chosen, k))


def test_empty_table_and_limits(items, predicates):
    design = ds.minterm_design(items.limit(0), predicates, {"a": F.col("kind") == 1})
    assert design.names == () and design.minterms == ()
    assert items.where(design.fragments()["rest"]).count() == 84
    with pytest.raises(ValueError, match="more than"):
        ds.minterm_design(items, {f"p{k}": F.col("kind") == k for k in range(30)}, {})


USAGE = [("q1", ("a", "c"), 45), ("q2", ("b", "c"), 5), ("q3", ("b", "d"), 75), ("q4", ("c", "d"), 3)]


def usage(spark, queries):
    rows = [(q, c, n) for q, columns, n in queries for c in columns]
    return spark.createDataFrame([*rows, rows[0], (None, "a", 9), ("q9", None, 9)], "application string, attribute string, times long")


def test_text_book_workload(spark):
    assert {(r.a, r.b): r.together for r in ds.affinity(ds.usage_patterns(usage(spark, USAGE).dropna())).collect()} == {
        ("a", "a"): 45, ("a", "c"): 45, ("c", "a"): 45, ("b", "b"): 80, ("b", "c"): 5, ("c", "b"): 5, ("b", "d"): 75,
        ("d", "b"): 75, ("c", "c"): 53, ("c", "d"): 3, ("d", "c"): 3, ("d", "d"): 78,
    }
    found = ds.affinity_split(usage(spark, USAGE)).collect()
    assert [(r.attribute, r.fragment) for r in sorted(found)] == [("a", 1), ("c", 1), ("b", 2), ("d", 2)]


@pytest.mark.parametrize("seed", range(30))
def test_orders_and_splits_by_search(seed, monkeypatch):
    draw = random.Random(seed)
    columns = [f"c{k}" for k in range(draw.choice((1, 2, 4, 6)))]
    patterns = [(frozenset(draw.sample(columns, draw.randint(1, len(columns)))), draw.randint(1, 90)) for _ in range(5)]
    together = {(a, b): sum(n for p, n in patterns if a in p and b in p) for a in columns for b in columns}
    strength = lambda o: sum(together[z, x] * together[z, y] for x, y in zip(o, o[1:], strict=False) for z in columns)
    order = ds.bond_order(columns, together)
    assert strength(order) == max(strength(o) for o in permutations(columns))
    first, second = ds.best_split(order, patterns)
    assert sorted(first + second) == columns

    def value(part):
        top, bottom = (sum(n for p, n in patterns if p <= set(s)) for s in (part, set(columns) - set(part)))
        return top * bottom - (sum(n for _, n in patterns) - top - bottom) ** 2

    ring = order + order
    parts = [ring[i : i + k] for i in range(len(order)) for k in range(1, len(order))]
    if parts:
        assert value(second) == max(map(value, parts))
    monkeypatch.setattr(ds, "EXACT_COLUMNS", 0)
    greedy = ds.bond_order(columns, together)
    assert sorted(greedy) == columns and 2 * strength(greedy) >= strength(order)
