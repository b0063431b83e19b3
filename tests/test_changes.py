import random

import pytest
from pyspark.sql import functions as F
from world import booking, catalog, money, payment, rows

from sitefold.operators import changes as ch

TARGET = "k long, v string, n int"
CHANGE = "seq long, op string, k long, v string, n int"


def replay(target, changes, strict=False):
    """Brute force: one change after the other."""
    state = {k: (v, n) for k, v, n in target}
    for _, op, k, v, n in sorted(changes):
        if op == "I":
            if strict and k in state:
                raise ch.ChangeConflict(k)
            state[k] = (v, n)
        elif op == "U" and k in state:
            state[k] = (v, n)
        elif op == "D":
            state.pop(k, None)
    return sorted((k, *vn) for k, vn in state.items())


def batch(rng, size, keys):
    out = []
    for seq in rng.sample(range(10 * size), size):
        k = 0 if rng.random() < 0.4 else rng.randrange(keys)  # key 0 is hot
        out.append((seq, rng.choice("IUD"), k, rng.choice(["a", "b", ""]), rng.randrange(5)))
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_apply_equals_replay(spark, seed, broadcast):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        replayed(spark, seed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def replayed(spark, seed):
    rng = random.Random(seed)
    target = [(k, "t", k) for k in rng.sample(range(30), 15)]
    changes = batch(rng, rng.choice([3, 40, 120]), 40)
    got = ch.apply_changes(
        spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGE).repartition(4), "k"
    )
    assert rows(got) == replay(target, changes)


@pytest.mark.parametrize("seed", range(8))
def test_strict_mode_finds_the_same_conflicts(spark, seed):
    rng = random.Random(100 + seed)
    target = [(k, "t", k) for k in range(0, 20, 2)]
    changes = batch(rng, 25, 30)
    frames = spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGE)
    bad = set()
    for k in {c[2] for c in changes}:
        try:
            replay([t for t in target if t[0] == k], [c for c in changes if c[2] == k], strict=True)
        except ch.ChangeConflict:
            bad.add(k)
    assert {r.k for r in ch.insert_conflicts(*frames, "k").collect()} == bad
    if bad:
        with pytest.raises(ch.ChangeConflict):
            ch.apply_changes(*frames, "k", strict=True)
    else:
        assert rows(ch.apply_changes(*frames, "k", strict=True)) == replay(target, changes)


def test_update_of_absent_key_is_a_no_op_and_null_is_a_value(spark):
    target = spark.createDataFrame([(1, "a", 1)], TARGET)
    changes = spark.createDataFrame([(1, "U", 2, "x", 1), (2, "D", 3, None, None), (3, "U", 1, None, None)], CHANGE)
    assert [tuple(r) for r in ch.apply_changes(target, changes, "k").collect()] == [(1, None, None)]


@pytest.mark.parametrize("seed", range(4))
def test_capture_then_apply_is_identity(spark, seed):
    rng = random.Random(seed)
    make = lambda: [(k, rng.choice(["a", None]), rng.randrange(3)) for k in rng.sample(range(40), 25)]
    a, b = make(), make()
    before, after = spark.createDataFrame(a, TARGET), spark.createDataFrame(b, TARGET)
    log = ch.capture_changes(before, after, "k", start_seq=10)
    got = ch.apply_changes(before, log, "k", strict=True)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(b, key=repr)
    assert sorted(r.seq for r in log.collect()) == list(range(10, 10 + log.count()))
    states = {r.k: r.state for r in ch.compare_replicas(before, after, "k").collect()}
    da, db = {r[0]: r for r in a}, {r[0]: r for r in b}
    for k in set(da) | set(db):
        expected = "only_a" if k not in db else "only_b" if k not in da else "same" if da[k] == db[k] else "diff"
        assert states[k] == expected


def test_partial_updates_keep_the_last_of_each_column(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], TARGET)
    updates = spark.createDataFrame(
        [(1, 1, "x", 7, ["v"]), (2, 1, "y", 8, ["n"]), (3, 1, "z", None, ["n"]), (4, 9, "q", 1, ["v", "n"]),
         (5, 2, "w", 1, [])],
        "seq long, k long, v string, n int, sets array<string>",
    )
    got = ch.update_by_key(target, updates, "k", ["v", "n"])
    assert {tuple(r) for r in got.collect()} == {(1, "x", None), (2, "b", 2)}


def test_delete_by_own_and_owner_key(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 1)], TARGET)
    gone = spark.createDataFrame([(1,)], "n int")
    assert rows(ch.delete_by_key(target, gone, "n"), "k") == [(2,)]
    assert rows(ch.delete_by_key(target, gone, "k", of="n"), "k") == [(2,), (3,)]


def booking_update(spark, *updates):
    return spark.createDataFrame(
        [(i, "U", k, s, money(5), "EU") for i, (k, s) in enumerate(updates)],
        "seq long, op string, id_rezervare long, status string, total_de_plata decimal(10,2), regiune_vanzare string",
    )


def fragments(sites, name):
    return {s: sites.table(s, f"{name}_{s.lower()}") for s in ("AM", "EU")}


def test_routing_by_parity_writes_two_columns_only(spark):
    sites = catalog(spark, bookings=[booking(i) for i in (1, 2, 3, 4)])
    got = ch.route_update("v_rezervare", booking_update(spark, (1, "ANULATA"), (4, "FINALIZATA"), (99, "ANULATA")),
                          fragments(sites, "rezervare"), "id_rezervare")
    assert rows(got["AM"], "id_rezervare", "status", "regiune_vanzare") == [
        (1, "ANULATA", "AM"), (3, "CONFIRMATA", "AM")]
    assert rows(got["EU"], "id_rezervare", "status") == [(2, "CONFIRMATA"), (4, "FINALIZATA")]
    assert [float(r.total_de_plata) for r in got["EU"].orderBy("id_rezervare").collect()] == [100.0, 5.0]


def test_views_without_a_rule_refuse_changes(spark):
    sites = catalog(spark, bookings=[booking(1)])
    change = booking_update(spark, (1, "ANULATA"))
    for view in ("v_plata", "v_bilet"):
        with pytest.raises(ch.ChangeConflict):
            ch.accept_view_changes(view, change)
    for op in ("I", "D"):
        with pytest.raises(ch.ChangeConflict):
            ch.route_update("v_rezervare", change.withColumn("op", F.lit(op)), fragments(sites, "rezervare"), "id_rezervare")


def test_cancel_refunds_every_payment_at_the_owner(spark):
    sites = catalog(
        spark, bookings=[booking(i) for i in (1, 2, 3)],
        payments=[payment(1, 1), payment(3, 1, status="RESPINSA"), payment(5, 3), payment(2, 2)],
    )
    ids = spark.createDataFrame([(1,), (1,), (2,), (50,)], "id_rezervare long")
    b, p = ch.cancel_bookings(ids, fragments(sites, "rezervare"), fragments(sites, "plata"))
    assert rows(b["AM"], "id_rezervare", "status") == [(1, "ANULATA"), (3, "CONFIRMATA")]
    assert rows(b["EU"], "id_rezervare", "status") == [(2, "ANULATA")]
    assert rows(p["AM"], "id_plata", "status") == [(1, "RAMBURSATA"), (3, "RAMBURSATA"), (5, "ACCEPTATA")]
    assert rows(p["EU"], "id_plata", "status") == [(2, "RAMBURSATA")]


def test_vertical_update_drops_security_columns(spark):
    sites = catalog(spark)
    change = spark.createDataFrame(
        [(1, "U", 2, "Nou", "x@y.ro", ["nume", "email"])],
        "seq long, op string, id_user long, nume string, email string, sets array<string>",
    )
    got = ch.route_update_vertical("v_utilizator", change, sites.table("AM", "utilizator_data"), "id_user")
    assert rows(got, "id_user", "nume")[1] == (2, "Nou")
    assert "email" not in got.columns
