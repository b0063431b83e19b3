import random

import pytest
from pyspark.sql import functions as F
from world import FLIGHTS, frame, publish, rows, ticket

from sitefold.operators.changes import apply_changes
from sitefold.sources.sites import SiteCatalog
from sitefold.streaming import replicate as rs
from test_changes import CHANGE, TARGET, batch, replay

COUNTRY = "seq long, op string, id_tara long, nume_tara string, cod_iso_2 string"


def feed(spark, folder, changes, schema):
    spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(folder)


def sync(spark, catalog, folder, checkpoint, schema, name="tara", key="id_tara"):
    stream = rs.read_changes(spark, folder, schema, maxFilesPerTrigger="1")
    query = rs.replicate_stream(stream, catalog, "EU", name, key, checkpoint)
    query.awaitTermination()
    return rs.read_replica(catalog, "EU", name)


def test_insert_update_delete_reach_the_copy(spark, root, tmp_path):
    folder, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    catalog = SiteCatalog(spark, root)
    rs.start_replica(catalog, "EU", "tara", frame(spark, "tara", [(1, "Romania", "RO")]), "id_tara", buckets=4)
    for step, change, expected in [
        (1, (1, "I", 999, "TEST_SYNC", "TS"), [(999, "TEST_SYNC")]),
        (2, (2, "U", 999, "TEST_SYNC_UPDATED", "TS"), [(999, "TEST_SYNC_UPDATED")]),
        (3, (3, "D", 999, None, None), []),
    ]:
        feed(spark, folder, [change], COUNTRY)
        got = sync(spark, catalog, folder, checkpoint, COUNTRY)
        assert rows(got.filter("id_tara = 999"), "id_tara", "nume_tara") == expected, step
    assert rows(rs.read_replica(catalog, "EU", "tara"), "id_tara") == [(1,)]


def test_many_micro_batches_equal_replay(spark, root, tmp_path):
    rng = random.Random(5)
    target = [(k, "t", k) for k in range(12)]
    changes = sorted(batch(rng, 60, 20))
    folder = str(tmp_path / "log")
    for i in range(0, 60, 20):
        feed(spark, folder, changes[i : i + 20], CHANGE)
    catalog = SiteCatalog(spark, root)
    rs.start_replica(catalog, "EU", "t", spark.createDataFrame(target, TARGET), "k", buckets=3)
    got = sync(spark, catalog, folder, str(tmp_path / "cp"), CHANGE, "t", "k")
    assert rows(got) == replay(target, changes)


def test_late_changes_and_repeats_are_ignored(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], TARGET)
    state = rs.initial_state(base)

    def step(state, *changes):
        return rs.merge_late(state, spark.createDataFrame(list(changes), CHANGE), "k")

    def visible(state):
        return rows(state.filter("NOT _deleted").select("k", "v"))

    one = step(state, (10, "U", 1, "new", 1), (11, "D", 2, None, None))
    assert visible(one) == [(1, "new")]
    late = step(one, (5, "U", 1, "old", 1), (9, "I", 2, "back", 1))
    assert visible(late) == [(1, "new")], "older than what was applied"
    again = step(late, (10, "U", 1, "new", 1), (11, "D", 2, None, None))
    assert rows(again.select("k", "_seq")) == [(1, 10), (2, 11)]
    assert visible(step(again, (12, "I", 2, "again", 1))) == [(1, "new"), (2, "again")]


@pytest.mark.parametrize("seed", range(4))
def test_any_cut_and_order_equals_replay(spark, seed):
    rng = random.Random(seed)
    target = [(k, "t", k) for k in range(12)]
    changes = batch(rng, 60, 20)
    state = rs.initial_state(spark.createDataFrame(target, TARGET))
    for at in range(0, 60, 20):
        state = rs.merge_late(state, spark.createDataFrame(changes[at : at + 20], CHANGE), "k")
    assert rows(state.filter("NOT _deleted").select("k", "v", "n")) == replay(target, changes)


def test_late_insert_is_born_with_the_update(spark):
    state = rs.initial_state(spark.createDataFrame([], TARGET))
    for change in ((10, "U", 1, "new", 1), (5, "I", 1, "old", 2)):
        state = rs.merge_late(state, spark.createDataFrame([change], CHANGE), "k")
    assert rows(state.filter("NOT _deleted").select("k", "v", "n")) == [(1, "new", 1)]


def test_marks_of_absent_keys_can_be_forgotten(spark):
    state = rs.initial_state(spark.createDataFrame([(1, "a", 1)], TARGET))
    log = spark.createDataFrame([(10, "D", 1, None, None), (11, "U", 2, "x", 1), (50, "I", 3, "y", 1)], CHANGE)
    assert rows(rs.merge_late(state, log, "k").select("k")) == [(1,), (2,), (3,)]
    assert rows(rs.merge_late(state, log, "k", forget_before=11).select("k")) == [(2,), (3,)]


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    log = spark.range(1000).selectExpr("id seq", "'U' op", "id % 2 * (id % 7) k", "'v' v", "1 n")
    merged = rs.merge_late(rs.initial_state(spark.createDataFrame([(1, "a", 1)], TARGET)), log, "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    side = plan[: plan.index("Range")]
    assert "partial_max_by" in side[side.rindex("Exchange") :]


def test_retried_batch_is_applied_once(spark, root, tmp_path):
    folder = str(tmp_path / "log")
    catalog = SiteCatalog(spark, root)
    rs.start_replica(catalog, "EU", "tara", frame(spark, "tara", []), "id_tara", buckets=2)
    feed(spark, folder, [(1, "I", 7, "A", "AA")], COUNTRY)
    checkpoint = str(tmp_path / "cp")
    sync(spark, catalog, folder, checkpoint, COUNTRY)
    versions = catalog._head().version
    assert catalog.committed(f"EU/tara@{checkpoint}#0")
    # Lose the stream's own commit record: Spark runs batch 0 again.
    for f in (tmp_path / "cp" / "commits").iterdir():
        f.unlink()
    sync(spark, catalog, folder, checkpoint, COUNTRY)
    assert catalog._head().version == versions
    assert rows(rs.read_replica(catalog, "EU", "tara"), "id_tara") == [(7,)]


def test_pushed_relations(spark, root, tmp_path):
    catalog = SiteCatalog(spark, root)
    started = {}
    for name, row in (("tara", (1, "I", 5, "Italia", "IT")), ("oras", (1, "I", 6, 5, "Roma")),
                      ("avion", (1, "I", 9999, "TEST-999", "M", 180, 2020)),
                      ("utilizator_data", (1, "D", 1, None, None, None, None))):
        schema, key = rs.table_schema(name)
        rs.start_replica(catalog, "EU", name, spark.createDataFrame([], schema), key, buckets=2)
        layout = f"seq long, op string, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}"
        feed(spark, str(tmp_path / "log" / name), [row], layout)
        started[name] = key
    queries = rs.start_sync(catalog, "EU", str(tmp_path / "log"), str(tmp_path / "cp"))
    assert set(queries) == set(started), "airports and flights are not pushed"
    for query in queries.values():
        query.awaitTermination()
    assert rows(rs.read_replica(catalog, "EU", "oras")) == [(6, 5, "Roma")]
    assert rs.read_replica(catalog, "EU", "utilizator_data").count() == 0


def flight_log(spark, *changes):
    base = frame(spark, "zbor", FLIGHTS)
    out = None
    for seq, op, key, status in changes:
        row = base.filter(F.col("id_zbor") == 1).withColumns(
            {"id_zbor": F.lit(key).cast("long"), "status": F.lit(status)}
        ).select(F.lit(seq).cast("long").alias("seq"), F.lit(op).alias("op"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def test_refresh_on_demand(spark, root):
    sites = publish(spark, root, "zbor")
    log = flight_log(spark, (1, "U", 1, "INTARZIAT"), (2, "I", 9, "PROGRAMAT"))
    status = lambda: dict(rows(sites.table("EU", "zbor"), "id_zbor", "status"))
    assert status()[1] == "PROGRAMAT"
    master = apply_changes(sites.table("AM", "zbor"), log, "id_zbor")
    assert rows(rs.stale_keys(master, sites.table("EU", "zbor"), "id_zbor"), "op", "id_zbor") == [("I", 9), ("U", 1)]
    position = rs.publish_refresh(sites, "EU", "zbor", log, 0, "id_zbor")
    assert position == 2 and status()[1] == "INTARZIAT" and 9 in status()
    assert rs.publish_refresh(sites, "EU", "zbor", log, position, "id_zbor") == position
    assert rs.stale_keys(master, sites.table("EU", "zbor"), "id_zbor").count() == 0


def test_refresh_is_refused_when_it_orphans_rows(spark, root):
    sites = publish(spark, root, "zbor", "bilet", tickets=[ticket(2, 2, 1, 1)])
    log = flight_log(spark, (1, "D", 1, "PROGRAMAT"), (2, "U", 2, "ANULAT"))
    children = [("bilet_eu", sites.table("EU", "bilet_eu"), "id_bilet", "id_zbor")]
    _, _, orphans = rs.refresh_validated(sites.table("EU", "zbor"), log, 0, "id_zbor", children)
    assert rows(orphans, "name", "key", "detail") == [("bilet_eu", "2", "1")]
    with pytest.raises(rs.RefreshRefused):
        rs.publish_refresh(sites, "EU", "zbor", log, 0, "id_zbor", children)
    assert sites.table("EU", "zbor").count() == 4
    assert rs.publish_refresh(sites, "EU", "zbor", log.filter("seq > 1"), 0, "id_zbor", children) == 2


def test_chain_from_the_view_to_the_copy(spark, root):
    sites = publish(spark, root, "utilizator_data")
    change = spark.createDataFrame(
        [(1, "U", 3, "Nou")], "seq long, op string, id_user long, nume string"
    )
    master, copy = rs.propagate_vertical(
        change, sites.table("AM", "utilizator_data"), sites.table("EU", "utilizator_data")
    )
    assert rows(master, "id_user", "nume") == rows(copy, "id_user", "nume")
    assert (3, "Nou") in rows(copy, "id_user", "nume")
