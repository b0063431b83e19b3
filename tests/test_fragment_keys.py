import pytest
from pyspark.sql import functions as F
from world import booking, catalog, payment, publish, rows, ticket

from sitefold.operators import fragment as fr
from sitefold.operators import keys as ks
from sitefold.plans import views as vw
from sitefold.sources.schema import USER_FRAGMENTS
from sitefold.sources.sites import SiteCatalog



@pytest.fixture
def bookings(spark):
    data = [(i, i % 7, "AM" if i % 3 else "EU") for i in range(1, 60)]
    return spark.createDataFrame(data, "id long, id_user int, region string").repartition(5)


def split(df):
    return fr.fragment_horizontal(df, {s: F.col("region") == s for s in ("AM", "EU")})


def test_horizontal_fragments_rebuild(spark, bookings):
    parts = split(bookings)
    assert rows(vw.union_fragments(*parts.values())) == rows(bookings)
    assert all(r.ok for r in fr.verify_fragmentation(bookings, parts, "id").collect())


def test_verification_finds_each_fault(spark, bookings):
    def verdict(parts):
        return {r.check: r.violations for r in fr.verify_fragmentation(bookings, parts, "id").collect()}

    parts = split(bookings)
    assert verdict({"AM": parts["AM"]})["complete"] == 19
    overlap = {"AM": parts["AM"], "EU": parts["EU"].unionByName(parts["AM"].filter("id < 3"))}
    assert verdict(overlap) == {"complete": 0, "disjoint": 2, "rebuild": 2}
    foreign = bookings.filter("id = 3").withColumn("id_user", F.lit(99))
    assert verdict({"AM": parts["AM"], "EU": parts["EU"].filter("id <> 3").unionByName(foreign)}) == {
        "complete": 1, "disjoint": 0, "rebuild": 1,
    }


def test_verification_deals_rows_over_tasks_by_their_number(spark, bookings, monkeypatch):
    monkeypatch.setattr(fr, "TASK_ROWS", 8, raising=False)
    twice = bookings.unionByName(bookings.filter("id = 3 OR id = 4"))
    found = fr.verify_fragmentation(twice, {"AM": split(bookings)["AM"], "EU": split(twice)["EU"]}, "id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") >= 2 and plan.count("], 8\n") >= 2  # 61 rows, both groupings
    assert {r.check: r.violations for r in found.collect()} == {"complete": 1, "disjoint": 0, "rebuild": 0}


def test_vertical_fragments(spark):
    users = vw.view_vertical(catalog(spark))
    parts = fr.fragment_vertical(users, "id_user", USER_FRAGMENTS)
    assert all(r.ok for r in fr.verify_fragmentation(users, parts, "id_user", mode="vertical").collect())
    parts["utilizator_data"] = parts["utilizator_data"].filter("id_user <> 2").withColumn("rol", F.lit("x"))
    parts["utilizator_sec"] = parts["utilizator_sec"].drop("rol").withColumn("telefon2", F.lit("y")).drop("telefon2")
    got = {r.check: r.ok for r in fr.verify_fragmentation(
        users, {"a": parts["utilizator_sec"].withColumn("rol", F.lit("CLIENT")), "b": parts["utilizator_data"].drop("rol")},
        "id_user", mode="vertical").collect()}
    assert got["complete"] is False and got["rebuild"] is False


def test_derived_fragments_follow_the_owner(spark, bookings):
    children = spark.createDataFrame([(i, i % 60) for i in range(200)], "cid long, fk long")
    parts = split(bookings)
    got = {s: {r.fk for r in fr.fragment_derived(children, p, "fk", "id").collect()} for s, p in parts.items()}
    assert got["AM"] == {i for i in range(1, 60) if i % 3} and got["EU"] == {i for i in range(3, 60, 3)}


def test_one_pass_write(spark, bookings, tmp_path):
    path = str(tmp_path / "frag")
    fr.write_fragments(bookings, "region", path)
    assert rows(spark.read.parquet(path), "id", "region") == rows(bookings, "id", "region")


def test_replicate(spark, bookings, root):
    sites = SiteCatalog(spark, root)
    fr.replicate(sites, ["AM", "EU"], "t", bookings, "id")
    assert rows(sites.table("AM", "t")) == rows(sites.table("EU", "t")) == rows(bookings)


def test_dense_numbers_with_a_hot_group(spark):
    # One group holds most rows; numbers must be dense in every group.
    data = [(i, "hot" if i % 10 else f"g{i % 3}") for i in range(5000)] + [(9999, None), (9998, None)]
    df = spark.createDataFrame(data, "k long, g string").repartition(7)
    got = ks.dense_row_number(df, ["k"], by=("g",)).collect()
    groups = {}
    for r in sorted(got, key=lambda r: r.k):
        groups.setdefault(r.g, []).append(r.rn)
    assert len(got) == 5002
    assert all(ns == list(range(1, len(ns) + 1)) for ns in groups.values())


def test_dense_numbers_descending_and_empty(spark):
    df = spark.range(50).repartition(6)
    got = {r.id: r.rn for r in ks.dense_row_number(df, [("id", "desc")]).collect()}
    assert got == {i: 50 - i for i in range(50)}
    assert ks.dense_row_number(df.filter("id < 0"), ["id"]).count() == 0


def test_numbering_uses_no_single_partition(spark):
    df = spark.range(1000)
    plan = ks.dense_row_number(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "id#" in line]
    assert scan, plan
    # The only single-partition exchange orders one row per partition.
    assert plan.count("Exchange SinglePartition") <= 1


def test_remap_and_children(spark, bookings):
    am = split(bookings)["AM"]
    key_map = ks.remap_keys(am.select(F.col("id").alias("old_id")), "old_id", 1, 2)
    expected = {old: 2 * n + 1 for n, old in enumerate(i for i in range(1, 60) if i % 3)}
    assert {r.old_id: r.new_id for r in key_map.collect()} == expected
    children = spark.createDataFrame([(100 + i, i, i * 10) for i in range(1, 60)], "cid long, id long, v long")
    moved = ks.remap_children(children, key_map, "id", "cid", 1, 2)
    assert rows(moved) == sorted(
        (2 * n + 1, expected[i], i * 10) for n, i in enumerate(i for i in range(1, 60) if i % 3)
    )
    both = ks.remap_keys_by_site(bookings, "id", "region")
    assert {r.new_id % 2 for r in both.filter("region = 'EU'").collect()} == {0}
    assert {r.id: r.new_id for r in both.filter("region = 'AM'").collect()} == expected


@pytest.mark.parametrize("top, start, expected", [(49, 1, 51), (56, 2, 58), (None, 1, 1), (None, 2, 2)])
def test_next_key(spark, top, start, expected):
    df = spark.createDataFrame([(top,)] if top else [], "id long")
    assert ks.next_key(df, "id", start, 2).first()[0] == expected


def test_allocate_and_hand_down(spark):
    new = spark.createDataFrame([("c",), ("a",), ("b",)], "tag string")
    owners = ks.allocate_keys(new, ["tag"], "id", 51, 2)
    assert rows(owners, "tag", "id") == [("a", 51), ("b", 53), ("c", 55)]
    children = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "tag string, v int")
    assert rows(ks.hand_down_keys(children, owners, "tag", "id"), "id", "v") == [(51, 1), (51, 2), (55, 3)]


def test_global_views(spark):
    sites = catalog(
        spark, bookings=[booking(1), booking(2), booking(3)], payments=[payment(1, 1), payment(2, 2)],
        tickets=[ticket(1, 1, 1, 1)],
    )
    assert rows(vw.view_horizontal(sites, "rezervare", site_column="site"), "id_rezervare", "site") == [
        (1, "AM"), (2, "EU"), (3, "AM"),
    ]
    assert vw.view_vertical(sites).count() == 4
    sites.register("AM", "utilizator_data", sites.table("EU", "utilizator_data").filter("id_user > 1"))
    assert vw.view_vertical(sites).count() == 3, "a user without a profile is not visible"


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_view_reads_only_the_fragment_it_needs(spark, root):
    sites = publish(spark, root, "rezervare", bookings=[booking(i) for i in range(1, 9)])
    view = vw.view_horizontal(sites, "rezervare", site_column="site", prune=True)
    assert scans(view) == 2
    assert scans(view.filter("site = 'AM'")) == 1
    assert scans(view.filter("regiune_vanzare = 'EU'")) == 1
    assert scans(view.filter("id_rezervare = 7")) == 1
    assert rows(view.filter("id_rezervare = 7"), "id_rezervare", "site") == [(7, "AM")]
