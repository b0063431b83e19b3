from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from world import frame, publish, rows

from sitefold.plans.views import global_catalog
from sitefold.sources import loading as ld
from sitefold.sources.schema import RELATIONS, with_defaults
from sitefold.sources.sites import SiteCatalog, StaleBase


def test_csv_load_is_typed(spark, tmp_path):
    path = tmp_path / "rezervare.csv"
    path.write_text(
        "id_rezervare,id_user,data_rezervare,regiune_vanzare,total_de_plata,status\n"
        "1,2,2025-09-12 02:17:46.9,EU,512.4000000000001,CONFIRMATA\n"
        '2,2,2025-09-12 02:17:46,EU,1831.1999999999998,""\n'
    )
    df = ld.load_table(spark, str(path), RELATIONS["rezervare"], fmt="csv")
    got = rows(df, "id_rezervare", "data_rezervare", "total_de_plata", "status")
    assert got[0] == (1, datetime(2025, 9, 12, 2, 17, 46), Decimal("512.40"), "CONFIRMATA")
    assert got[1][2:] == (Decimal("1831.20"), None)


def test_load_refuses_bad_values(spark, tmp_path):
    path = tmp_path / "avion.csv"
    path.write_text("id_avion,numar_inmatriculare,model,capacitate,an_fabricatie\n1,YR,M,many,2000\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ld.load_table(spark, str(path), RELATIONS["avion"], fmt="csv").collect()


def test_parquet_load_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select(F.col("id").alias("id_tara"), F.lit("x").alias("nume_tara"), F.lit("RO").alias("cod_iso_2"),
                          F.lit(1).alias("extra")).write.parquet(path)
    df = ld.load_table(spark, path, RELATIONS["tara"]).select("id_tara")
    assert "ReadSchema: struct<id_tara:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_copy_append(spark, tmp_path):
    path = str(tmp_path / "copy")
    src = frame(spark, "tara", [(1, "Romania", "RO")])
    ld.copy_table(src, path)
    ld.copy_table(frame(spark, "tara", [(2, "France", "FR")]), path)
    assert rows(spark.read.parquet(path), "id_tara") == [(1,), (2,)]


def test_insert_if_absent_first_wins_and_null_keys_stay(spark):
    target = spark.createDataFrame([(1, "RO")], "n int, code string")
    new = spark.createDataFrame([(5, "FR"), (3, "FR"), (9, "RO"), (7, None), (8, None)], "n int, code string")
    assert rows(ld.insert_if_absent(target, new, ["code"], "n").select("n")) == [(1,), (3,), (7,), (8,)]
    again = ld.insert_if_absent(ld.insert_if_absent(target, new, ["code"], "n"), new.filter("code IS NOT NULL"), ["code"], "n")
    assert again.count() == 4


def test_resolve_fk(spark):
    dim = spark.createDataFrame([(1, "RO"), (2, "FR")], "id long, code string")
    got = ld.resolve_fk(spark.createDataFrame([("FR",), ("XX",), (None,)], "c string"), dim, {"c": "code"}, "id", "fk")
    assert {r.c: r.fk for r in got.collect()} == {"FR": 2, "XX": None, None: None}
    doubled = dim.unionByName(spark.createDataFrame([(3, "RO")], "id long, code string"))
    with pytest.raises(Exception, match="more than one id"):
        ld.resolve_fk(spark.createDataFrame([("RO",)], "c string"), doubled, {"c": "code"}, "id", "fk").collect()


def test_resolve_position(spark):
    dim = spark.createDataFrame([(30,), (10,), (20,)], "id long")
    got = ld.resolve_position(spark.createDataFrame([(1,), (3,), (4,)], "p long"), dim, "p", "id", "fk")
    assert rows(got.na.fill(-1)) == [(1, 10), (3, 30), (4, -1)]


def test_defaults(spark):
    new = spark.createDataFrame([(1, None), (2, "ANULATA")], "id_rezervare long, status string")
    got = with_defaults(new, RELATIONS["rezervare"], as_of="2026-01-11 12:00:00", regiune_vanzare="EU")
    assert rows(got, "id_rezervare", "status", "regiune_vanzare") == [(1, "IN_ASTEPTARE", "EU"), (2, "ANULATA", "EU")]
    assert {r.data_rezervare for r in got.collect()} == {datetime(2026, 1, 11, 12)}


# --- sites and publishing --------------------------------------------------------------


def numbers(spark, n, v="a"):
    return spark.range(n).select("id", F.lit(v).alias("v"))


def test_publish_is_all_or_nothing(spark, root):
    catalog = SiteCatalog(spark, root)
    catalog.publish({("AM", "t"): (numbers(spark, 5), "id"), ("AM", "u"): (numbers(spark, 3), "id")})
    before = catalog.table("AM", "t")
    broken = numbers(spark, 9).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        catalog.publish({("AM", "t"): (numbers(spark, 7, "b"), "id"), ("AM", "u"): (broken, "id")})
    assert catalog.table("AM", "t").count() == 5 and catalog.table("AM", "u").count() == 3
    catalog.publish({("AM", "t"): (numbers(spark, 7, "b"), "id"), ("AM", "u"): (numbers(spark, 1), "id")}, buckets=3)
    assert catalog.table("AM", "t").count() == 7 and catalog.table("AM", "u").count() == 1
    assert before.count() == 5, "a reader keeps the version it resolved"


def test_publish_changes_rewrites_touched_buckets_only(spark, root):
    catalog = SiteCatalog(spark, root)
    catalog.publish({("EU", "t"): (numbers(spark, 100), "id")}, buckets=8)
    old = catalog._head([("EU", "t")]).tables["EU", "t"].paths
    changes = spark.createDataFrame([(7, "new"), (200, "added")], "id long, v string")
    catalog.publish_changes(
        {("EU", "t"): (changes, lambda cur, ch: cur.join(ch.select("id"), "id", "left_anti").unionByName(ch))},
        tag="batch 1",
    )
    new = catalog._head([("EU", "t")]).tables["EU", "t"].paths
    assert 1 <= sum(old[b] != new[b] for b in old) <= 2
    got = {r.id: r.v for r in catalog.table("EU", "t").collect()}
    assert len(got) == 101 and got[7] == "new" and got[200] == "added" and got[8] == "a"
    assert catalog.committed("batch 1") and not catalog.committed("batch 2")


def test_appends_add_folders_and_rewrite_nothing(spark, root):
    catalog = SiteCatalog(spark, root)
    catalog.publish({("EU", "t"): (numbers(spark, 1000), "id")}, buckets=4)
    old = catalog._head([("EU", "t")]).tables["EU", "t"].paths
    catalog.publish_changes(appends={("EU", "t"): spark.createDataFrame([("x", 2000), ("y", 2001)], "v string, id long")})
    new = catalog._head([("EU", "t")]).tables["EU", "t"].paths
    assert all(new[b][:1] == old[b] for b in old) and 1 <= sum(len(p) - 1 for p in new.values()) <= 2
    written = [p for b in new for p in new[b][1:]]
    assert sorted(r.id for r in spark.read.parquet(*written).collect()) == [2000, 2001]
    assert catalog.table("EU", "t").count() == 1002
    # A rewrite takes in what was appended.
    gone = spark.createDataFrame([(2000,), (5,)], "id long")
    catalog.publish_changes({("EU", "t"): (gone, lambda cur, ch: cur.join(ch, "id", "left_anti"))})
    assert catalog.table("EU", "t").count() == 1000
    catalog.publish_changes(appends={("EU", "t"): numbers(spark, 0)})
    assert catalog.table("EU", "t").count() == 1000


def test_snapshot_is_one_version_of_all_tables(spark, root):
    catalog = SiteCatalog(spark, root)
    catalog.publish({("AM", "t"): (numbers(spark, 5), "id"), ("AM", "u"): (numbers(spark, 3), "id")}, buckets=2)
    reads = []
    log = catalog._log
    catalog._log = lambda: reads.append(1) or log()
    snapshot = catalog.snapshot()
    first = snapshot.table("AM", "t")
    catalog.publish({("AM", "t"): (numbers(spark, 7), "id"), ("AM", "u"): (numbers(spark, 9), "id")}, buckets=2)
    del reads[1:]
    assert (first.count(), snapshot.table("AM", "u").count(), snapshot.has("AM", "u")) == (5, 3, True)
    assert len(reads) == 1 and snapshot.snapshot() is snapshot
    assert catalog.table("AM", "u").count() == 9


def test_publish_from_an_old_version_fails(spark, root):
    catalog = SiteCatalog(spark, root)
    catalog.publish({("AM", n): (numbers(spark, 5), "id") for n in "tuw"}, buckets=2)
    base = catalog.snapshot().version
    row = spark.createDataFrame([(9, "x")], "id long, v string")
    catalog.publish_changes(appends={("AM", "t"): row}, base=base)
    with pytest.raises(StaleBase):
        catalog.publish_changes(appends={("AM", "t"): row}, base=base)
    with pytest.raises(StaleBase):
        catalog.publish_changes(appends={("AM", "u"): row}, base=base, relied_on=[("AM", "t")])
    with pytest.raises(StaleBase):
        catalog.publish({("AM", "t"): (numbers(spark, 1), "id")}, base=base)
    catalog.publish_changes(appends={("AM", "u"): row}, base=base, relied_on=[("AM", "w")])
    assert [catalog.table("AM", n).count() for n in "tuw"] == [6, 6, 5]


def test_bucket_count_follows_the_rows(spark, root, monkeypatch):
    monkeypatch.setattr("sitefold.sources.sites.BUCKET_ROWS", 30)
    catalog = SiteCatalog(spark, root)
    catalog.publish({("AM", "t"): (numbers(spark, 100), "id"), ("AM", "u"): (numbers(spark, 0), "id")})
    tables = catalog._head().tables
    assert (tables["AM", "t"].buckets, tables["AM", "u"].buckets) == (4, 1)


def test_empty_and_missing_tables(spark, root):
    catalog = SiteCatalog(spark, root)
    assert not catalog.has("AM", "t")
    with pytest.raises(KeyError):
        catalog.table("AM", "t")
    catalog.publish({("AM", "t"): (numbers(spark, 0), "id")})
    assert catalog.table("AM", "t").count() == 0
    assert catalog.table("AM", "t").columns == ["id", "v"]
    with pytest.raises(ValueError):
        SiteCatalog(spark).publish({("AM", "t"): (numbers(spark, 1), "id")})


def test_sites_synonyms_and_global_names(spark, root):
    catalog = publish(spark, root, "tara", "zbor", "utilizator_data")
    assert rows(catalog.table("EU", "tara"), "cod_iso_2") == [("FR",), ("RO",), ("US",)]
    catalog.synonym("zbor")
    assert spark.sql("SELECT count(*) FROM zbor").first()[0] == 4
    names = global_catalog(catalog)
    assert set(names) == {"v_rezervare", "v_plata", "v_bilet", "v_utilizator", "tara", "oras", "aeroport", "avion",
                          "zbor", "pasager"}
    assert spark.sql("SELECT u.email FROM v_utilizator u WHERE id_user = 3").first()[0] == "ana3@example.com"
