import pytest
from pyspark.sql import functions as F
from world import AIRCRAFT, booking, catalog, flight, frame, payment, rows, ticket, ts

from sitefold.operators import integrity as ic
from sitefold.plans.views import view_horizontal, view_vertical
from sitefold.sources.schema import RELATIONS

SEAT = ["id_zbor", "numar_rand", "litera_scaun"]


def broken(df, name):
    relation = RELATIONS[name]
    found = ic.check_rules(df, name, relation.key, relation.checks)
    return sorted((r.rule, r.key) for r in found.collect())


@pytest.mark.parametrize(
    "name, row, rule",
    [
        ("avion", (9901, "YR-T1", "M", 0, 2020), "aircraft_capacity"),
        ("avion", (9903, "YR-T3", "M", 851, 2020), "aircraft_capacity"),
        ("avion", (9902, "YR-T2", "M", 150, 1930), "aircraft_year"),
        ("avion", (9904, "YR-T4", "M", 850, 1950), None),
        ("rezervare", booking(9902, total=-100), "booking_total"),
        ("rezervare", booking(9904, total=0), None),
        ("rezervare", booking(9905, status="LOST"), "booking_status"),
        ("plata", payment(9901, 9903, amount=-50), "payment_amount"),
        ("plata", (9901, 1, payment(1, 1)[2], ts("2026-01-01 00:00:00"), "BITCOIN", "ACCEPTATA"), "payment_method"),
        ("plata", payment(9902, 1, status="LOST"), "payment_status"),
        ("tara", (9901, "Test", "ro"), "country_iso"),
        ("tara", (9901, "Test", "ROU"), "country_iso"),
        ("tara", (9901, "Test", "RO"), None),
        ("aeroport", (1, 1, "otp", "x"), "airport_iata"),
        ("zbor", flight(1, 1, 2, 2, 10), "flight_two_airports"),
        ("zbor", flight(1, 1, 1, 2, 10, leaves="2026-03-01 00:00:00"), "flight_dates"),
        ("zbor", flight(1, 1, 1, 2, 0), "flight_price"),
        ("zbor", flight(1, 1, 1, 2, 10, status="X"), "flight_status"),
        ("bilet", ticket(1, 1, 1, 1, row=101), "ticket_row"),
        ("bilet", ticket(1, 1, 1, 1, row=0), "ticket_row"),
        ("bilet", ticket(1, 1, 1, 1, letter="I"), "ticket_letter"),
        ("bilet", ticket(1, 1, 1, 1, travel="FIRST"), "ticket_class"),
        ("bilet", ticket(1, 1, 1, 1, price=0), "ticket_price"),
        ("pasager", (1, "a", "b", ts("1980-01-01 00:00:00"), "X", "ROMA"), "passenger_nationality"),
        ("utilizator", (1, "a", "b", "nomail", "p", None, ts("1980-01-01 00:00:00"), "CLIENT"), "user_email"),
        ("utilizator", (1, "a", "b", "a@b.ro", "p", None, ts("1980-01-01 00:00:00"), "BOSS"), "user_role"),
    ],
)
def test_row_rules(spark, name, row, rule):
    expected = [] if rule is None else [(rule, str(row[0]))]
    assert broken(frame(spark, name, [row]), name) == expected


def test_row_rules_pass_on_null_and_list_every_broken_rule(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, "x", 0, 1900)],
        "id_avion long, model string, capacitate long, an_fabricatie int",
    )
    assert broken(df, "avion") == [("aircraft_capacity", "2"), ("aircraft_year", "2")]
    missing = ic.check_not_null(df, "avion", "id_avion", ["model", "capacitate"])
    assert rows(missing, "key", "detail") == [("1", "capacitate"), ("1", "model")]


def test_unique_ignores_all_null_keys(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, None), (1, None), (1, 2)], "a int, b int")
    assert [(r.key, r.detail) for r in ic.check_unique(df, "t", ["a", "b"]).collect()] == [("1|", "2")]
    assert [r.key for r in ic.check_unique(df, "t", ["a"]).collect()] == ["1"]


def test_duplicate_iso_is_caught_by_uniqueness(spark):
    countries = frame(spark, "tara", [(1, "Romania", "RO"), (9901, "TestTara", "RO")])
    assert [r.key for r in ic.check_unique(countries, "tara", ["cod_iso_2"]).collect()] == ["RO"]


def test_foreign_keys_between_sites(spark):
    sites = catalog(spark)
    new = frame(spark, "rezervare", [booking(9940, user=99999), booking(9942, user=1)])
    found = ic.check_fk_site(new, "rezervare_eu", "id_rezervare", "id_user", sites, "AM", "utilizator_sec", "id_user")
    assert rows(found, "key", "detail") == [("9940", "99999")]
    tickets = frame(spark, "bilet", [ticket(2, 9960, 1, 88888), ticket(4, 9960, 1, 1, letter="B")])
    found = ic.check_fk_site(tickets, "bilet_eu", "id_bilet", "id_pasager", sites, "AM", "pasager", "id_pasager")
    assert rows(found, "key", "detail") == [("2", "88888")]
    # An update towards an unknown passenger is found the same way; a NULL passes.
    moved = tickets.filter("id_bilet = 4").withColumn("id_pasager", F.lit(88888).cast("long"))
    assert ic.check_fk_site(moved, "b", "id_bilet", "id_pasager", sites, "AM", "pasager", "id_pasager").count() == 1
    unknown = moved.withColumn("id_pasager", F.lit(None).cast("long"))
    assert ic.check_fk_site(unknown, "b", "id_bilet", "id_pasager", sites, "AM", "pasager", "id_pasager").count() == 0


def test_seat_is_unique_over_sites(spark):
    sites = catalog(spark, tickets=[ticket(1, 9971, 1, 1, row=15, letter="C"), ticket(3, 9971, 1, 2, row=15, letter="C")])
    parts = {s: sites.table(s, f"bilet_{s.lower()}") for s in ("AM", "EU")}
    new = frame(spark, "bilet", [ticket(2, 9970, 1, 1, row=15, letter="C"), ticket(4, 9970, 1, 1, row=15, letter="D"),
                                 ticket(6, 9970, 1, 1, row=15, letter="D")])
    clash = ic.check_unique_sites(new, "EU", parts, "bilet_eu", "id_bilet", SEAT)
    assert rows(clash, "key", "detail") == [("2", "1|15|C")], "repeats at one site are not seen"
    everywhere = ic.check_unique_sites(new, "EU", parts, "bilet", "id_bilet", SEAT, mode="global")
    assert rows(everywhere, "key", "detail") == [("1|15|C", "3"), ("1|15|D", "2")]
    with pytest.raises(ValueError):
        ic.check_unique_sites(new, "EU", parts, "bilet", "id_bilet", SEAT, mode="x")


@pytest.mark.parametrize("site, row", [("AM", (9901, "EU")), ("EU", (9901, "AM"))])
def test_row_of_another_fragment(spark, site, row):
    df = spark.createDataFrame([row, (9903, site), (9905, None)], "id_rezervare long, regiune_vanzare string")
    found = ic.check_fragment(df, f"rezervare_{site}", "id_rezervare", F.col("regiune_vanzare") == site)
    assert [r.key for r in found.collect()] == ["9901"]


def test_unique_over_views(spark):
    sites = catalog(spark, bookings=[booking(1), booking(2)])
    assert ic.check_unique(view_vertical(sites), "v_utilizator", ["email"]).count() == 0
    sites.register("EU", "rezervare_eu", sites.table("AM", "rezervare_am"))
    found = ic.check_unique(view_horizontal(sites, "rezervare"), "v_rezervare", ["id_rezervare"])
    assert [r.key for r in found.collect()] == ["1"]


def test_report_lists_all_rules_in_order(spark):
    sites = catalog(
        spark, bookings=[booking(1), booking(2, user=77)], payments=[payment(2, 2), payment(4, 6)],
        tickets=[ticket(1, 1, 1, 1), ticket(2, 2, 1, 1)],
    )
    sites.register("EU", "avion", frame(spark, "avion", [*AIRCRAFT, (3, "YR-AAA", "M", 0, 1930)]))
    tables, rules = ic.site_rules(sites, "EU")
    report = ic.rule_report(tables, rules).collect()
    keys = [(r.name, r.kind, r.rule) for r in report]
    assert keys == sorted(keys) and len(keys) == len(set(keys)) == len(rules)
    bad = {(r.name, r.rule): r.violations for r in report if r.status == "VIOLATED"}
    assert bad == {
        ("avion", "aircraft_capacity"): 1,
        ("avion", "aircraft_year"): 1,
        ("avion", "unique_numar_inmatriculare"): 1,
        ("rezervare_eu", "fk_site_id_user"): 1,
        ("plata_eu", "fk_id_rezervare"): 1,
        ("bilet_eu", "unique_seat_sites"): 1,
    }
    # The central site has the passenger and security rules; the copy's profile has no parent there.
    central, rules = ic.site_rules(sites, "AM")
    assert {"pasager", "utilizator_sec"} <= set(central)
    assert any(r.table == "utilizator_data" and r.kind == "fk" for r in rules)


def test_report_reads_each_table_once(spark, tmp_path):
    spark.range(6).selectExpr("id", "id % 3 AS parent", "CAST(id AS STRING) AS a", "CAST(NULL AS STRING) AS b").write.parquet(
        f"{tmp_path}/child"
    )
    spark.range(1, 3).selectExpr("CAST(id AS INT) AS pk").write.parquet(f"{tmp_path}/parent")
    child, parent = spark.read.parquet(f"{tmp_path}/child"), spark.read.parquet(f"{tmp_path}/parent")
    held = ic.Keys("parent", parent, ("pk",))
    rules = [
        ic.Rule("positive", "child", "check", lambda: F.col("id") > 0),
        ic.Rule("unique_id", "child", "unique", own=ic.Keys("child", child, ("id",))),
        ic.Rule("unique_parent", "child", "unique", own=ic.Keys("child", child, ("parent",))),
        ic.Rule("unique_a_b", "child", "unique", own=ic.Keys("child", child, ("a", "b"))),
        ic.Rule("unique_b", "child", "unique", own=ic.Keys("child", child, ("b",))),
        ic.Rule("fk_parent", "child", "fk", own=ic.Keys("child", child, ("parent",)), other=(held,)),
        ic.Rule("absent", "child", "unique_site", own=ic.Keys("child", child, ("parent",)), other=(held,), present=True),
        ic.Rule("unique_pk", "parent", "unique", own=held),
    ]
    report = ic.rule_report({"child": child, "parent": parent}, rules)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert {r.rule: r.violations for r in report.collect()} == {
        "positive": 1, "unique_id": 0, "unique_parent": 3, "unique_a_b": 0, "unique_b": 0, "fk_parent": 2,
        "absent": 4, "unique_pk": 0,
    }
    with pytest.raises(ValueError, match="differ in type"):
        ic.SharedRules({"child": child}, [
            ic.Rule("fk_a", "child", "fk", own=ic.Keys("child", child, ("a",)), other=(held,))
        ])


def test_report_of_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, parent long")
    own = ic.Keys("t", empty, ("parent",))
    rules = [ic.Rule("fk_parent", "t", "fk", own=own, other=(ic.Keys("t", empty, ("id",)),)),
             ic.Rule("required", "t", "not_null", lambda: F.col("id").isNotNull())]
    assert [(r.rule, r.violations, r.status) for r in ic.rule_report({"t": empty}, rules).collect()] == [
        ("fk_parent", 0, "OK"), ("required", 0, "OK")
    ]


def test_kept_counts_follow_batches(spark):
    def table(rows):
        return spark.createDataFrame(rows, "id long, parent long")

    parents = spark.createDataFrame([(1,), (2,)], "pk long")
    start = table([(1, 1), (2, 9), (3, None), (None, 1)])

    def rules(child):
        held, own = ic.Keys("parents", parents, ("pk",)), ic.Keys("child", child, ("parent",))
        return [
            ic.Rule("required", "child", "not_null", lambda: F.col("id").isNotNull()),
            ic.Rule("unique_id", "child", "unique", own=ic.Keys("child", child, ("id",))),
            ic.Rule("fk", "child", "fk", own=own, other=(held,)),
            ic.Rule("taken", "child", "unique_site", own=own, other=(held,), present=True),
        ]

    def full(child):
        return sorted(r[:4] for r in ic.rule_report({"child": child}, rules(child)).collect())

    kept = ic.keep_counts({"child": start}, rules(start), folders=8)
    assert sorted(kept.report().collect()) == full(start)
    batches = [  # moved to another parent and inserted; the null key mended, a repeated key; nothing; all gone
        ([(2, 9)], [(2, 2), (4, 9), (4, 9)]),
        ([(None, 1)], [(1, 1)]),
        ([], []),
        ([(1, 1), (1, 1), (2, 2), (3, None), (4, 9), (4, 9)], []),
    ]
    rows = [tuple(r) for r in start.collect()]
    for before, after in batches:
        kept = ic.move_counts(kept, "child", table(before), table(after))
        for row in before:
            rows.remove(row)
        rows += after
        assert sorted(kept.report().collect()) == full(table(rows))


def test_kept_counts_read_only_folders_of_the_batch(spark):
    child = spark.range(1000).selectExpr("id")
    rules = [ic.Rule("unique_id", "child", "unique", own=ic.Keys("child", child, ("id",)))]
    kept = ic.keep_counts({"child": child}, rules, folders=16)
    assert kept.counts.select("spread").distinct().count() == 16
    delta = kept.counts.where("number = 7")
    plan = kept.counts.join(F.broadcast(delta), "spread", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
