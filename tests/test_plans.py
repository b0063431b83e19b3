from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F
from world import AS_OF, booking, catalog, payment, publish, rows, ticket

from sitefold.plans import booking as bk
from sitefold.plans import reports as rp

REPORT = ["id_zbor", "total_bilete", "venit_total", "nationalitate_predominanta"]


def sales(spark, **extra):
    return catalog(
        spark,
        bookings=[booking(1), booking(2), booking(3, when="2025-07-11 11:59:59"), booking(4, when="2025-07-11 12:00:00"),
                  booking(5)],
        payments=[payment(1, 1), payment(3, 1), payment(2, 2), payment(5, 3), payment(4, 4), payment(7, 5, status="RESPINSA")],
        tickets=[
            ticket(1, 1, 1, 1, price=10), ticket(3, 1, 1, 3, row=2, price=20),  # booking 1 is paid twice
            ticket(2, 2, 2, 3, price=500), ticket(5, 3, 1, 1, row=3, price=999), ticket(4, 4, 2, 4, row=4, price=1),
            ticket(7, 5, 3, 1, price=999),
        ],
        **extra,
    )


def test_report_by_mode(spark):
    got = rp.report_routes(sales(spark), AS_OF).collect()
    # Flight 2: 501; flight 1: (10 + 20) twice. The booking one second too old and the
    # refused payment do not count; the tie RO/FR of flight 1 and FR/US of flight 2 shows the lowest.
    assert [tuple(r[c] for c in REPORT) for r in got] == [
        (2, 2, Decimal("501.00"), "FR"), (1, 4, Decimal("60.00"), "FR"),
    ]
    assert [float(r.rata_ocupare_pct) for r in got] == [25.0, 2.12]
    assert (got[1].iata_plecare, got[1].iata_sosire, got[1].tara_plecare, got[1].tara_sosire) == (
        "OTP", "JFK", "Romania", "United States")


def test_report_by_rank_keeps_ties(spark):
    got = rp.report_routes_ranked(sales(spark), AS_OF).collect()
    assert [(r.id_zbor, r.total_bilete, r.nationalitate_predominanta) for r in got] == [
        (2, 2, "FR"), (2, 2, "US"), (1, 4, "FR"), (1, 4, "RO"),
    ]


def test_ranked_report_counts_tickets_without_a_passenger(spark):
    sites = sales(spark)
    sites.register("AM", "pasager", sites.table("AM", "pasager").filter("id_pasager <> 3"))
    ranked = rp.report_routes_ranked(sites, AS_OF).collect()
    assert [(r.id_zbor, r.total_bilete, float(r.venit_total), r.nationalitate_predominanta) for r in ranked] == [
        (2, 2, 501.0, "US"), (1, 4, 60.0, "RO"),
    ]
    by_mode = rp.report_routes(sites, AS_OF).collect()
    assert [(r.id_zbor, r.total_bilete) for r in by_mode] == [(1, 2), (2, 1)]


def test_report_is_limited_and_window_moves(spark):
    assert rp.report_routes(sales(spark), AS_OF, k=1).count() == 1
    assert rp.report_routes(sales(spark), "2026-07-05 00:00:00").count() == 0


def test_report_filters_reach_the_scan(spark, root):
    sites = publish(
        spark, root, "rezervare", "plata", "bilet", bookings=[booking(1), booking(2)], payments=[payment(1, 1), payment(2, 2)],
        tickets=[ticket(1, 1, 1, 1), ticket(2, 2, 1, 1)],
    )
    plan = rp.report_routes(sites, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_rezervare,2025-07-11T12:00)" in plan
    assert "EqualTo(status,ACCEPTATA)" in plan
    assert "parola" not in plan and "numar_rand" not in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_pick_lists(spark):
    sites = catalog(spark)
    assert [tuple(r) for r in rp.list_departures(sites).collect()] == [(1, "Bucuresti (OTP)"), (2, "New York (JFK)")]
    assert [tuple(r) for r in rp.list_arrivals(sites, 1, "EU").collect()] == [(2, "New York (JFK)")]
    flights = rp.list_flights(sites, 1, 2).collect()
    assert [(r.id_zbor, r.label, r.model) for r in flights] == [
        (4, "RO104 | 2026-01-20 06:30", "Boeing 737-800"), (1, "RO101 | 2026-02-01 08:00", "Boeing 737-800"),
    ]


def test_listings(spark):
    sites = catalog(
        spark, bookings=[booking(i, user=1 + i % 4, status="ANULATA" if i == 9 else "CONFIRMATA") for i in range(1, 40)],
        payments=[payment(i, i) for i in range(1, 40)],
        tickets=[ticket(i, i, 1, 1) for i in range(1, 40)],
    )
    assert [r.id_plata for r in rp.latest(sites.table("EU", "plata_eu"), "id_plata", 3).collect()] == [38, 36, 34]
    history = rp.booking_history(sites, "AM").collect()
    assert len(history) == 15 and history[0].id_rezervare == 39 and history[0].client == "Stan4 Ana4"
    tickets = rp.global_tickets(sites, 2).collect()
    assert [(r.id_bilet, r.regiune, r.status_rezervare) for r in tickets] == [(39, "AM", "CONFIRMATA"), (38, "EU", "CONFIRMATA")]
    assert [r.id_user for r in rp.global_users(sites, 3).collect()] == [1, 2, 3]
    assert [r.id_zbor for r in rp.latest_flights(sites).collect()][-1] == 4
    assert 9 not in [r.id_rezervare for r in rp.active_bookings(sites, 100).collect()]
    assert rows(rp.site_status(sites, "AM", [9])) == [(9, "ANULATA", "ACCEPTATA")]
    assert rows(rp.site_status(sites, "EU", [9])) == [], "the other site does not own it"
    assert rows(rp.lookup(sites, "EU", "zbor", "id_zbor", 2), "numar_zbor") == [("RO102",)]


# --- booking ---------------------------------------------------------------------------

REQUEST = "request_id long, id_user long, id_zbor long, id_pasager long, numar_rand long, litera_scaun string, clasa string"
REQUESTS = [
    (1, 1, 1, 1, 15, "C", "ECONOMY"),  # taken at AM
    (2, 1, 1, 1, 16, "C", "BUSINESS"),  # booked
    (3, 2, 1, 2, 16, "C", "ECONOMY"),  # the same seat, later
    (4, 99999, 1, 1, 17, "C", "ECONOMY"),
    (5, 1, 1, 88888, 18, "C", "ECONOMY"),
    (6, 1, 77, 1, 18, "C", "ECONOMY"),
    (7, 1, 2, 1, 19, "A", "ECONOMY"),  # the small aircraft has 18 rows
    (8, 99999, 1, 1, 20, "D", "ECONOMY"),
    (9, 3, 1, 4, 20, "D", "ECONOMY"),  # free, because the request before is refused
    (10, 1, 1, 1, 21, "D", "FIRST"),
    (11, 1, 1, 1, 21, None, "ECONOMY"),
]


def test_booking_batch(spark, root):
    sites = publish(
        spark, root, "rezervare", "plata", "bilet", bookings=[booking(1), booking(2), booking(56)], payments=[payment(4, 56)],
        tickets=[ticket(1, 1, 1, 1, row=15, letter="C"), ticket(10, 56, 1, 1, row=1)],
    )
    booked = bk.book(sites, spark.createDataFrame(REQUESTS, REQUEST), "EU", AS_OF)
    assert {r.request_id: r.reason for r in booked.refused.collect()} == {
        1: "seat taken", 3: "seat taken", 4: "unknown user", 5: "unknown passenger", 6: "unknown flight",
        7: "no such seat", 8: "unknown user", 10: "unknown class", 11: "no such seat",
    }
    assert rows(booked.bookings, "id_rezervare", "id_user", "regiune_vanzare", "total_de_plata", "status") == [
        (58, 1, "EU", Decimal("150.00"), "CONFIRMATA"), (60, 3, "EU", Decimal("100.00"), "CONFIRMATA"),
    ]
    assert rows(booked.payments, "id_plata", "id_rezervare", "suma_achitata", "metoda_plata", "status") == [
        (6, 58, Decimal("150.00"), "CARD", "ACCEPTATA"), (8, 60, Decimal("100.00"), "CARD", "ACCEPTATA"),
    ]
    assert rows(booked.tickets, "id_bilet", "id_rezervare", "numar_rand", "litera_scaun") == [
        (12, 58, 16, "C"), (14, 60, 20, "D"),
    ]
    bk.publish_booked(sites, "EU", booked, tag="day 1")
    assert sites.table("EU", "rezervare_eu").count() == 4
    assert sites.table("EU", "bilet_eu").count() == 3
    assert sites.table("AM", "bilet_am").count() == 1
    # The same requests again: every seat is taken now.
    again = bk.book(sites, spark.createDataFrame(REQUESTS, REQUEST), "AM", AS_OF)
    assert again.bookings.count() == 0


def test_only_tickets_of_wanted_seats_are_searched(spark, monkeypatch):
    wanted = spark.createDataFrame(REQUESTS, REQUEST).filter("litera_scaun IS NOT NULL")
    sold = spark.range(20_000).selectExpr("1 + id % 4 AS id_zbor", "1 + id AS numar_rand", "'C' AS litera_scaun")
    sold = sold.unionByName(sold.limit(5).selectExpr("id_zbor", "CAST(NULL AS LONG) AS numar_rand", "litera_scaun"))
    hit = {tuple(r) for r in sold.join(wanted.select(*bk.SEAT), bk.SEAT, "left_semi").collect()}
    found = bk._for_seats(sold, wanted)
    assert hit and hit <= {tuple(r) for r in found.collect()} and found.count() < 20
    # A table of bits that is full drops nothing, and hashes of other types are not compared.
    other = sold.withColumn("numar_rand", F.col("numar_rand").cast("int"))
    assert {tuple(r) for r in bk._for_seats(other, wanted).collect()} == hit
    monkeypatch.setattr(bk, "SEAT_WORDS", 1)
    many = wanted.select(*bk.SEAT).unionByName(sold.limit(3000))
    assert {tuple(r) for r in bk._for_seats(sold, many).collect()} == {tuple(r) for r in sold.collect()}
    sites = catalog(spark, tickets=[ticket(1, 1, 1, 1, row=15, letter="C")])
    assert {r.request_id for r in bk.book(sites, wanted, "EU", AS_OF).bookings.join(wanted, "id_user").collect()} >= {2, 9}


def test_repeated_requests_and_requests_without_an_id(spark):
    twice = [(2, 1, 1, 1, 16, "C", "ECONOMY")] * 2 + [(3, 1, 1, 1, 16, "C", "ECONOMY"), (None, 1, 1, 1, 16, "C", "ECONOMY")]
    alone = [(None, 1, 1, 1, 17, "C", "ECONOMY"), (None, 1, 1, 1, 15, "C", "ECONOMY")]
    sites = catalog(spark, tickets=[ticket(1, 1, 1, 1, row=15, letter="C"), ticket(3, 1, 1, 2, row=15, letter="C")])
    got = bk.review(sites, spark.createDataFrame(twice + alone, REQUEST))
    assert sorted(map(str, got.select("request_id", "numar_rand", "reason").collect())) == sorted(map(str, [
        *[Row(request_id=2, numar_rand=16, reason=None)] * 2, Row(request_id=3, numar_rand=16, reason="seat taken"),
        Row(request_id=None, numar_rand=16, reason=None), Row(request_id=None, numar_rand=17, reason=None),
        Row(request_id=None, numar_rand=15, reason="seat taken"),
    ]))


def test_first_keys_of_an_empty_site(spark):
    booked = bk.book(catalog(spark), spark.createDataFrame(REQUESTS[1:2], REQUEST), "AM", AS_OF)
    assert rows(booked.tickets, "id_bilet", "id_rezervare") == [(1, 1)]


def test_totals_states_and_statuses(spark):
    sites = catalog(spark, tickets=[ticket(1, 1, 1, 1, price="10.10"), ticket(3, 1, 3, 1, price="5.05"), ticket(2, 2, 3, 1, price=7)])
    tickets = sites.table("AM", "bilet_am").unionByName(sites.table("EU", "bilet_eu"))
    totals = bk.booking_total(tickets)
    assert rows(totals, "id_rezervare", "total_de_plata") == [(1, Decimal("15.15")), (2, Decimal("7.00"))]
    states = bk.derive_states(tickets, sites.table("AM", "zbor"))
    assert rows(states, "id_bilet", "status_rezervare", "status_plata") == [
        (1, "CONFIRMATA", "ACCEPTATA"), (2, "ANULATA", "RAMBURSATA"), (3, "ANULATA", "RAMBURSATA"),
    ]
    flights = bk.with_status(sites.table("AM", "zbor").withColumn("off", F.lit(False)), "off", "2026-01-25 00:00:00")
    assert dict(rows(flights, "id_zbor", "status"))[4] == "ATERIZAT"
    assert dict(rows(flights, "id_zbor", "status"))[1] == "PROGRAMAT"
    seats = bk.seat_validity(tickets, sites.table("AM", "zbor"), sites.table("AM", "avion"))
    assert all(r.seat_ok for r in seats.collect())


def test_latest_rows_without_partner_do_not_shorten_the_list(spark):
    # The newest tickets have no booking: the short way finds too few rows, the whole join helps.
    sites = catalog(spark, bookings=[booking(i) for i in range(1, 6)], tickets=[ticket(i, i, 1, 1) for i in range(1, 120)])
    got = rp.global_tickets(sites, 4).collect()
    assert [r.id_bilet for r in got] == [5, 4, 3, 2]


def test_cancel_in_published_tables(spark, root):
    sites = publish(
        spark, root, "rezervare", "plata", bookings=[booking(i) for i in (1, 2, 3)],
        payments=[payment(1, 1), payment(3, 1), payment(2, 2), payment(5, 3)],
    )
    before = sites.table("AM", "plata_am")
    version = bk.publish_cancelled(sites, spark.createDataFrame([(1,), (2,), (50,)], "id_rezervare long"))
    assert rows(sites.table("AM", "rezervare_am"), "id_rezervare", "status") == [(1, "ANULATA"), (3, "CONFIRMATA")]
    assert rows(sites.table("AM", "plata_am"), "id_plata", "status") == [
        (1, "RAMBURSATA"), (3, "RAMBURSATA"), (5, "ACCEPTATA")]
    assert rows(sites.table("EU", "plata_eu"), "status") == [("RAMBURSATA",)]
    assert {r.status for r in before.collect()} == {"ACCEPTATA"}
    assert version == 2
