"""Guarded writes: what each rule refuses, and what reaches the published table."""

import pytest
from world import booking, catalog, frame, payment, publish, rows, ticket

from sitefold.operators import admission as ad


def batch(spark, name, values):
    """Rows of a relation, numbered in the order given."""
    made = [frame(spark, name, [v]).selectExpr(f"{k} AS seq", "*") for k, v in enumerate(values, start=1)]
    out = made[0]
    for part in made[1:]:
        out = out.unionByName(part)
    return out


def refused(admitted):
    return rows(admitted.refused, "seq", "rule", "error")


def world(spark, root, make=publish):
    names = ("rezervare", "plata", "bilet", "tara") if make is publish else ()
    return make(
        spark, root, *names, bookings=[booking(1), booking(2), booking(4)], payments=[payment(2, 2)],
        tickets=[ticket(1, 1, 1, 1, row=1), ticket(2, 2, 2, 1, row=2)],
    )


def test_users_and_passengers_of_the_central_site(spark, root):
    sites = world(spark, root, catalog)
    found = ad.admit(sites, "EU", "rezervare", batch(spark, "rezervare", [booking(6), booking(8, user=99999), booking(7)]))
    assert refused(found) == [(2, "fk_id_user", -20001), (3, "fragment_region", None)]
    assert rows(found.accepted, "id_rezervare") == [(6,)]
    found = ad.admit(sites, "EU", "bilet", batch(spark, "bilet", [ticket(6, 2, 1, 77777, row=9)]))
    assert refused(found) == [(1, "fk_id_pasager", -20002)]


def test_seats_of_both_sites_and_of_the_batch(spark, root):
    sites = world(spark, root, catalog)
    new = [
        ticket(4, 2, 1, 2, row=1),  # sold at AM
        ticket(6, 2, 2, 2, row=2),  # sold here
        ticket(8, 2, 2, 2, row=3), ticket(10, 2, 2, 3, row=3),  # the first gets it
        ticket(12, 2, 2, 2, row=4, letter="Z"), ticket(14, 2, 2, 2, row=4),  # a refused row holds no seat
        ticket(2, 2, 2, 2, row=5), ticket(16, 3, 2, 2, row=6),
    ]
    found = ad.admit(sites, "EU", "bilet", batch(spark, "bilet", new))
    assert refused(found) == [
        (1, "unique_seat_sites", -20004), (2, "unique_id_zbor_numar_rand_litera_scaun", None),
        (4, "unique_id_zbor_numar_rand_litera_scaun_batch", None), (5, "ticket_letter", None),
        (7, "unique_id_bilet", None), (8, "fk_id_rezervare", None),
    ]
    assert rows(found.accepted, "id_bilet") == [(8,), (14,)]
    found = ad.admit(sites, "AM", "bilet", batch(spark, "bilet", [ticket(3, 1, 2, 2, row=2)]))
    assert refused(found) == [(1, "unique_seat_sites", -20003)]


def test_updates_check_what_changed(spark, root):
    sites = world(spark, root)
    moved = batch(spark, "rezervare", [booking(2, user=3), booking(4, user=99999)])
    assert refused(ad.admit(sites, "EU", "rezervare", moved, changed=["status"])) == []
    found = ad.publish_admitted(sites, "EU", "rezervare", moved, changed=["id_user"])
    assert refused(found) == [(2, "fk_id_user", -20001)]
    assert rows(sites.table("EU", "rezervare_eu"), "id_rezervare", "id_user") == [(2, 3), (4, 1)]
    seat = batch(spark, "bilet", [ticket(2, 2, 2, 1, row=2), ticket(2, 2, 1, 1, row=1)])
    assert refused(ad.admit(sites, "EU", "bilet", seat, changed=["id_zbor", "numar_rand"])) == [(2, "unique_seat_sites", -20004)]


def test_publishing_what_is_admitted(spark, root):
    sites = world(spark, root)
    new = batch(spark, "tara", [(9, "Italia", "IT"), (10, "Spania", "es"), (1, "Grecia", "GR"), (11, "Franta", "FR")])
    found = ad.publish_admitted(sites, "AM", "tara", new)
    assert refused(found) == [
        (2, "country_iso", None), (3, "unique_id_tara", None), (4, "unique_cod_iso_2", None),
    ]
    assert (9, "IT") in rows(sites.table("AM", "tara"), "id_tara", "cod_iso_2")
    with pytest.raises(ad.Refused):
        ad.publish_admitted(sites, "AM", "tara", new.filter("seq = 2"), all_or_nothing=True)


def test_what_was_checked_must_not_have_moved(spark, root):
    sites = world(spark, root)
    new = batch(spark, "bilet", [ticket(6, 2, 2, 2, row=7)])
    found = ad.admit(sites, "EU", "bilet", new)
    ad.publish_admitted(sites, "AM", "bilet", batch(spark, "bilet", [ticket(3, 1, 2, 2, row=7)]))
    with pytest.raises(Exception, match="moved after version"):
        sites.publish_changes(
            appends={("EU", "bilet_eu"): found.accepted.drop("seq")}, base=found.base, relied_on=[("AM", "bilet_am")]
        )
