"""A small airline: two sites, three flights, a few users, and rows made on the spot."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from sitefold.sources.schema import RELATIONS, USER_FRAGMENTS, table_schema
from sitefold.sources.sites import SiteCatalog

AS_OF = "2026-01-11 12:00:00"


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, name, rows):
    schema, _ = table_schema(name)
    return spark.createDataFrame(rows, schema)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


COUNTRIES = [(1, "Romania", "RO"), (2, "United States", "US"), (3, "France", "FR")]
CITIES = [(1, 1, "Bucuresti"), (2, 2, "New York"), (3, 3, "Paris")]
AIRPORTS = [(1, 1, "OTP", "North"), (2, 2, "JFK", "East"), (3, 3, "CDG", "West")]
AIRCRAFT = [(1, "YR-AAA", "Boeing 737-800", 189, 2015), (2, "YR-BBB", "ATR 72-600", 8, 2019)]


def flight(key, aircraft, dep, arr, price, status="PROGRAMAT", leaves="2026-02-01 08:00:00"):
    return (
        key, aircraft, dep, arr, f"RO{100 + key}", ts(leaves), ts("2026-03-01 00:00:00"), None, None, 120,
        money(price), status,
    )


FLIGHTS = [
    flight(1, 1, 1, 2, 100), flight(2, 2, 2, 3, 200), flight(3, 1, 1, 3, 50, "ANULAT"),
    flight(4, 1, 1, 2, 80, leaves="2026-01-20 06:30:00"),
]
PASSENGERS = [
    (i, f"Pop{i}", f"Ion{i}", ts("1980-01-01 10:00:00"), f"XY{i}", nat)
    for i, nat in enumerate(["RO", "RO", "FR", "US", "FR", "DE"], start=1)
]
USERS = [
    (i, f"Stan{i}", f"Ana{i}", f"ana{i}@example.com", "pw", None if i == 2 else f"07{i}",
     ts("2020-05-05 01:02:03"), "ADMIN" if i == 3 else "CLIENT")
    for i in range(1, 5)
]


def booking(key, user=1, when="2025-12-01 10:00:00", total=100, status="CONFIRMATA"):
    return (key, user, ts(when), "AM" if key % 2 else "EU", money(total), status)


def payment(key, owner, amount=100, status="ACCEPTATA", when="2025-12-01 10:00:00"):
    return (key, owner, money(amount), ts(when), "CARD", status)


def ticket(key, owner, on, passenger, row=1, letter="A", price=100, travel="ECONOMY"):
    return (key, owner, on, passenger, row, letter, travel, money(price))


def catalog(spark, root=None, bookings=(), payments=(), tickets=(), flights=None) -> SiteCatalog:
    """Both sites with the given split rows, each at the site of its booking's key."""
    out = SiteCatalog(spark, root)
    users = frame(spark, "utilizator", USERS)
    for site in ("AM", "EU"):
        for name, rows in (("tara", COUNTRIES), ("oras", CITIES), ("aeroport", AIRPORTS), ("avion", AIRCRAFT),
                           ("zbor", FLIGHTS if flights is None else flights)):
            out.register(site, name, frame(spark, name, rows))
        out.register(site, "utilizator_data", users.select("id_user", *USER_FRAGMENTS["utilizator_data"]))
        odd = site == "AM"
        for name, rows, owner in (("rezervare", bookings, 0), ("plata", payments, 1), ("bilet", tickets, 1)):
            own = [r for r in rows if bool(r[owner] % 2) == odd]
            out.register(site, f"{name}_{site.lower()}", frame(spark, name, own))
    out.register("AM", "pasager", frame(spark, "pasager", PASSENGERS))
    out.register("AM", "utilizator_sec", users.select("id_user", *USER_FRAGMENTS["utilizator_sec"]))
    return out


def publish(spark, root, *names, **split) -> SiteCatalog:
    """The same world with the tables called ``names`` published; the others are registered."""
    out = catalog(spark, root, **split)
    tables = {}
    for site, name in list(out._registered):
        base = name.removesuffix("_am").removesuffix("_eu")
        if base in names:
            key = "id_user" if base in USER_FRAGMENTS else RELATIONS[base].key
            tables[site, name] = (out.table(site, name), key)
    out.publish(tables, buckets=4)
    for place in tables:
        del out._registered[place]
    return out


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
