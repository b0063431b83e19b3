"""Reports and listings over the global relations and the sites' tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import (
    asc,
    cat,
    cents,
    fmt_minute,
    from_cents,
    instant,
    months_back,
    occupancy_pct,
)
from sitefold.operators.relational import (
    counts,
    join_chain,
    join_hashed,
    most_frequent,
    rank_counts,
    top_k,
    top_k_join,
)
from sitefold.plans.views import view_horizontal, view_vertical
from sitefold.sources.sites import SiteCatalog, one_version

# --- the route report ------------------------------------------------------------------


def paid_tickets(catalog: SiteCatalog, as_of, months: int = 6) -> DataFrame:
    """Tickets of recent bookings with their number of accepted payments (``paid``).

    A ticket counts once for every accepted payment of its booking. The payments are counted
    per booking first and the count travels as a weight, so a booking with many payments
    multiplies numbers, not rows. Recent bookings and their payments are joined before the
    tickets: both are keyed by booking, and what is left is the small side of the big join.
    """
    since = months_back(instant(as_of), months)
    recent = (
        view_horizontal(catalog, "rezervare")
        .filter(F.col("data_rezervare") >= since)
        .select("id_rezervare")
    )
    accepted = counts(
        view_horizontal(catalog, "plata").filter(F.col("status") == "ACCEPTATA"), ["id_rezervare"], "paid"
    )
    paid = recent.join(accepted, "id_rezervare")
    tickets = view_horizontal(catalog, "bilet").select("id_rezervare", "id_zbor", "id_pasager", "pret_final")
    return tickets.join(paid, "id_rezervare").drop("id_rezervare")


def _sales(tickets: DataFrame, keys: list[str]) -> DataFrame:
    return tickets.groupBy(*keys).agg(
        F.sum("paid").alias("nr_bilete"), F.sum(cents("pret_final") * F.col("paid")).alias("venit_cents")
    )


def _dimensions(catalog: SiteCatalog, per_flight: DataFrame) -> DataFrame:
    """Aircraft and both ends of the flight, joined to the aggregated rows."""
    flights = catalog.table(catalog.master, "zbor").select(
        "id_zbor", "id_avion", "id_aeroport_plecare", "id_aeroport_sosire"
    )
    aircraft = catalog.table(catalog.master, "avion").select("id_avion", "capacitate")
    places = join_chain(
        catalog.table(catalog.master, "aeroport").select("id_aeroport", "id_oras", "cod_iata"),
        [
            (catalog.table(catalog.master, "oras").select("id_oras", "id_tara"), {"id_oras": "id_oras"}),
            (catalog.table(catalog.master, "tara").select("id_tara", "nume_tara"), {"id_tara": "id_tara"}),
        ],
    ).select("id_aeroport", "cod_iata", "nume_tara")

    def end(role: str) -> DataFrame:
        return places.select(
            F.col("id_aeroport").alias(f"_airport_{role}"),
            F.col("cod_iata").alias(f"iata_{role}"),
            F.col("nume_tara").alias(f"tara_{role}"),
        )

    return join_chain(
        per_flight,
        [
            (flights, {"id_zbor": "id_zbor"}),
            (aircraft, {"id_avion": "id_avion"}),
            (end("plecare"), {"id_aeroport_plecare": "_airport_plecare"}),
            (end("sosire"), {"id_aeroport_sosire": "_airport_sosire"}),
        ],
    )


def _route_columns(df: DataFrame, nationality: str) -> DataFrame:
    return df.select(
        "id_zbor",
        "iata_plecare",
        "iata_sosire",
        "tara_plecare",
        "tara_sosire",
        F.col("nr_bilete").alias("total_bilete"),
        from_cents("venit_cents").alias("venit_total"),
        occupancy_pct("nr_bilete", "capacitate").alias("rata_ocupare_pct"),
        F.col(nationality).alias("nationalitate_predominanta"),
    )


@one_version
def report_routes(catalog: SiteCatalog, as_of, k: int = 10, months: int = 6) -> DataFrame:
    """Top ``k`` flights by revenue of accepted payments of the last ``months`` months.

    Ticket count, revenue and predominant nationality come out of one pass over the tickets:
    sales per (flight, nationality) roll up to the flight, and the mode is the nationality
    with most of them. The dimensions are joined to the flights, not to the tickets. The
    lowest of tied nationalities is shown; flights with equal revenue are ordered by key.
    """
    passengers = catalog.table(catalog.master, "pasager").select("id_pasager", "nationalitate")
    tickets = paid_tickets(catalog, as_of, months).join(passengers, "id_pasager")
    by_nationality = _sales(tickets, ["id_zbor", "nationalitate"])
    per_flight = by_nationality.groupBy("id_zbor").agg(
        F.sum("nr_bilete").alias("nr_bilete"),
        F.sum("venit_cents").alias("venit_cents"),
        most_frequent("nationalitate", "nr_bilete").alias("nationalitate_predominanta"),
    )
    routes = _route_columns(_dimensions(catalog, per_flight), "nationalitate_predominanta")
    return top_k(routes, [("venit_total", "desc"), "id_zbor"], k)


@one_version
def report_routes_ranked(catalog: SiteCatalog, as_of, k: int = 10, months: int = 6) -> DataFrame:
    """The same report with nationalities ranked: tied nationalities give one row each.

    Revenue and ticket count cover all tickets of the flight, the ranking only those whose
    passenger is known; a flight without any drops out. Both come from one pass: the window
    runs over sales per (flight, nationality), so a flight has one row per country code
    there, however many tickets it sold.
    """
    passengers = catalog.table(catalog.master, "pasager").select(
        "id_pasager", "nationalitate", F.lit(True).alias("_known")
    )
    tickets = paid_tickets(catalog, as_of, months).join(passengers, "id_pasager", "left")
    flight = Window.partitionBy("id_zbor")
    ranked = (
        _sales(tickets, ["id_zbor", "nationalitate", "_known"])
        .select(
            "id_zbor",
            "nationalitate",
            F.when(F.col("_known"), F.col("nr_bilete")).alias("_own"),
            F.sum("nr_bilete").over(flight).alias("nr_bilete"),
            F.sum("venit_cents").over(flight).alias("venit_cents"),
        )
        .withColumn("_rank", F.rank().over(flight.orderBy(F.col("_own").desc_nulls_last())))
        .filter(F.col("_own").isNotNull() & (F.col("_rank") == 1))
    )
    routes = _route_columns(_dimensions(catalog, ranked), "nationalitate")
    return top_k(routes, [("venit_total", "desc"), "id_zbor", "nationalitate_predominanta"], k)


@one_version
def nationality_ranks(catalog: SiteCatalog) -> DataFrame:
    """Nationalities of each flight's passengers with count and rank (ties share a rank)."""
    passengers = catalog.table(catalog.master, "pasager").select("id_pasager", "nationalitate")
    tickets = view_horizontal(catalog, "bilet").select("id_zbor", "id_pasager")
    return rank_counts(tickets.join(passengers, "id_pasager"), "id_zbor", "nationalitate")


@one_version
def route_dimensions_hashed(catalog: SiteCatalog, per_flight: DataFrame) -> DataFrame:
    """Flight and aircraft joined to aggregated rows by hash joins, in the written order."""
    return join_hashed(
        per_flight,
        [
            (catalog.table(catalog.master, "zbor").select("id_zbor", "id_avion"), {"id_zbor": "id_zbor"}),
            (catalog.table(catalog.master, "avion").select("id_avion", "capacitate"), {"id_avion": "id_avion"}),
        ],
    )


# --- pick lists ------------------------------------------------------------------------


def _airport_labels(catalog: SiteCatalog, site: str) -> DataFrame:
    airports = catalog.table(site, "aeroport").select("id_aeroport", "id_oras", "cod_iata")
    cities = catalog.table(site, "oras").select("id_oras", "nume_oras")
    label = cat("nume_oras", F.lit(" ("), "cod_iata", F.lit(")"))
    return airports.join(cities, "id_oras").select("id_aeroport", label.alias("label"))


def _ends(catalog: SiteCatalog, site: str, flights: DataFrame, fk: str) -> DataFrame:
    # Distinct airports before the join: the flights collapse to at most the airports.
    airports = flights.select(F.col(fk).alias("id_aeroport")).distinct()
    return airports.join(_airport_labels(catalog, site), "id_aeroport").orderBy(asc("label"), "id_aeroport")


def _scheduled(catalog: SiteCatalog, site: str) -> DataFrame:
    return catalog.table(site, "zbor").filter(F.col("status") == "PROGRAMAT")


@one_version
def list_departures(catalog: SiteCatalog, site: str = "AM") -> DataFrame:
    """Airports that a scheduled flight leaves from, as (id, "City (IATA)")."""
    return _ends(catalog, site, _scheduled(catalog, site), "id_aeroport_plecare")


@one_version
def list_arrivals(catalog: SiteCatalog, departure: int, site: str = "AM") -> DataFrame:
    """Airports a scheduled flight reaches from one departure."""
    flights = _scheduled(catalog, site).filter(F.col("id_aeroport_plecare") == departure)
    return _ends(catalog, site, flights, "id_aeroport_sosire")


@one_version
def list_flights(catalog: SiteCatalog, departure: int, arrival: int, site: str = "AM") -> DataFrame:
    """Scheduled flights of a route with a time label, price and aircraft model."""
    flights = _scheduled(catalog, site).filter(
        (F.col("id_aeroport_plecare") == departure) & (F.col("id_aeroport_sosire") == arrival)
    )
    aircraft = catalog.table(site, "avion").select("id_avion", "model")
    return (
        flights.join(aircraft, "id_avion")
        .orderBy(asc("data_plecare"), "id_zbor")
        .select(
            "id_zbor",
            cat("numar_zbor", F.lit(" | "), fmt_minute("data_plecare")).alias("label"),
            "pret_standard",
            "model",
        )
    )


# --- listings --------------------------------------------------------------------------


def latest(table: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the highest keys."""
    return top_k(table, [(key, "desc")], k)


@one_version
def booking_history(catalog: SiteCatalog, site: str, k: int = 15) -> DataFrame:
    """Latest bookings of a site with the client's name."""
    bookings = catalog.table(site, f"rezervare_{site.lower()}")
    users = catalog.table(site, "utilizator_data").select(
        "id_user", cat("nume", F.lit(" "), "prenume").alias("client")
    )
    return top_k_join(bookings, users, "id_user", [("id_rezervare", "desc")], k).select(
        *bookings.columns, "client"
    )


@one_version
def global_tickets(catalog: SiteCatalog, k: int = 100) -> DataFrame:
    """Latest tickets of all sites with region and status of their booking."""
    bookings = view_horizontal(catalog, "rezervare").select(
        "id_rezervare", F.col("regiune_vanzare").alias("regiune"), F.col("status").alias("status_rezervare")
    )
    tickets = view_horizontal(catalog, "bilet")
    rest = [c for c in tickets.columns if c != "id_bilet"]
    return top_k_join(tickets, bookings, "id_rezervare", [("id_bilet", "desc"), *rest], k).select(
        *tickets.columns, "regiune", "status_rezervare"
    )


@one_version
def global_users(catalog: SiteCatalog, k: int = 50) -> DataFrame:
    return top_k(view_vertical(catalog), ["id_user"], k)


@one_version
def latest_flights(catalog: SiteCatalog, k: int = 50) -> DataFrame:
    return top_k(catalog.synonym("zbor"), [("data_plecare", "desc"), "id_zbor"], k)


@one_version
def active_bookings(catalog: SiteCatalog, k: int = 10) -> DataFrame:
    """Latest bookings, of any site, that are not cancelled."""
    bookings = view_horizontal(catalog, "rezervare").filter(F.col("status") != "ANULATA")
    return latest(
        bookings.select("id_rezervare", F.col("regiune_vanzare").alias("regiune"), "status"), "id_rezervare", k
    )


@one_version
def site_status(catalog: SiteCatalog, site: str, bookings: list[int] | None = None) -> DataFrame:
    """Booking and payment status at one site; empty when the site does not own the booking."""
    tail = site.lower()
    own = catalog.table(site, f"rezervare_{tail}")
    if bookings is not None:
        own = own.filter(F.col("id_rezervare").isin(bookings))
    payments = catalog.table(site, f"plata_{tail}").select("id_rezervare", F.col("status").alias("status_plata"))
    return own.select("id_rezervare", F.col("status").alias("status_rez")).join(payments, "id_rezervare")


@one_version
def lookup(catalog: SiteCatalog, site: str, name: str, key: str, value) -> DataFrame:
    """The row of a site's table with a given key."""
    return catalog.table(site, name).filter(F.col(key) == F.lit(value))


