"""One Spark query per operator of the inventory, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sitefold.functions as fn
from driver_roles import AS_OF, Tables
from sitefold.operators import changes as ch
from sitefold.operators import design as ds
from sitefold.operators import fragment as fr
from sitefold.operators import integrity as ic
from sitefold.operators import keys as ks
from sitefold.operators import relational as rl
from sitefold.operators import admission as ad
from sitefold.plans import booking as bk
from sitefold.plans import reports as rp
from sitefold.plans import views as vw
from sitefold.session import fresh_path, materialize
from sitefold.sources import loading as ld
from sitefold.sources.schema import RELATIONS, with_defaults
from sitefold.streaming import replicate as rs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TICKET_ORDER = [
    "id_bilet", "id_zbor", "id_pasager", "numar_rand", "litera_scaun", "clasa", "pret_final",
]
SEAT = ["id_zbor", "numar_rand", "litera_scaun"]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(Tables(spark, sf_dir)))
    return function


def by_site(parts: dict[str, DataFrame], column: str = "site") -> DataFrame:
    return vw.union_fragments(*[df.withColumn(column, F.lit(site)) for site, df in parts.items()])


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_typed(t: Tables) -> DataFrame:
    schema = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_totalprice decimal(10,2), o_orderdate timestamp_ntz"
    )
    return ld.load_table(t.spark, f"{t.sf_dir}/orders.parquet", schema)


@query
def scan_site(t: Tables) -> DataFrame:
    return t.catalog().table("EU", "zbor")


@query
def synonym_scan(t: Tables) -> DataFrame:
    return t.catalog().synonym("avion")


@query
def replicate_full(t: Tables) -> DataFrame:
    catalog = vw.SiteCatalog(t.spark, fresh_path(t.spark, "sites"))
    fr.replicate(catalog, ["AM", "EU"], "zbor", t.zbor(), "id_zbor")
    return by_site({s: catalog.table(s, "zbor") for s in ("AM", "EU")}).select(
        "site", "id_zbor", "data_plecare", "pret_standard", "status"
    )


@query
def append_rows(t: Tables) -> DataFrame:
    new = t.spark.createDataFrame(
        [(9970001, 1, "2001-08-01 00:00:00", "AM", 350.005, "CONFIRMATA")],
        "id_rezervare long, id_user long, data_rezervare string, regiune_vanzare string, "
        "total_de_plata double, status string",
    )
    return ld.append_rows(t.catalog().table("AM", "rezervare_am"), new)


@query
def insert_if_absent(t: Tables) -> DataFrame:
    # Documents of users in good standing, plus those of clients first seen in a booking.
    known = t.raw("customer").filter("c_acctbal >= 0").select(
        F.concat(F.lit("XY"), F.col("c_custkey").cast("string")).alias("document"),
        F.col("c_custkey").alias("origin"),
    )
    seen = t.raw("orders").select(
        F.concat(F.lit("XY"), F.col("o_custkey").cast("string")).alias("document"),
        F.col("o_orderkey").alias("origin"),
    )
    return ld.insert_if_absent(known, seen, ["document"], first_by="origin")


@query
def fk_lookup(t: Tables) -> DataFrame:
    return ld.resolve_fk(
        t.pasager().select("id_pasager", "nationalitate"), t.aeroport(),
        {"nationalitate": "cod_iata"}, "id_aeroport", "id_aeroport",
    )


@query
def position_lookup(t: Tables) -> DataFrame:
    wanted = t.raw("orders").select("o_orderkey", (F.col("o_custkey") * 2 + 1).alias("position"))
    return ld.resolve_position(wanted, t.zbor(), "position", "id_zbor", "id_zbor")


# --- fragmentation ---------------------------------------------------------------------


def _written_bookings(t: Tables) -> DataFrame:
    """Bookings with their region, joined once: a verification reads them for the source and each fragment."""
    return materialize(t.rezervare(), "bookings")


def _regions() -> dict[str, Column]:
    return {r: F.col("regiune_vanzare") == r for r in ("AM", "EU", "OTHER")}


@query
def fragment_primary_am(t: Tables) -> DataFrame:
    return fr.fragment_horizontal(t.rezervare(), _regions())["AM"]


@query
def fragment_primary_eu(t: Tables) -> DataFrame:
    return fr.fragment_horizontal(t.rezervare(), _regions())["EU"]


@query
def fragment_written(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "fragments")
    fr.write_fragments(t.rezervare(), "regiune_vanzare", path)
    stored = t.spark.read.parquet(path)
    return rl.totals(
        stored, "regiune_vanzare",
        {"bookings": F.count(F.lit(1)), "total": F.sum("total_de_plata").cast("decimal(28,2)")},
    )


@query
def fragment_derived(t: Tables) -> DataFrame:
    owner = fr.fragment_horizontal(t.rezervare(), _regions())["AM"]
    return fr.fragment_derived(t.bilet(), owner, "id_rezervare", "id_rezervare")


@query
def fragment_vertical(t: Tables) -> DataFrame:
    parts = fr.fragment_vertical(
        t.utilizator(), "id_user",
        {"sec": ["email", "parola", "rol"], "data": ["nume", "prenume", "telefon", "data_inregistrare"]},
    )
    sec = parts["sec"].select("id_user", F.col("email").alias("first"), F.col("rol").alias("last"))
    data = parts["data"].select("id_user", F.col("nume").alias("first"), F.col("telefon").alias("last"))
    return by_site({"sec": sec, "data": data}, "fragment")


@query
def minterm_fragments(t: Tables) -> DataFrame:
    # Two of the five predicates tell the applications nothing that the others don't.
    bookings = t.rezervare()
    predicates = {
        "cancelled": F.col("status") == "ANULATA", "even": F.col("id_user") % 2 == 0, "am": F.col("regiune_vanzare") == "AM",
        "eu": F.col("regiune_vanzare") == "EU", "large": F.col("total_de_plata") >= 200000,
    }
    applications = {
        "desk_am": F.col("regiune_vanzare") == "AM", "desk_eu": F.col("regiune_vanzare") == "EU",
        "audit": F.expr("total_de_plata >= 200000 AND regiune_vanzare <> 'OTHER'"),
    }
    design = ds.minterm_design(bookings, predicates, applications)
    read = [F.sum(F.coalesce(a, F.lit(False)).cast("long")).alias(f"read_{n}") for n, a in applications.items()]
    return ds.minterm_fragments(bookings, design).groupBy("fragment").agg(F.count(F.lit(1)).alias("bookings"), *read)


@query
def verify_minterms(t: Tables) -> DataFrame:
    bookings = _written_bookings(t)
    predicates = {"am": F.col("regiune_vanzare") == "AM", "large": F.col("total_de_plata") >= 200000}
    design = ds.minterm_design(bookings, predicates, predicates)
    return fr.verify_fragmentation(bookings, fr.fragment_horizontal(bookings, design.fragments()), "id_rezervare")


#: Columns of a user that each kind of application call reads.
_CALLS = {
    "view": ["nume", "prenume"], "click": ["nume", "prenume", "telefon"], "signup": ["email", "parola", "rol"],
    "error": ["email", "rol"], "purchase": ["nume", "email", "telefon"],
}


@query
def affinity_split(t: Tables) -> DataFrame:
    reads = F.create_map(*[x for k, v in _CALLS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    calls = t.raw("events").groupBy(F.col("event_type").alias("application")).agg(F.count(F.lit(1)).alias("times"))
    return ds.affinity_split(calls.select("application", "times", F.explode(reads[F.col("application")]).alias("attribute")))


@query
def verify_fragmentation(t: Tables) -> DataFrame:
    bookings = _written_bookings(t)
    return fr.verify_fragmentation(bookings, fr.fragment_horizontal(bookings, _regions()), "id_rezervare")


@query
def verify_overlap(t: Tables) -> DataFrame:
    # Fragments that share rows, and one whose rows were altered.
    bookings = _written_bookings(t)
    regions = {**_regions(), "CANCELLED": F.col("status") == "ANULATA"}
    parts = fr.fragment_horizontal(bookings, regions)
    parts["EU"] = parts["EU"].withColumn(
        "total_de_plata", F.when(F.col("id_rezervare") % 7 == 0, F.lit(0)).otherwise(F.col("total_de_plata")).cast("decimal(10,2)")
    )
    return fr.verify_fragmentation(bookings, parts, "id_rezervare")


@query
def verify_vertical_broken(t: Tables) -> DataFrame:
    # Users are missing from one fragment, and one column is in both.
    parts = fr.fragment_vertical(
        t.utilizator(), "id_user",
        {"sec": ["email", "parola", "rol"], "data": ["nume", "prenume", "telefon", "data_inregistrare"]},
    )
    parts["sec"] = parts["sec"].filter("id_user % 10 <> 3")
    return fr.verify_fragmentation(t.utilizator(), parts, "id_user", "vertical")


@query
def verify_incomplete(t: Tables) -> DataFrame:
    # Two regions only: the third one's bookings are missing from the fragments.
    bookings = _written_bookings(t)
    parts = fr.fragment_horizontal(bookings, {k: v for k, v in _regions().items() if k != "OTHER"})
    return fr.verify_fragmentation(bookings, parts, "id_rezervare")


@query
def verify_vertical(t: Tables) -> DataFrame:
    users = t.utilizator()
    parts = fr.fragment_vertical(
        users, "id_user",
        {"sec": ["email", "parola", "rol"], "data": ["nume", "prenume", "telefon", "data_inregistrare"]},
    )
    return fr.verify_fragmentation(users, parts, "id_user", mode="vertical")


# --- surrogate keys --------------------------------------------------------------------


def _key_map(t: Tables, site: str) -> DataFrame:
    start, step = ks.SITE_SEQUENCE[site]
    fragment = fr.fragment_horizontal(t.rezervare(), _regions())[site]
    return ks.remap_keys(fragment.select(F.col("id_rezervare").alias("old_id")), "old_id", start, step)


@query
def remap_keys_am(t: Tables) -> DataFrame:
    return _key_map(t, "AM")


@query
def remap_keys_eu(t: Tables) -> DataFrame:
    return _key_map(t, "EU")


@query
def remap_keys_sites(t: Tables) -> DataFrame:
    bookings = t.rezervare().select(F.col("id_rezervare").alias("old_id"), "regiune_vanzare")
    return ks.remap_keys_by_site(bookings, "old_id", "regiune_vanzare")


@query
def remap_children(t: Tables) -> DataFrame:
    start, step = ks.SITE_SEQUENCE["AM"]
    return ks.remap_children(
        t.bilet(), _key_map(t, "AM"), "id_rezervare", "id_bilet", start, step, order=TICKET_ORDER
    )


@query
def next_key(t: Tables) -> DataFrame:
    catalog = t.catalog()
    none = t.rezervare().filter(F.col("regiune_vanzare") == "none")
    return by_site(
        {
            "AM": ks.next_key(catalog.table("AM", "rezervare_am"), "id_rezervare", 1, 2),
            "EU": ks.next_key(catalog.table("EU", "rezervare_eu"), "id_rezervare", 2, 2),
            "AM empty": ks.next_key(none, "id_rezervare", 1, 2),
            "EU empty": ks.next_key(none, "id_rezervare", 2, 2),
        }
    )


@query
def max_default(t: Tables) -> DataFrame:
    return rl.max_or(t.plata(), "id_plata", -1)


@query
def allocate_keys(t: Tables) -> DataFrame:
    # Bookings of no site are added to AM; their payments follow under the new keys.
    start, step = ks.SITE_SEQUENCE["AM"]
    following = ks.next_key(t.catalog().table("AM", "rezervare_am"), "id_rezervare", start, step).first()[0]
    new = (
        fr.fragment_horizontal(t.rezervare(), _regions())["OTHER"]
        .select(F.col("id_rezervare").alias("tag"), "data_rezervare")
    )
    owners = ks.allocate_keys(new, ["data_rezervare", "tag"], "id_rezervare", following, step)
    payments = t.plata().select(F.col("id_rezervare").alias("tag"), "suma_achitata", "metoda_plata")
    return ks.hand_down_keys(payments, owners, "tag", "id_rezervare")


# --- global views ----------------------------------------------------------------------


@query
def view_union_all(t: Tables) -> DataFrame:
    return vw.view_horizontal(t.catalog(), "rezervare", site_column="site")


@query
def view_vertical_join(t: Tables) -> DataFrame:
    return vw.view_vertical(t.catalog())


@query
def global_names(t: Tables) -> DataFrame:
    # Plain SQL over the registered global names.
    vw.global_catalog(t.catalog())
    return t.spark.sql(
        """SELECT r.regiune_vanzare, c.nume_tara, count(*) AS tickets, count(DISTINCT u.id_user) AS users
        FROM v_bilet b JOIN v_rezervare r ON b.id_rezervare = r.id_rezervare
        JOIN v_utilizator u ON r.id_user = u.id_user JOIN zbor z ON b.id_zbor = z.id_zbor
        JOIN aeroport a ON z.id_aeroport_plecare = a.id_aeroport JOIN oras o ON a.id_oras = o.id_oras
        JOIN tara c ON o.id_tara = c.id_tara GROUP BY 1, 2"""
    )


@query
def global_names_pruned(t: Tables) -> DataFrame:
    # One region is asked for, so one fragment is read.
    vw.global_catalog(t.catalog(), prune=True, site_column="site")
    return t.spark.sql(
        """SELECT r.site, r.status, count(*) AS bookings FROM v_rezervare r
        WHERE r.regiune_vanzare = 'AM' GROUP BY r.site, r.status"""
    )


# --- projections, filters, expressions -------------------------------------------------


@query
def project_alias(t: Tables) -> DataFrame:
    users = rl.project(t.utilizator(), ["nume", "id_user", "rol"], {"nume": "client"})
    return users.withColumn("is_admin", F.col("rol") == "ADMIN")


@query
def filter_compare(t: Tables) -> DataFrame:
    recent = rl.where_cmp(t.rezervare(), "data_rezervare", ">=", fn.instant("1998-01-01 00:00:00"))
    open_ones = rl.where_cmp(recent, "status", "!=", "ANULATA")
    return rl.where_cmp(open_ones, "regiune_vanzare", "=", "EU")


@query
def filter_in(t: Tables) -> DataFrame:
    return rl.where_in(t.plata(), "metoda_plata", ["CARD", "TRANSFER_BANCAR"]).select("id_plata", "metoda_plata")


@query
def filter_range(t: Tables) -> DataFrame:
    return rl.where_range(t.bilet(), "numar_rand", 10, 30).select("id_bilet", "numar_rand", "litera_scaun")


@query
def not_exists(t: Tables) -> DataFrame:
    returned = t.bilet().filter(F.col("clasa") == "BUSINESS")
    none = rl.where_exists(t.rezervare(), returned, {"id_rezervare": "id_rezervare"}, negate=True)
    some = rl.where_exists(t.rezervare(), returned, {"id_rezervare": "id_rezervare"})
    columns = ["id_rezervare", "id_user"]
    return by_site({"none": none.select(*columns), "some": some.select(*columns)}, "business")


@query
def string_ops(t: Tables) -> DataFrame:
    user = t.utilizator()
    return user.select(
        "id_user",
        fn.cat("nume", F.lit(" / "), "telefon").alias("label"),
        F.upper("email").alias("upper_email"),
        fn.is_upper("prenume").alias("is_upper"),
        fn.len_in("telefon", 3, 4, 5).alias("short_phone"),
        F.length("nume").alias("name_length"),
    )


@query
def check_email(t: Tables) -> DataFrame:
    return t.utilizator().select("id_user", "email", fn.email_ok("email").alias("email_ok"))


@query
def format_timestamp(t: Tables) -> DataFrame:
    return t.zbor().select("id_zbor", fn.fmt_minute("data_plecare").alias("leaves"))


@query
def months_window(t: Tables) -> DataFrame:
    since = fn.months_back(AS_OF, 6)
    recent = t.rezervare().filter(F.col("data_rezervare") >= since)
    return recent.select(
        "id_rezervare", "data_rezervare",
        fn.months_back(F.col("data_rezervare"), 1).alias("month_before"),
        fn.months_back(F.col("data_rezervare"), -1).alias("month_after"),
    )


@query
def nvl_default(t: Tables) -> DataFrame:
    return t.utilizator().select("id_user", fn.nvl("telefon", "N/A").alias("telefon"))


@query
def route_parity(t: Tables) -> DataFrame:
    signed = (F.col("id_rezervare") - 5000).alias("key")
    return t.rezervare().select(signed).select("key", fn.route_site("key").alias("site"))


@query
def occupancy_pct(t: Tables) -> DataFrame:
    sold = rl.counts(t.bilet(), ["id_zbor"], "sold")
    cabins = rl.join_chain(t.zbor().select("id_zbor", "id_avion"), [(t.avion(), {"id_avion": "id_avion"})])
    return sold.join(cabins, "id_zbor").select(
        "id_zbor", "sold", fn.occupancy_pct("sold", "capacitate").alias("pct")
    )


@query
def ticket_price(t: Tables) -> DataFrame:
    prices = t.zbor().select("id_zbor", "pret_standard")
    return t.bilet().join(prices, "id_zbor").select(
        "id_bilet", "id_zbor", "clasa",
        fn.ticket_price("pret_standard", "clasa").alias("price"),
        fn.ticket_price("pret_standard", "clasa", "1.8").alias("price_18"),
    )


@query
def booking_total(t: Tables) -> DataFrame:
    return bk.booking_total(t.bilet())


@query
def status_at(t: Tables) -> DataFrame:
    flights = t.zbor().withColumn("off", F.col("id_zbor") % 19 == 0)
    return bk.with_status(flights, "off", AS_OF).select("id_zbor", "status")


@query
def derive_states(t: Tables) -> DataFrame:
    states = bk.derive_states(t.bilet().select("id_bilet", "id_zbor"), t.zbor())
    return states.select("id_bilet", "id_zbor", "status_rezervare", "status_plata")


@query
def insert_defaults(t: Tables) -> DataFrame:
    # Bookings that come without region, date (priority 5) and status (priority 1).
    raw = t.raw("orders").select(
        F.col("o_orderkey").alias("id_rezervare"),
        F.col("o_custkey").alias("id_user"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("data_rezervare"),
        fn.money("o_totalprice").alias("total_de_plata"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias("status"),
    )
    return with_defaults(raw, RELATIONS["rezervare"], as_of=AS_OF, regiune_vanzare="AM")


@query
def seat_valid(t: Tables) -> DataFrame:
    tickets = bk.seat_validity(t.bilet(), t.zbor(), t.avion())
    return tickets.select("id_bilet", "id_zbor", "numar_rand", "litera_scaun", "seat_ok")


@query
def row_label(t: Tables) -> DataFrame:
    label = fn.row_label("{} lei for booking {} ({}), payment {}", "suma_achitata", "id_rezervare", "status", "id_plata")
    return t.plata().select("id_plata", label.alias("label"))


@query
def distinct_departures(t: Tables) -> DataFrame:
    return rl.distinct(t.zbor(), ["id_aeroport_plecare", "status"])


# --- joins, aggregates, ranking --------------------------------------------------------


@query
def join_chain(t: Tables) -> DataFrame:
    joined = rl.join_chain(
        t.bilet().select("id_bilet", "id_rezervare", "id_zbor"),
        [
            (t.rezervare().select("id_rezervare", "id_user", "regiune_vanzare"), {"id_rezervare": "id_rezervare"}),
            (t.zbor().select("id_zbor", "id_avion", "id_aeroport_plecare"), {"id_zbor": "id_zbor"}),
            (t.avion().select("id_avion", "model"), {"id_avion": "id_avion"}),
            (t.aeroport().select("id_aeroport", "id_oras"), {"id_aeroport_plecare": "id_aeroport"}),
            (t.oras().select("id_oras", "id_tara"), {"id_oras": "id_oras"}),
            (t.tara().select("id_tara", "nume_tara"), {"id_tara": "id_tara"}),
        ],
    )
    return rl.counts(joined, ["regiune_vanzare", "model", "nume_tara"], "tickets")


@query
def role_playing_dims(t: Tables) -> DataFrame:
    flights = t.zbor().select("id_zbor", "id_aeroport_plecare", "id_aeroport_sosire")
    return rl.join_roles(
        flights, t.aeroport().select("id_aeroport", "cod_iata"), "id_aeroport",
        {"plecare": "id_aeroport_plecare", "sosire": "id_aeroport_sosire"},
    )


@query
def hash_join_hint(t: Tables) -> DataFrame:
    sold = rl.totals(t.bilet(), "id_zbor", {"sold": F.count(F.lit(1))})
    return rp.route_dimensions_hashed(t.catalog(), sold).select("id_zbor", "sold", "id_avion", "capacitate")


@query
def join_cross_site(t: Tables) -> DataFrame:
    catalog = t.catalog()
    tickets = catalog.table("EU", "bilet_eu").select("id_zbor", "id_pasager")
    named = rl.join_site(tickets, catalog, "AM", "pasager", "id_pasager")
    return rl.counts(named, ["nationalitate"], "tickets")


@query
def join_where(t: Tables) -> DataFrame:
    flights = t.zbor().select("id_zbor", F.col("status").alias("status_zbor"))
    joined = rl.join_where(t.bilet(), flights, "id_zbor", F.col("status_zbor") == "ANULAT")
    return rl.counts(joined, ["id_zbor"], "tickets")


@query
def route_totals(t: Tables) -> DataFrame:
    return rl.totals(
        t.bilet(), "id_zbor",
        {
            "tickets": F.count("id_bilet"),
            "rows": F.count(F.lit(1)),
            "revenue": F.sum("pret_final").cast("decimal(28,2)"),
        },
    )


@query
def nationality_counts(t: Tables) -> DataFrame:
    named = t.bilet().join(t.pasager(), "id_pasager")
    return rl.counts(named, ["id_zbor", "nationalitate"])


@query
def mode_by_key(t: Tables) -> DataFrame:
    return rl.mode_by(t.bilet().join(t.pasager(), "id_pasager"), "id_zbor", "nationalitate")


@query
def rank_over_aggregate(t: Tables) -> DataFrame:
    ranks = rp.nationality_ranks(t.catalog())
    return ranks.withColumn("rnk", F.col("rnk").cast("bigint"))


@query
def match_count(t: Tables) -> DataFrame:
    users = t.utilizator().select("id_user")
    return rl.match_count(users, t.rezervare(), ["id_user"])


# --- order and limits ------------------------------------------------------------------


@query
def sort_nulls(t: Tables) -> DataFrame:
    return rl.order(
        t.zbor().select("id_zbor", "data_plecare_efectiva"), [("data_plecare_efectiva", "desc"), "id_zbor"]
    )


@query
def topk(t: Tables) -> DataFrame:
    users = t.utilizator().select("id_user", "telefon", "rol")
    return rl.top_k(users, [("telefon", "desc"), "id_user"], 100)


@query
def limit_rows(t: Tables) -> DataFrame:
    return rl.any_n(t.utilizator().select("id_user", "nume", "prenume"), "id_user", 100)


# --- changes and replication -----------------------------------------------------------


def _middle(t: Tables) -> int:
    return t.raw("events").agg(F.max("event_id")).first()[0] // 2


def _halfway(t: Tables, since: int) -> DataFrame:
    return ch.apply_changes(t.accounts(), t.account_changes().filter(F.col("seq") <= since), "user_id")


@query
def apply_changes(t: Tables) -> DataFrame:
    return ch.apply_changes(t.accounts(), t.account_changes(), "user_id")


@query
def apply_changes_bulk(t: Tables) -> DataFrame:
    return ch.apply_changes(t.accounts(), t.account_changes(), "user_id")


@query
def insert_conflicts(t: Tables) -> DataFrame:
    return ch.insert_conflicts(t.accounts(), t.account_changes(), "user_id")


@query
def replica_after_changes(t: Tables) -> DataFrame:
    catalog = vw.SiteCatalog(t.spark, fresh_path(t.spark, "replica"))
    rs.start_replica(catalog, "EU", "accounts", t.accounts(), "user_id", buckets=8)
    events = rs.read_changes(
        t.spark, t.sf_dir, t.raw("events").schema, pathGlobFilter="events.parquet"
    )
    stream = rs.replicate_stream(
        t.account_changes(events), catalog, "EU", "accounts", "user_id", fresh_path(t.spark, "stream")
    )
    stream.awaitTermination()
    return rs.read_replica(catalog, "EU", "accounts")


@query
def replica_out_of_order(t: Tables) -> DataFrame:
    # The later half of the log arrives first, in a batch of its own.
    catalog = vw.SiteCatalog(t.spark, fresh_path(t.spark, "replica"))
    rs.start_replica(catalog, "EU", "accounts", t.accounts(), "user_id", buckets=8)
    folder, stream = fresh_path(t.spark, "log"), fresh_path(t.spark, "stream")
    middle = _middle(t)
    for late in (False, True):
        part = t.account_changes().filter((F.col("seq") <= middle) == late)
        part.write.parquet(f"{folder}/half={int(late)}")
        changes = rs.read_changes(t.spark, folder, t.account_changes().schema, recursiveFileLookup="true")
        rs.replicate_stream(changes, catalog, "EU", "accounts", "user_id", stream).awaitTermination()
    return rs.read_replica(catalog, "EU", "accounts")


@query
def capture_changes(t: Tables) -> DataFrame:
    return ch.capture_changes(
        t.accounts(), ch.apply_changes(t.accounts(), t.account_changes(), "user_id"), "user_id", start_seq=1
    )


@query
def refresh_incremental(t: Tables) -> DataFrame:
    since = _middle(t)
    refreshed, _ = rs.refresh_incremental(_halfway(t, since), t.account_changes(), since, "user_id")
    return refreshed


@query
def replica_stale(t: Tables) -> DataFrame:
    since = _middle(t)
    master = ch.apply_changes(t.accounts(), t.account_changes(), "user_id")
    return rs.stale_keys(master, _halfway(t, since), "user_id")


@query
def compare_replicas(t: Tables) -> DataFrame:
    master = ch.apply_changes(t.accounts(), t.account_changes(), "user_id")
    return ch.compare_replicas(master, t.accounts(), "user_id")


def _sets(**by_type: list[str]) -> Column:
    out = F.array().cast("array<string>")
    for event_type, columns in by_type.items():
        out = F.when(F.col("event_type") == event_type, F.array(*[F.lit(c) for c in columns])).otherwise(out)
    return out


def _booking_updates(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "click", "CONFIRMATA")
        .when(F.col("event_type") == "purchase", "FINALIZATA")
        .otherwise("ANULATA")
    )
    return t.raw("events").select(
        F.col("event_id").alias("seq"),
        F.lit("U").alias("op"),
        F.col("user_id").alias("id_rezervare"),
        status.alias("status"),
        fn.money("value").alias("total_de_plata"),
        F.col("ts").alias("data_rezervare"),
        _sets(
            click=["status"], view=["total_de_plata"], purchase=["status", "total_de_plata"],
            error=["status", "total_de_plata"], signup=["data_rezervare"],
        ).alias("sets"),
    )


def _user_updates(t: Tables) -> DataFrame:
    return t.raw("events").select(
        F.col("event_id").alias("seq"),
        F.lit("U").alias("op"),
        F.col("user_id").alias("id_user"),
        F.concat(F.lit("name "), F.col("event_id").cast("string")).alias("nume"),
        F.col("event_type").alias("prenume"),
        F.when(F.col("event_type") == "view", F.col("event_id").cast("string")).alias("telefon"),
        F.lit("new@example.com").alias("email"),
        _sets(
            click=["nume"], view=["telefon"], purchase=["nume", "prenume"], signup=["telefon"],
            error=["email"],
        ).alias("sets"),
    )


@query
def route_update(t: Tables) -> DataFrame:
    catalog = t.catalog()
    fragments = {s: catalog.table(s, f"rezervare_{s.lower()}") for s in ("AM", "EU")}
    return by_site(ch.route_update("v_rezervare", _booking_updates(t), fragments, "id_rezervare"))


@query
def route_update_vertical(t: Tables) -> DataFrame:
    data = t.catalog().table("AM", "utilizator_data")
    return ch.route_update_vertical("v_utilizator", _user_updates(t), data, "id_user")


@query
def update_by_key(t: Tables) -> DataFrame:
    updates = t.raw("events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("id_zbor"), fn.money("value").alias("pret_standard")
    )
    return ch.update_by_key(t.zbor(), updates, "id_zbor", ["pret_standard"]).select(
        "id_zbor", "pret_standard", "status"
    )


@query
def cancel_bookings(t: Tables) -> DataFrame:
    catalog = t.catalog()
    ids = t.raw("lineitem").filter("l_returnflag = 'R' AND l_quantity > 45").select(
        F.col("l_orderkey").alias("id_rezervare")
    )
    bookings, payments = ch.cancel_bookings(
        ids,
        {s: catalog.table(s, f"rezervare_{s.lower()}") for s in ("AM", "EU")},
        {s: catalog.table(s, f"plata_{s.lower()}") for s in ("AM", "EU")},
    )
    columns = ["site", "id_rezervare", "status"]
    return by_site(
        {"booking": by_site(bookings).select(*columns), "payment": by_site(payments).select(*columns)}, "kind"
    )


@query
def cancel_published(t: Tables) -> DataFrame:
    # The same cancellation on published tables: one commit, touched buckets only.
    source = t.catalog()
    catalog = vw.SiteCatalog(t.spark, fresh_path(t.spark, "sites"))
    keys = {"rezervare": "id_rezervare", "plata": "id_plata"}
    names = [(s, f"{n}_{s.lower()}", key) for s in ("AM", "EU") for n, key in keys.items()]
    catalog.publish({(s, n): (source.table(s, n), key) for s, n, key in names}, buckets=8)
    ids = t.raw("lineitem").filter("l_returnflag = 'R' AND l_quantity > 45").select(
        F.col("l_orderkey").alias("id_rezervare")
    )
    bk.publish_cancelled(catalog, ids, tag="cancel")
    columns = ["site", "id_rezervare", "status"]
    return by_site(
        {
            kind: by_site({s: catalog.table(s, f"{n}_{s.lower()}") for s in ("AM", "EU")}).select(*columns)
            for kind, n in (("booking", "rezervare"), ("payment", "plata"))
        },
        "kind",
    )


def _requests(t: Tables) -> DataFrame:
    letter = F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDG")
    return t.raw("orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("id_user"),
        F.col("o_custkey").alias("id_zbor"),
        (F.col("o_custkey") + 30).alias("id_pasager"),
        (F.col("o_orderkey") % 36 + 1).alias("numar_rand"),
        letter.alias("litera_scaun"),
        F.when(F.col("o_orderstatus") == "P", "BUSINESS").otherwise("ECONOMY").alias("clasa"),
    )


@query
def book_batch(t: Tables) -> DataFrame:
    booked = bk.book(t.catalog(), _requests(t), "EU", AS_OF)
    return booked.tickets.join(booked.bookings, "id_rezervare").join(booked.payments.drop("status"), "id_rezervare")


@query
def book_refused(t: Tables) -> DataFrame:
    return bk.review(t.catalog(), _requests(t)).filter(F.col("reason").isNotNull()).select("request_id", "reason")


def _published(t: Tables, names: dict[tuple[str, str], str]) -> vw.SiteCatalog:
    """The roles with some tables published: ``{(site, name): key}``."""
    catalog, source = t.catalog(fresh_path(t.spark, "sites")), t.catalog()
    catalog.publish({(s, n): (source.table(s, n), key) for (s, n), key in names.items()})
    for place in names:
        catalog.unregister(*place)
    return catalog


_SALES_EU = {("EU", "rezervare_eu"): "id_rezervare", ("EU", "plata_eu"): "id_plata", ("EU", "bilet_eu"): "id_bilet"}


def _new_tickets(before: vw.SiteCatalog, after: vw.SiteCatalog) -> DataFrame:
    old = before.table("EU", "bilet_eu").select("id_bilet")
    tickets = after.table("EU", "bilet_eu").join(old, "id_bilet", "left_anti")
    bookings = after.table("EU", "rezervare_eu")
    payments = after.table("EU", "plata_eu").drop("status")
    return tickets.join(bookings, "id_rezervare").join(payments, "id_rezervare")


@query
def book_published(t: Tables) -> DataFrame:
    # The batch's rows as they stand in the published tables.
    catalog = _published(t, _SALES_EU)
    before = catalog.snapshot()
    bk.book_and_publish(catalog, _requests(t), "EU", AS_OF, tag="batch")
    return _new_tickets(before, catalog.snapshot())


@query
def book_twice(t: Tables) -> DataFrame:
    # Two batches are checked against the same version and want some of the same seats.
    catalog = _published(t, _SALES_EU)
    before = catalog.snapshot()
    first, second = (_requests(t).filter(F.col("request_id") % 2 == k) for k in (0, 1))
    one, two = bk.book(catalog, first, "EU", AS_OF), bk.book(catalog, second, "EU", AS_OF)
    bk.publish_booked(catalog, "EU", one)
    bk.book_and_publish(catalog, second, "EU", AS_OF, booked=two)
    return _new_tickets(before, catalog.snapshot()).select(
        "id_bilet", "id_rezervare", "id_plata", "id_user", "id_zbor", "numar_rand", "litera_scaun"
    )


@query
def snapshot_read(t: Tables) -> DataFrame:
    # Bookings are read before a publish and tickets after it: a snapshot shows one version of both.
    catalog = _published(t, {k: v for k, v in _SALES_EU.items() if k[1] != "plata_eu"})
    snapshot = catalog.snapshot()
    bookings = snapshot.table("EU", "rezervare_eu")
    gone = bookings.filter("id_rezervare % 4 = 0").select("id_rezervare")
    lost = snapshot.table("EU", "bilet_eu").join(gone, "id_rezervare", "left_semi").select("id_bilet")
    drop = lambda key: lambda current, keys: current.join(keys, key, "left_anti")
    catalog.publish_changes({
        ("EU", "rezervare_eu"): (gone, drop("id_rezervare")), ("EU", "bilet_eu"): (lost, drop("id_bilet")),
    })
    now = catalog.snapshot()
    counted = {
        name: s.table("EU", "bilet_eu").groupBy("id_rezervare").count().join(b, "id_rezervare")
        .agg(F.count(F.lit(1)).alias("bookings"), F.sum("count").alias("tickets"))
        for name, s, b in (("before", snapshot, bookings), ("after", now, now.table("EU", "rezervare_eu")))
    }
    return by_site(counted, "version")


@query
def admit_insert(t: Tables) -> DataFrame:
    # New tickets for EU, many of which some rule refuses; accepted ones have no rule.
    new = t.raw("orders").selectExpr(
        "o_orderkey AS seq", "100000000 + o_orderkey * 2 AS id_bilet", "o_orderkey AS id_rezervare",
        "o_custkey AS id_zbor", "o_custkey + 30 AS id_pasager", "o_orderkey % 30 - 1 AS numar_rand",
        "substring('ABCDEFGX', CAST(o_orderkey % 8 + 1 AS INT), 1) AS litera_scaun",
        "IF(o_orderstatus = 'P', 'BUSINESS', 'ECONOMY') AS clasa",
        "CAST(o_totalprice - 3000 AS DECIMAL(10,2)) AS pret_final",
    )
    return _verdicts(ad.admit(t.catalog(), "EU", "bilet", new))


@query
def admit_update(t: Tables) -> DataFrame:
    # Bookings of EU are given to other users, some of whom the central site does not know.
    moved = t.catalog().table("EU", "rezervare_eu").withColumns(
        {"id_user": F.col("id_user") + 20, "seq": F.col("id_rezervare")}
    )
    return _verdicts(ad.admit(t.catalog(), "EU", "rezervare", moved, changed=["id_user"]))


def _verdicts(admitted: ad.Admitted) -> DataFrame:
    none = F.lit(None)
    accepted = admitted.accepted.select("seq", none.cast("string").alias("rule"), none.cast("int").alias("error"))
    return accepted.unionByName(admitted.refused.select("seq", "rule", "error"))


@query
def delete_by_key(t: Tables) -> DataFrame:
    cancelled = t.rezervare().filter(F.col("status") == "ANULATA")
    left = ch.delete_by_key(t.bilet(), cancelled, "id_rezervare")
    return left.select("id_bilet", "id_rezervare", "id_zbor")


@query
def propagate_chain(t: Tables) -> DataFrame:
    catalog = t.catalog()
    master, copy = rs.propagate_vertical(
        _user_updates(t), catalog.table("AM", "utilizator_data"), catalog.table("EU", "utilizator_data")
    )
    return by_site({"AM": master, "EU": copy})


# --- integrity -------------------------------------------------------------------------


@query
def check_rules(t: Tables) -> DataFrame:
    parts = []
    for name in ("tara", "aeroport", "avion", "zbor", "pasager", "utilizator", "rezervare", "plata", "bilet"):
        relation = RELATIONS[name]
        parts.append(ic.check_rules(getattr(t, name)(), name, relation.key, relation.checks))
    return reduce(DataFrame.unionByName, parts).select("rule", "name", "key")


@query
def check_not_null(t: Tables) -> DataFrame:
    users = ic.check_not_null(t.utilizator(), "utilizator", "id_user", ["email", "telefon"])
    flights = ic.check_not_null(
        t.zbor(), "zbor", "id_zbor", ["data_plecare", "data_plecare_efectiva", "data_sosire_efectiva"]
    )
    return users.unionByName(flights)


@query
def unique_local(t: Tables) -> DataFrame:
    return ic.check_unique(t.raw("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


def _good_users(t: Tables) -> DataFrame:
    return t.utilizator().filter(fn.email_ok("email")).select("id_user", "email", "parola", "rol")


@query
def fk_local(t: Tables) -> DataFrame:
    return ic.check_fk(t.rezervare(), "rezervare", "id_rezervare", "id_user", _good_users(t), "id_user")


@query
def fk_global(t: Tables) -> DataFrame:
    catalog = t.catalog()
    catalog.register("AM", "utilizator_sec", _good_users(t))
    return ic.check_fk_site(
        catalog.table("EU", "rezervare_eu"), "rezervare_eu", "id_rezervare", "id_user",
        catalog, "AM", "utilizator_sec", "id_user",
    )


@query
def unique_global(t: Tables) -> DataFrame:
    catalog = t.catalog()
    fragments = {s: catalog.table(s, f"bilet_{s.lower()}").select("id_bilet", *SEAT) for s in ("AM", "EU")}
    return ic.check_unique_sites(fragments["AM"], "AM", fragments, "bilet_am", "id_bilet", SEAT)


@query
def unique_global_all(t: Tables) -> DataFrame:
    catalog = t.catalog()
    fragments = {s: catalog.table(s, f"bilet_{s.lower()}") for s in ("EU",)}
    return ic.check_unique_sites(
        catalog.table("AM", "bilet_am"), "AM", fragments, "bilet", "id_bilet", SEAT, mode="global"
    )


@query
def unique_view(t: Tables) -> DataFrame:
    catalog = t.catalog()
    users = ic.check_unique(vw.view_vertical(catalog), "v_utilizator", ["email"])
    tickets = ic.check_unique(vw.view_horizontal(catalog, "bilet"), "v_bilet", ["id_bilet"])
    return users.unionByName(tickets)


@query
def check_fragment_predicate(t: Tables) -> DataFrame:
    stored = t.rezervare().withColumn("site", fn.route_site("id_rezervare"))
    parts = [
        ic.check_fragment(
            stored.filter(F.col("site") == s), f"rezervare_{s.lower()}", "id_rezervare",
            F.col("regiune_vanzare") == s,
        )
        for s in ("AM", "EU")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def rule_report(t: Tables) -> DataFrame:
    tables, rules = ic.site_rules(t.catalog(), "EU")
    return ic.rule_report(tables, rules)


@query
def rule_report_master(t: Tables) -> DataFrame:
    tables, rules = ic.site_rules(t.catalog(), "AM")
    return ic.rule_report(tables, rules)


@query
def violations_after_changes(t: Tables) -> DataFrame:
    """Rules on accounts and their bookings, kept up to date through three batches of changes."""
    accounts, bookings = t.accounts(), t.rezervare().select("id_rezervare", "id_user")
    held = ic.Keys("accounts", accounts, ("user_id",))
    rules = [
        ic.Rule("value_positive", "accounts", "check", lambda: F.col("value") > 0),
        ic.Rule("unique_user_id", "accounts", "unique", own=held),
        ic.Rule("unique_value_note", "accounts", "unique", own=ic.Keys("accounts", accounts, ("value", "note"))),
        ic.Rule("fk_id_user", "bookings", "fk", own=ic.Keys("bookings", bookings, ("id_user",)), other=(held,)),
    ]
    kept = ic.keep_counts({"accounts": accounts, "bookings": bookings}, rules)
    last = t.raw("events").agg(F.max("event_id")).first()[0]
    reports = []
    for batch in (1, 2, 3):
        seq = F.col("seq")
        changes = t.account_changes().where((seq > last * (batch - 1) // 3) & (seq <= last * batch // 3))
        touched = changes.select("user_id").distinct()
        before = accounts.join(touched, "user_id", "left_semi")
        after = materialize(ch.apply_changes(before, changes, "user_id"), "after")
        kept = ic.move_counts(kept, "accounts", before, after)
        accounts = materialize(accounts.join(touched, "user_id", "left_anti").unionByName(after), "accounts")
        reports.append(kept.report().withColumn("batch", F.lit(batch)))
    return reduce(DataFrame.unionByName, reports)


@query
def refresh_validated(t: Tables) -> DataFrame:
    children = t.rezervare().select("id_rezervare", F.col("id_user").alias("owner"))
    _, _, orphans = rs.refresh_validated(
        t.accounts(), t.account_changes(), -1, "user_id",
        [("rezervare", children, "id_rezervare", "owner")],
    )
    return orphans


# --- reports and listings --------------------------------------------------------------


@query
def report_mode(t: Tables) -> DataFrame:
    return rp.report_routes(t.catalog(), AS_OF)


@query
def report_rank(t: Tables) -> DataFrame:
    return rp.report_routes_ranked(t.catalog(), AS_OF)


@query
def list_departures(t: Tables) -> DataFrame:
    return rp.list_departures(t.catalog())


@query
def list_arrivals(t: Tables) -> DataFrame:
    return rp.list_arrivals(t.catalog(), 6)


@query
def list_flights(t: Tables) -> DataFrame:
    return rp.list_flights(t.catalog(), 0, 3)


@query
def latest_payments(t: Tables) -> DataFrame:
    payments = t.catalog().table("EU", "plata_eu").select("id_plata", "id_rezervare", "suma_achitata", "status")
    return rp.latest(payments, "id_plata", 20)


@query
def booking_history(t: Tables) -> DataFrame:
    return rp.booking_history(t.catalog(), "EU")


@query
def global_tickets(t: Tables) -> DataFrame:
    return rp.global_tickets(t.catalog())


@query
def global_users(t: Tables) -> DataFrame:
    return rp.global_users(t.catalog())


@query
def latest_flights(t: Tables) -> DataFrame:
    return rp.latest_flights(t.catalog())


@query
def active_bookings(t: Tables) -> DataFrame:
    return rp.active_bookings(t.catalog())


@query
def site_status(t: Tables) -> DataFrame:
    return rp.site_status(t.catalog(), "EU")


@query
def point_lookup(t: Tables) -> DataFrame:
    catalog = t.catalog()
    return by_site({s: rp.lookup(catalog, s, "zbor", "id_zbor", 7) for s in ("AM", "EU")})
