"""The driver's tables in the roles of the booking domain.

Each relation is a projection of a driver table, so every query below reads whole tables and
grows with them. ``ROLES_SQL`` states the same mapping for the oracle.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitefold.sources.schema import USER_FRAGMENTS
from sitefold.sources.sites import SiteCatalog

AS_OF = "2001-08-01 00:00:00"

_SCHEMAS: dict[str, T.StructType] = {}

# Projections of the driver tables, as Spark SQL expressions.
TARA = [
    "CAST(r_regionkey AS BIGINT) AS id_tara", "r_name AS nume_tara",
    "upper(substring(r_name, 1, 2)) AS cod_iso_2",
]
ORAS = [
    "CAST(n_nationkey AS BIGINT) AS id_oras", "CAST(n_regionkey AS BIGINT) AS id_tara",
    "n_name AS nume_oras",
]
AEROPORT = [
    "CAST(n_nationkey AS BIGINT) AS id_aeroport", "CAST(n_nationkey AS BIGINT) AS id_oras",
    "'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS cod_iata",
    "n_name || ' Intl' AS nume_aeroport",
]
AVION = [
    "p_partkey AS id_avion", "'YR-' || p_partkey AS numar_inmatriculare",
    """CASE p_type WHEN 'ECONOMY' THEN 'Boeing 737-800' WHEN 'PROMO' THEN 'Airbus A320'
        WHEN 'SMALL' THEN 'ATR 72-600' WHEN 'STANDARD' THEN 'Boeing 737-700'
        WHEN 'LARGE' THEN 'Boeing 737 MAX 8' ELSE 'Other' END AS model""",
    "CAST(p_size AS BIGINT) AS capacitate", "1940 + p_size AS an_fabricatie",
]
FLIGHT_TIMES = [
    "*", "p_partkey % 4 AS late", "60 + p_partkey % 181 AS lasts",
    """TIMESTAMP_NTZ '2001-07-01 00:00:00'
        + make_dt_interval(CAST(p_partkey % 61 AS INT), p_size) AS leaves""",
]
FLIGHT_ENDS = [
    "*", "leaves + make_dt_interval(0, 0, CAST(lasts AS INT)) AS arrives",
    "make_dt_interval(0, 0, IF(late = 1, 30, 0)) AS delay",
]
ZBOR = [
    "p_partkey AS id_zbor", "p_partkey AS id_avion", "p_partkey % 25 AS id_aeroport_plecare",
    "CAST(p_size % 25 AS BIGINT) AS id_aeroport_sosire", "'F' || p_partkey AS numar_zbor",
    "leaves AS data_plecare", "arrives AS data_sosire",
    "IF(late <> 0, leaves + delay, NULL) AS data_plecare_efectiva",
    "IF(late <> 0, arrives + delay, NULL) AS data_sosire_efectiva",
    "lasts AS durata_estimata", "CAST(p_retailprice AS DECIMAL(10,2)) AS pret_standard",
    """CASE p_partkey % 6 WHEN 0 THEN 'PROGRAMAT' WHEN 1 THEN 'ANULAT' WHEN 2 THEN 'INTARZIAT'
        WHEN 3 THEN 'IMBARCAT' WHEN 4 THEN 'IN_ZBOR' ELSE 'ATERIZAT' END AS status""",
]
PASAGER = [
    "c_custkey AS id_pasager", "c_name AS nume", "c_mktsegment AS prenume",
    """TIMESTAMP_NTZ '1950-01-01 00:00:00'
        + make_dt_interval(CAST(c_custkey % 20000 AS INT)) AS data_nasterii""",
    "'XY' || c_custkey AS numar_document",
    "'N' || lpad(CAST(c_nationkey AS STRING), 2, '0') AS nationalitate",
]
UTILIZATOR = [
    "c_custkey AS id_user", "c_name AS nume", "c_mktsegment AS prenume",
    """IF(c_acctbal < 0, lower(c_mktsegment),
        lower(c_mktsegment) || c_custkey || '@example.com') AS email""",
    "'pw' || c_custkey AS parola", "IF(c_acctbal >= 0, '07' || c_custkey, NULL) AS telefon",
    """TIMESTAMP_NTZ '1995-01-01 00:00:00'
        + make_dt_interval(CAST(c_custkey % 365 AS INT)) AS data_inregistrare""",
    "IF(c_custkey % 10 = 0, 'ADMIN', 'CLIENT') AS rol",
]
PLATA = [
    "o_orderkey AS id_plata", "o_orderkey AS id_rezervare",
    "CAST(o_totalprice AS DECIMAL(10,2)) AS suma_achitata", "o_orderdate AS data_plata",
    """CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'TRANSFER_BANCAR'
        ELSE 'CASH' END AS metoda_plata""",
    """CASE o_orderstatus WHEN 'F' THEN 'ACCEPTATA' WHEN 'O' THEN 'IN_PROCESARE'
        ELSE 'RAMBURSATA' END AS status""",
]
#: Bookings of every fifth order are paid twice: some properties of reports show only then.
SECOND_PLATA = [
    "-o_orderkey AS id_plata", *PLATA[1:3],
    "o_orderdate + INTERVAL '1' HOUR AS data_plata", *PLATA[4:],
]
BILET = [
    "l_orderkey * 16 + l_linenumber * 2 + l_orderkey % 2 AS id_bilet",
    "l_orderkey AS id_rezervare", "l_partkey AS id_zbor", "l_suppkey AS id_pasager",
    "CAST(l_quantity AS BIGINT) AS numar_rand",
    "substring('ABCDEFG', l_linenumber, 1) AS litera_scaun",
    "IF(l_returnflag = 'R', 'BUSINESS', 'ECONOMY') AS clasa",
    "CAST(l_extendedprice AS DECIMAL(10,2)) AS pret_final",
]


def booking(region: str) -> list[str]:
    """Bookings out of orders, with an expression for the region."""
    return [
        "o_orderkey AS id_rezervare", "o_custkey AS id_user", "o_orderdate AS data_rezervare",
        f"{region} AS regiune_vanzare", "CAST(o_totalprice AS DECIMAL(10,2)) AS total_de_plata",
        """CASE o_orderstatus WHEN 'F' THEN 'CONFIRMATA' WHEN 'O' THEN 'IN_ASTEPTARE'
            ELSE 'ANULATA' END AS status""",
    ]


class Tables:
    """Driver tables of one scale, and their roles."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        """A driver table; its schema is inferred from the file once per process."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def tara(self) -> DataFrame:
        return self.raw("region").selectExpr(*TARA)

    def oras(self) -> DataFrame:
        return self.raw("nation").selectExpr(*ORAS)

    def aeroport(self) -> DataFrame:
        return self.raw("nation").selectExpr(*AEROPORT)

    def avion(self) -> DataFrame:
        return self.raw("part").selectExpr(*AVION)

    def zbor(self) -> DataFrame:
        return self.raw("part").selectExpr(*FLIGHT_TIMES).selectExpr(*FLIGHT_ENDS).selectExpr(*ZBOR)

    def pasager(self) -> DataFrame:
        return self.raw("customer").selectExpr(*PASAGER)

    def utilizator(self) -> DataFrame:
        return self.raw("customer").selectExpr(*UTILIZATOR)

    def rezervare(self) -> DataFrame:
        """Bookings before fragmentation; the region is the one of the customer."""
        home = (
            self.raw("customer")
            .join(self.raw("nation"), F.expr("c_nationkey = n_nationkey"))
            .join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
            .select("c_custkey", "r_name")
        )
        region = "CASE r_name WHEN 'AMERICA' THEN 'AM' WHEN 'EUROPE' THEN 'EU' ELSE 'OTHER' END"
        return self.raw("orders").join(home, F.expr("o_custkey = c_custkey")).selectExpr(*booking(region))

    def plata(self) -> DataFrame:
        orders = self.raw("orders")
        second = orders.filter("o_orderkey % 5 = 0").selectExpr(*SECOND_PLATA)
        return orders.selectExpr(*PLATA).unionAll(second)

    def bilet(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(*BILET)

    def catalog(self, root: str | None = None) -> SiteCatalog:
        """Both sites: copies everywhere, central tables on AM, split tables by key parity."""
        catalog = SiteCatalog(self.spark, root)

        def users(part: str) -> DataFrame:
            return self.utilizator().select("id_user", *USER_FRAGMENTS[part])

        def fragment(name: str, site: str) -> DataFrame:
            own = "id_rezervare % 2 <> 0" if site == "AM" else "id_rezervare % 2 = 0"
            if name == "rezervare":
                return self.raw("orders").selectExpr(*booking(f"'{site}'")).filter(own)
            return getattr(self, name)().filter(own)

        for site in ("AM", "EU"):
            for name in ("tara", "oras", "aeroport", "avion", "zbor"):
                catalog.register(site, name, getattr(self, name))
            catalog.register(site, "utilizator_data", partial(users, "utilizator_data"))
            for name in ("rezervare", "plata", "bilet"):
                catalog.register(site, f"{name}_{site.lower()}", partial(fragment, name, site))
        catalog.register("AM", "pasager", self.pasager)
        catalog.register("AM", "utilizator_sec", partial(users, "utilizator_sec"))
        return catalog

    # --- change log --------------------------------------------------------------------

    def accounts(self) -> DataFrame:
        """A keyed table for the change operators."""
        return self.raw("customer").selectExpr(
            "c_custkey AS user_id", "c_acctbal AS value", "c_mktsegment AS note"
        )

    def account_changes(self, events: DataFrame | None = None) -> DataFrame:
        """All events as changes: sign-ups insert, errors delete, the rest update."""
        return (self.raw("events") if events is None else events).selectExpr(
            "event_id AS seq",
            "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op",
            "user_id", "value", "event_type AS note",
        )


ROLES_SQL = """
tara AS (SELECT CAST(r_regionkey AS BIGINT) id_tara, r_name nume_tara,
    upper(substr(r_name, 1, 2)) cod_iso_2 FROM region),
oras AS (SELECT CAST(n_nationkey AS BIGINT) id_oras, CAST(n_regionkey AS BIGINT) id_tara,
    n_name nume_oras FROM nation),
aeroport AS (SELECT CAST(n_nationkey AS BIGINT) id_aeroport, CAST(n_nationkey AS BIGINT) id_oras,
    'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') cod_iata, n_name || ' Intl' nume_aeroport
    FROM nation),
avion AS (SELECT p_partkey id_avion, 'YR-' || p_partkey numar_inmatriculare,
    CASE p_type WHEN 'ECONOMY' THEN 'Boeing 737-800' WHEN 'PROMO' THEN 'Airbus A320'
      WHEN 'SMALL' THEN 'ATR 72-600' WHEN 'STANDARD' THEN 'Boeing 737-700'
      WHEN 'LARGE' THEN 'Boeing 737 MAX 8' ELSE 'Other' END model,
    CAST(p_size AS BIGINT) capacitate, CAST(1940 + p_size AS INTEGER) an_fabricatie FROM part),
part_times AS (SELECT *, TIMESTAMP '2001-07-01 00:00:00' + to_days(CAST(p_partkey % 61 AS INTEGER))
      + to_hours(p_size) leaves, 60 + p_partkey % 181 lasts,
    to_minutes(CASE WHEN p_partkey % 4 = 1 THEN 30 ELSE 0 END) delay FROM part),
zbor AS (SELECT p_partkey id_zbor, p_partkey id_avion, p_partkey % 25 id_aeroport_plecare,
    CAST(p_size % 25 AS BIGINT) id_aeroport_sosire, 'F' || p_partkey numar_zbor,
    leaves data_plecare, leaves + to_minutes(lasts) data_sosire,
    CASE WHEN p_partkey % 4 <> 0 THEN leaves + delay END data_plecare_efectiva,
    CASE WHEN p_partkey % 4 <> 0 THEN leaves + to_minutes(lasts) + delay END data_sosire_efectiva,
    lasts durata_estimata, CAST(p_retailprice AS DECIMAL(10,2)) pret_standard,
    CASE p_partkey % 6 WHEN 0 THEN 'PROGRAMAT' WHEN 1 THEN 'ANULAT' WHEN 2 THEN 'INTARZIAT'
      WHEN 3 THEN 'IMBARCAT' WHEN 4 THEN 'IN_ZBOR' ELSE 'ATERIZAT' END status FROM part_times),
pasager AS (SELECT c_custkey id_pasager, c_name nume, c_mktsegment prenume,
    TIMESTAMP '1950-01-01 00:00:00' + to_days(CAST(c_custkey % 20000 AS INTEGER)) data_nasterii,
    'XY' || c_custkey numar_document,
    'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') nationalitate FROM customer),
utilizator AS (SELECT c_custkey id_user, c_name nume, c_mktsegment prenume,
    CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment)
      ELSE lower(c_mktsegment) || c_custkey || '@example.com' END email,
    'pw' || c_custkey parola, CASE WHEN c_acctbal >= 0 THEN '07' || c_custkey END telefon,
    TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) data_inregistrare,
    CASE WHEN c_custkey % 10 = 0 THEN 'ADMIN' ELSE 'CLIENT' END rol FROM customer),
booking AS (SELECT o_orderkey id_rezervare, o_custkey id_user, o_orderdate data_rezervare,
    CAST(o_totalprice AS DECIMAL(10,2)) total_de_plata,
    CASE o_orderstatus WHEN 'F' THEN 'CONFIRMATA' WHEN 'O' THEN 'IN_ASTEPTARE'
      ELSE 'ANULATA' END status FROM orders),
rezervare AS (SELECT b.id_rezervare, b.id_user, b.data_rezervare,
    CASE r_name WHEN 'AMERICA' THEN 'AM' WHEN 'EUROPE' THEN 'EU' ELSE 'OTHER' END regiune_vanzare,
    b.total_de_plata, b.status
    FROM booking b JOIN customer ON b.id_user = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_rezervare AS (SELECT id_rezervare, id_user, data_rezervare,
    CASE WHEN id_rezervare % 2 <> 0 THEN 'AM' ELSE 'EU' END regiune_vanzare,
    total_de_plata, status FROM booking),
plata AS (SELECT o_orderkey * half id_plata, o_orderkey id_rezervare,
    CAST(o_totalprice AS DECIMAL(10,2)) suma_achitata,
    CASE half WHEN 1 THEN o_orderdate ELSE o_orderdate + INTERVAL '1' HOUR END data_plata,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'TRANSFER_BANCAR'
      ELSE 'CASH' END metoda_plata,
    CASE o_orderstatus WHEN 'F' THEN 'ACCEPTATA' WHEN 'O' THEN 'IN_PROCESARE'
      ELSE 'RAMBURSATA' END status
    FROM orders, (VALUES (1), (-1)) h(half) WHERE half = 1 OR o_orderkey % 5 = 0),
bilet AS (SELECT l_orderkey * 16 + l_linenumber * 2 + l_orderkey % 2 id_bilet,
    l_orderkey id_rezervare, l_partkey id_zbor, l_suppkey id_pasager,
    CAST(l_quantity AS BIGINT) numar_rand,
    substr('ABCDEFG', l_linenumber, 1) litera_scaun,
    CASE WHEN l_returnflag = 'R' THEN 'BUSINESS' ELSE 'ECONOMY' END clasa,
    CAST(l_extendedprice AS DECIMAL(10,2)) pret_final FROM lineitem),
accounts AS (SELECT c_custkey user_id, c_acctbal AS value, c_mktsegment note FROM customer),
chg AS (SELECT event_id seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D'
    ELSE 'U' END op, user_id, value, event_type note FROM events)
"""
