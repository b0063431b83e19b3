"""Relations of the booking domain: declared types, keys, defaults and row rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitefold.functions import email_ok, is_upper, len_in, to_second

# Table and column names, value lists and limits of the source schema.
FLIGHT_STATUS = ["PROGRAMAT", "ANULAT", "INTARZIAT", "IMBARCAT", "IN_ZBOR", "ATERIZAT"]
BOOKING_STATUS = ["IN_ASTEPTARE", "CONFIRMATA", "ANULATA", "FINALIZATA"]
PAYMENT_STATUS = ["IN_PROCESARE", "ACCEPTATA", "RESPINSA", "RAMBURSATA"]
PAYMENT_METHOD = ["CARD", "TRANSFER_BANCAR", "CASH"]
TRAVEL_CLASS = ["ECONOMY", "BUSINESS"]
SEAT_LETTERS = ["A", "B", "C", "D", "E", "F", "G", "H", "J", "K"]
USER_ROLES = ["CLIENT", "ADMIN"]
REGIONS = ["AM", "EU"]

#: Marks a date default that is filled with the job's ``as_of``.
AS_OF = object()


@dataclass(frozen=True)
class Relation:
    """One relation. ``ddl`` declares the columns; ``dates`` lists those cut to seconds."""

    name: str
    ddl: str
    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, str, str], ...] = ()  # (column, parent relation, parent key)
    checks: dict[str, Callable[[], Column]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    dates: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _one_of(column: str, values: list[str]) -> Callable[[], Column]:
    return lambda: F.col(column).isin(values)


def _within(column: str, low: int, high: int) -> Callable[[], Column]:
    """``low < column <= high``."""
    return lambda: (F.col(column) > low) & (F.col(column) <= high)


def _positive(column: str) -> Callable[[], Column]:
    return lambda: F.col(column) > 0


_USER_DATA = "nume string not null, prenume string not null"

RELATIONS: dict[str, Relation] = {
    r.name: r
    for r in [
        Relation(
            "utilizator",
            f"id_user bigint not null, {_USER_DATA}, email string not null, "
            "parola string not null, telefon string, "
            "data_inregistrare timestamp_ntz not null, rol string not null",
            "id_user",
            unique=(("id_user",), ("email",)),
            checks={
                "user_email": lambda: email_ok("email"),
                "user_role": _one_of("rol", USER_ROLES),
            },
            defaults={"data_inregistrare": AS_OF, "rol": "CLIENT"},
            dates=("data_inregistrare",),
        ),
        Relation(
            "pasager",
            f"id_pasager bigint not null, {_USER_DATA}, data_nasterii timestamp_ntz not null, "
            "numar_document string not null, nationalitate string not null",
            "id_pasager",
            unique=(("id_pasager",),),
            checks={"passenger_nationality": lambda: len_in("nationalitate", 2, 3)},
            dates=("data_nasterii",),
        ),
        Relation(
            "tara",
            "id_tara bigint not null, nume_tara string not null, cod_iso_2 string not null",
            "id_tara",
            unique=(("id_tara",), ("nume_tara",), ("cod_iso_2",)),
            checks={"country_iso": lambda: is_upper("cod_iso_2") & len_in("cod_iso_2", 2)},
        ),
        Relation(
            "oras",
            "id_oras bigint not null, id_tara bigint not null, nume_oras string not null",
            "id_oras",
            unique=(("id_oras",), ("nume_oras", "id_tara")),
            foreign=(("id_tara", "tara", "id_tara"),),
        ),
        Relation(
            "aeroport",
            "id_aeroport bigint not null, id_oras bigint not null, cod_iata string not null, "
            "nume_aeroport string not null",
            "id_aeroport",
            unique=(("id_aeroport",), ("cod_iata",)),
            foreign=(("id_oras", "oras", "id_oras"),),
            checks={"airport_iata": lambda: is_upper("cod_iata") & len_in("cod_iata", 3)},
        ),
        Relation(
            "avion",
            "id_avion bigint not null, numar_inmatriculare string not null, "
            "model string not null, capacitate bigint not null, an_fabricatie int not null",
            "id_avion",
            unique=(("id_avion",), ("numar_inmatriculare",)),
            checks={
                "aircraft_capacity": _within("capacitate", 0, 850),
                "aircraft_year": lambda: F.col("an_fabricatie") >= 1950,
            },
        ),
        Relation(
            "zbor",
            "id_zbor bigint not null, id_avion bigint not null, "
            "id_aeroport_plecare bigint not null, id_aeroport_sosire bigint not null, "
            "numar_zbor string not null, data_plecare timestamp_ntz not null, "
            "data_sosire timestamp_ntz not null, data_plecare_efectiva timestamp_ntz, "
            "data_sosire_efectiva timestamp_ntz, durata_estimata bigint not null, "
            "pret_standard decimal(10,2) not null, status string not null",
            "id_zbor",
            unique=(("id_zbor",),),
            foreign=(
                ("id_avion", "avion", "id_avion"),
                ("id_aeroport_plecare", "aeroport", "id_aeroport"),
                ("id_aeroport_sosire", "aeroport", "id_aeroport"),
            ),
            checks={
                "flight_two_airports": lambda: F.col("id_aeroport_plecare")
                != F.col("id_aeroport_sosire"),
                "flight_dates": lambda: F.col("data_plecare") < F.col("data_sosire"),
                "flight_price": _positive("pret_standard"),
                "flight_duration": _positive("durata_estimata"),
                "flight_status": _one_of("status", FLIGHT_STATUS),
            },
            defaults={"status": "PROGRAMAT"},
        ),
        Relation(
            "rezervare",
            "id_rezervare bigint not null, id_user bigint not null, "
            "data_rezervare timestamp_ntz not null, regiune_vanzare string not null, "
            "total_de_plata decimal(10,2) not null, status string not null",
            "id_rezervare",
            unique=(("id_rezervare",),),
            foreign=(("id_user", "utilizator_sec", "id_user"),),
            checks={
                "booking_region": _one_of("regiune_vanzare", REGIONS),
                "booking_total": lambda: F.col("total_de_plata") >= 0,
                "booking_status": _one_of("status", BOOKING_STATUS),
            },
            defaults={"data_rezervare": AS_OF, "status": "IN_ASTEPTARE"},
            dates=("data_rezervare",),
        ),
        Relation(
            "plata",
            "id_plata bigint not null, id_rezervare bigint not null, "
            "suma_achitata decimal(10,2) not null, data_plata timestamp_ntz not null, "
            "metoda_plata string not null, status string not null",
            "id_plata",
            unique=(("id_plata",),),
            foreign=(("id_rezervare", "rezervare", "id_rezervare"),),
            checks={
                "payment_amount": _positive("suma_achitata"),
                "payment_method": _one_of("metoda_plata", PAYMENT_METHOD),
                "payment_status": _one_of("status", PAYMENT_STATUS),
            },
            defaults={"data_plata": AS_OF, "status": "IN_PROCESARE"},
        ),
        Relation(
            "bilet",
            "id_bilet bigint not null, id_rezervare bigint not null, id_zbor bigint not null, "
            "id_pasager bigint not null, numar_rand bigint not null, "
            "litera_scaun string not null, clasa string not null, "
            "pret_final decimal(10,2) not null",
            "id_bilet",
            unique=(("id_bilet",), ("id_zbor", "numar_rand", "litera_scaun")),
            foreign=(
                ("id_rezervare", "rezervare", "id_rezervare"),
                ("id_zbor", "zbor", "id_zbor"),
                ("id_pasager", "pasager", "id_pasager"),
            ),
            checks={
                "ticket_row": _within("numar_rand", 0, 100),
                "ticket_letter": _one_of("litera_scaun", SEAT_LETTERS),
                "ticket_class": _one_of("clasa", TRAVEL_CLASS),
                "ticket_price": _positive("pret_final"),
            },
            defaults={"clasa": "ECONOMY"},
        ),
    ]
}

#: Columns of the two vertical fragments of the user relation (the key is in both).
USER_FRAGMENTS = {
    "utilizator_sec": ["email", "parola", "rol"],
    "utilizator_data": ["nume", "prenume", "telefon", "data_inregistrare"],
}

#: Relations kept as full copies on every site, and those kept on the central site only.
REPLICATED = ["tara", "oras", "aeroport", "avion", "zbor", "utilizator_data"]
CENTRAL = ["pasager", "utilizator_sec"]
#: Relations split by row over the sites.
SPLIT = ["rezervare", "plata", "bilet"]
#: Replicated relations that are pushed to the copies as they change. Airports have no
#: propagation at all, and flights are refreshed on demand.
EAGER_REPLICAS = ["tara", "oras", "avion", "utilizator_data"]
ON_DEMAND_REPLICAS = ["zbor"]


def table_schema(name: str) -> tuple[T.StructType, str]:
    """Schema and key of a stored table: a relation, or a vertical fragment of the users."""
    if name in USER_FRAGMENTS:
        whole = RELATIONS["utilizator"].schema
        return T.StructType([whole["id_user"], *[whole[c] for c in USER_FRAGMENTS[name]]]), "id_user"
    return RELATIONS[name].schema, RELATIONS[name].key


def conform(df: DataFrame, schema: T.StructType, dates: tuple[str, ...] = ()) -> DataFrame:
    """Cast ``df`` to a declared schema.

    Casts are strict (ANSI): a value that does not fit fails the job. Empty strings become
    NULL, ``dates`` lose their fraction of a second, decimals round half-up.
    """
    columns = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            value = F.nullif(value, F.lit(""))
        elif f.name in dates:
            value = to_second(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def with_defaults(df: DataFrame, relation: Relation, as_of=None, **site_defaults) -> DataFrame:
    """Fill missing values on insert; columns the rows lack altogether are added."""
    from sitefold.functions import instant

    types = {f.name: f.dataType for f in relation.schema.fields}
    out = {}
    for name, value in {**relation.defaults, **site_defaults}.items():
        default = instant(as_of) if value is AS_OF else F.lit(value)
        default = default.cast(types[name])
        out[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(out)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
