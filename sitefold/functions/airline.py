"""Derivation rules of the booking domain: price, flight status, booking state, seats."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold.functions.semantics import _col, instant, money

# Seat layout per aircraft model (letters, last row) and the default layout.
SEAT_MODELS = [
    ("Boeing 737-800", ["A", "B", "C", "D", "E", "F"], 32),
    ("Airbus A320", ["A", "B", "C", "D", "E", "F"], 30),
    ("Boeing 737-700", ["A", "B", "C", "D", "E", "F"], 25),
    ("Boeing 737 MAX 8", ["A", "B", "C", "D", "E", "F"], 34),
    ("ATR 72-600", ["A", "C", "D", "F"], 18),
]
DEFAULT_LAYOUT = (["A", "B", "C", "D", "E", "F"], 30)


def seat_models(spark: SparkSession) -> DataFrame:
    """The seat-layout dimension: one row per known model."""
    return spark.createDataFrame(SEAT_MODELS, "model string, cols array<string>, max_row int")


def seat_fits(row, letter, cols, max_row) -> Column:
    """Seat exists in the layout; an unknown model (NULL layout) uses the default layout."""
    letters = F.coalesce(_col(cols), F.array(*[F.lit(c) for c in DEFAULT_LAYOUT[0]]))
    last = F.coalesce(_col(max_row), F.lit(DEFAULT_LAYOUT[1]))
    return F.array_contains(letters, _col(letter)) & (_col(row) >= 1) & (_col(row) <= last)


def ticket_price(standard, travel_class, factor="1.5") -> Column:
    """Business costs ``factor`` times the standard price; rounded half-up to cents."""
    rate = F.lit(Decimal(str(factor)))
    base = money(standard)
    return F.when(_col(travel_class) == "BUSINESS", (base * rate).cast("decimal(10,2)")).otherwise(base)


def status_at(departure, effective_departure, effective_arrival, cancelled, as_of) -> Column:
    """Status of a flight at ``as_of``."""
    now = instant(as_of)
    left = F.coalesce(_col(effective_departure), _col(departure))
    return (
        F.when(_col(departure) > now, "PROGRAMAT")
        .when(_col(cancelled), "ANULAT")
        .when(left > now, "INTARZIAT")
        .when(_col(effective_arrival) > now, "IN_ZBOR")
        .otherwise("ATERIZAT")
    )


def booking_state(flight_status) -> tuple[Column, Column]:
    """(booking status, payment status) that follow from the status of the flight."""
    off = _col(flight_status) == "ANULAT"
    return (
        F.when(off, "ANULATA").otherwise("CONFIRMATA"),
        F.when(off, "RAMBURSATA").otherwise("ACCEPTATA"),
    )
