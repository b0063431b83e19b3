from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sitefold.functions as fn
from sitefold.operators.relational import any_n, mode_by, order, rank_counts, top_k


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, months, expected",
    [
        ("2026-01-11 12:34:56", 6, "2025-07-11 12:34:56"),
        ("2016-02-29 10:00:00", -1, "2016-03-31 10:00:00"),
        ("2026-08-31 23:59:59", 6, "2026-02-28 23:59:59"),
        ("2025-04-30 00:00:00", 2, "2025-02-28 00:00:00"),
        ("2024-03-30 05:00:00", 1, "2024-02-29 05:00:00"),
    ],
)
def test_months_back_keeps_time_and_month_end(spark, start, months, expected):
    assert one(spark, fn.months_back(at(start), months)) == datetime.fromisoformat(expected)


def test_concat_skips_null_and_empty_is_null(spark):
    assert one(spark, fn.cat(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert one(spark, fn.cat(F.lit(None).cast("string"))) is None


def test_null_order(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "k int, v int")
    assert [r.k for r in order(df, [("v", "desc")]).collect()] == [1, 3, 2]
    assert [r.k for r in order(df, ["v"]).collect()] == [2, 3, 1]


def test_rule_passes_on_null(spark):
    assert one(spark, fn.check_fails(F.lit(None).cast("boolean"))) is False
    assert one(spark, fn.check_fails(F.lit(False))) is True


def test_parity_of_negative_keys(spark):
    df = spark.createDataFrame([(-3,), (-2,), (0,), (7,)], "k long")
    assert [r.s for r in df.select(fn.route_site("k").alias("s")).collect()] == ["AM", "EU", "EU", "AM"]


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(512.4000000000001,), (1831.1999999999998,), (2.675,), (2.665,)], "x double")
    assert [str(r.m) for r in df.select(fn.money("x").alias("m")).collect()] == ["512.40", "1831.20", "2.68", "2.67"]


def test_ticket_price(spark):
    df = spark.createDataFrame([("BUSINESS",), ("ECONOMY",)], "c string")
    new = [r.p for r in df.select(fn.ticket_price(F.lit(328), "c").alias("p")).collect()]
    old = [r.p for r in df.select(fn.ticket_price(F.lit(328), "c", "1.8").alias("p")).collect()]
    assert new == [Decimal("492.00"), Decimal("328.00")]
    assert old == [Decimal("590.40"), Decimal("328.00")]


def test_occupancy_half_up_and_division_by_zero(spark):
    assert one(spark, fn.occupancy_pct(F.lit(1), F.lit(800))) == Decimal("0.13")  # 0.125
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.createDataFrame([(1, 0)], "n int, c int").select(fn.occupancy_pct("n", "c")).collect()


def test_mode_ignores_null_and_takes_lowest_of_ties(spark):
    data = [(1, "b"), (1, "a"), (1, None), (1, None), (2, None), (3, "x"), (3, "x"), (3, "a")]
    df = spark.createDataFrame(data, "k int, v string")
    assert sorted(tuple(r) for r in mode_by(df, "k", "v").collect()) == [(1, "a"), (2, None), (3, "x")]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (1, "c")], "k int, v string")
    ranks = {r.v: r.rnk for r in rank_counts(df, "k", "v").collect()}
    assert ranks == {"c": 1, "a": 2, "b": 2}


def test_top_k_and_any_n_are_repeatable(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "k int, v int").repartition(5)
    assert [r.k for r in top_k(df, [("v", "desc"), "k"], 3).collect()] == [2, 5, 8]
    assert [r.k for r in any_n(df, "k", 4).collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize(
    "row",
    [
        # departure, effective departure, effective arrival, cancelled, status at noon
        ("13:00", None, None, False, "PROGRAMAT"),
        ("13:00", None, None, True, "PROGRAMAT"),
        ("09:00", None, None, True, "ANULAT"),
        ("09:00", "12:30", "15:00", False, "INTARZIAT"),
        ("09:00", "12:00", "12:01", False, "IN_ZBOR"),
        ("09:00", "09:00", "12:00", False, "ATERIZAT"),
    ],
)
def test_status_at(spark, row):
    dep, eff, arr, off, expected = row
    times = [at(f"2026-01-11 {t}:00") if t else F.lit(None).cast("timestamp_ntz") for t in (dep, eff, arr)]
    assert one(spark, fn.status_at(*times, F.lit(off), "2026-01-11 12:00:00")) == expected


def test_booking_state(spark):
    for status, expected in (("ANULAT", ("ANULATA", "RAMBURSATA")), ("ATERIZAT", ("CONFIRMATA", "ACCEPTATA"))):
        assert tuple(one(spark, c) for c in fn.booking_state(F.lit(status))) == expected


def test_email_upper_length_label(spark):
    df = spark.createDataFrame([("a.b@c.ro",), ("a@b",), ("x y@z.com",)], "e string")
    assert [r.ok for r in df.select(fn.email_ok("e").alias("ok")).collect()] == [True, False, False]
    assert one(spark, fn.is_upper(F.lit("Ro"))) is False
    assert one(spark, fn.len_in(F.lit("ROU"), 2, 3)) is True
    label = fn.row_label("Rez #{} ({})", F.lit(7), F.lit(None).cast("string"))
    assert one(spark, label) == "Rez #7 ()"
    with pytest.raises(ValueError):
        fn.row_label("{} {}", F.lit(1))
    assert one(spark, fn.nvl(F.lit(None).cast("string"), "N/A")) == "N/A"


def test_second_precision(spark):
    # An hour that daylight saving skips in the session's zone must survive.
    assert one(spark, fn.to_second(at("2024-03-10 02:30:15.987"))) == datetime(2024, 3, 10, 2, 30, 15)
    assert one(spark, fn.fmt_minute(at("2024-03-10 02:30:15.987"))) == "2024-03-10 02:30"


def test_seat_layout(spark):
    seats = [("Boeing 737-800", 32, "F"), ("ATR 72-600", 18, "B"), ("ATR 72-600", 19, "A"), ("Other", 30, "F"),
             ("Other", 31, "A"), ("Airbus A320", 0, "A")]
    df = spark.createDataFrame(seats, "model string, r int, l string").join(fn.seat_models(spark), "model", "left")
    got = {(r.model, r.r, r.l): r.ok for r in df.select("*", fn.seat_fits("r", "l", "cols", "max_row").alias("ok")).collect()}
    assert [got[s] for s in seats] == [True, False, False, True, False, False]
