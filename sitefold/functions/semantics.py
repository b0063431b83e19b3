"""Column expressions for the source database's NULL, ordering, date and string rules.

Everything here is built from JVM-side Spark expressions, so it stays inside codegen and
can be pushed to the scan where Spark allows it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the e-mail pattern of the source schema.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- NULL and ordering -----------------------------------------------------------------


def asc(column) -> Column:
    """Ascending with NULLs last."""
    return _col(column).asc_nulls_last()


def desc(column) -> Column:
    """Descending with NULLs first."""
    return _col(column).desc_nulls_first()


def order_keys(keys) -> list[Column]:
    """Turn ``["a", ("b", "desc")]`` into sort columns with the source's NULL placement."""
    out = []
    for key in keys:
        column, way = key if isinstance(key, tuple) else (key, "asc")
        out.append(desc(column) if way == "desc" else asc(column))
    return out


def check_fails(predicate: Column) -> Column:
    """A row rule is broken only when its predicate is false; NULL passes."""
    return ~F.coalesce(predicate, F.lit(True))


def nvl(column, default) -> Column:
    return F.coalesce(_col(column), F.lit(default))


# --- strings ---------------------------------------------------------------------------


def cat(*parts) -> Column:
    """Concatenation that skips NULLs; NULL only when nothing is left (empty is NULL)."""
    return F.nullif(F.concat_ws("", *[_col(p) for p in parts]), F.lit(""))


def is_upper(column) -> Column:
    return _col(column) == F.upper(_col(column))


def len_in(column, *lengths: int) -> Column:
    return F.length(_col(column)).isin(*lengths)


def email_ok(column) -> Column:
    return _col(column).rlike(EMAIL_PATTERN)


def row_label(template: str, *columns) -> Column:
    """Label for a pick list; ``{}`` marks the places of ``columns``. NULL becomes empty."""
    pieces = template.split("{}")
    if len(pieces) != len(columns) + 1:
        raise ValueError(f"{template!r} has {len(pieces) - 1} places for {len(columns)} columns")
    parts = [F.lit(pieces[0])]
    for column, text in zip(columns, pieces[1:], strict=True):
        parts += [_col(column).cast("string"), F.lit(text)]
    return F.concat_ws("", *parts)


# --- numbers ---------------------------------------------------------------------------


def money(column) -> Column:
    """Two decimals, half-up (also for binary noise such as 512.4000000000001)."""
    return _col(column).cast("decimal(10,2)")


def cents(amount) -> Column:
    """Money as whole cents. Sums of integers stay in fast fixed-width buffers and are exact;
    beyond 9·10^16 units a sum fails (ANSI) instead of being wrong."""
    return (_col(amount) * 100).cast("bigint")


def from_cents(total) -> Column:
    return (_col(total).cast("decimal(20,0)") / 100).cast("decimal(28,2)")


def occupancy_pct(sold, capacity) -> Column:
    """``sold`` in percent of ``capacity``, two decimals half-up, computed in decimals."""
    return F.round(_col(sold).cast("decimal(18,0)") * 100 / _col(capacity).cast("decimal(10,0)"), 2)


def route_site(key) -> Column:
    """Owner site by key parity. ``%`` keeps the sign, so negative odd keys are odd too."""
    return F.when(_col(key) % 2 != 0, "AM").otherwise("EU")


# --- time ------------------------------------------------------------------------------


def instant(value) -> Column:
    """A fixed point in time as a zone-less timestamp; columns pass through."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def to_second(column) -> Column:
    """Drop the fraction of a second without going through the session time zone."""
    c = _col(column)
    fraction = F.extract(F.lit("SECOND"), c) % F.lit(1)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def months_back(ts, months: int) -> Column:
    """The same time of day ``months`` earlier; the last day of a month stays a last day."""
    c = instant(ts) if not isinstance(ts, Column) else ts
    moved = c - F.make_ym_interval(F.lit(0), F.lit(months))
    midnight = F.to_date(c).cast("timestamp_ntz")
    month_end = F.last_day(moved).cast("timestamp_ntz") + (c - midnight)
    return F.when(F.to_date(c) == F.last_day(c), month_end).otherwise(moved)


def fmt_minute(ts) -> Column:
    """``2026-01-11 12:00``; cut from the text form, which no time zone shifts."""
    return F.substring(_col(ts).cast("timestamp_ntz").cast("string"), 1, 16)
