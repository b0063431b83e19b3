"""Change batches: capture, apply, route to the owning fragment.

A change row is ``(seq, op, key, columns…)`` with op I, U or D and ``seq`` unique. Batches
are applied as sets; the outcome is the one of applying the rows one by one in ``seq`` order.
Changes are first collapsed to one row per key by an aggregation, so a key that holds a large
share of the batch is reduced before the shuffle and never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.functions import route_site
from sitefold.operators.keys import dense_row_number
from sitefold.session import materialize

INSERT, UPDATE, DELETE = "I", "U", "D"


class ChangeConflict(ValueError):
    """A change that the target refuses."""


def collapse(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key with what its changes amount to.

    born: an insert follows the last delete, so the key exists afterwards.
    gone: a delete is not followed by an insert, so it does not.
    neither: only updates; they count when the key exists already.
    """
    last_write = F.when(F.col("op") != DELETE, F.col("seq"))
    per_key = changes.groupBy(known_key(key).alias("_key")).agg(
        F.max_by(F.struct(*columns), last_write).alias("_row"),
        F.max(last_write).alias("_written"),
        F.max(F.when(F.col("op") == DELETE, F.col("seq"))).alias("_removed"),
        F.max(F.when(F.col("op") == INSERT, F.col("seq"))).alias("_inserted"),
        F.max("seq").alias("_seq"),
    )
    born = F.coalesce(F.col("_inserted") > F.coalesce(F.col("_removed"), F.col("_inserted") - 1), F.lit(False))
    return per_key.withColumns({"_born": born, "_gone": F.col("_removed").isNotNull() & ~born})


def known_key(key: str) -> Column:
    """The key column of changes; a change without a key fails the job."""
    missing = F.raise_error(F.lit(f"a change without {key}"))
    return F.when(F.col(key).isNull(), missing).otherwise(F.col(key))


def insert_conflicts(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Keys that a change inserts while they exist.

    Only I and D matter. An I is refused when the previous I/D of the key is an I, or when
    there is none and the target holds the key. Rows are numbered in (key, seq) order and
    each meets its predecessor by number, so a hot key is spread like any other rows.
    """
    flips = changes.filter(F.col("op") != UPDATE).select(F.col(key).alias("_key"), "op", "seq")
    numbered = dense_row_number(flips, ["_key", "seq"], out="_rn")
    previous = numbered.select(
        (F.col("_rn") + 1).alias("_rn"), F.col("_key").alias("_prev_key"), F.col("op").alias("_prev_op")
    )
    inserts = numbered.filter(F.col("op") == INSERT).join(previous, "_rn", "left")
    follows = F.coalesce(F.col("_prev_key") == F.col("_key"), F.lit(False))
    doubled = inserts.filter(follows & (F.col("_prev_op") == INSERT)).select("_key")
    opening = inserts.filter(~follows).select("_key")
    held = opening.join(target.select(key), F.col("_key") == F.col(key), "left_semi")
    return doubled.unionByName(held).distinct().withColumnRenamed("_key", key)


def apply_changes(target: DataFrame, changes: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """``target`` after a batch of changes.

    Updates set every non-key column and never the key; an update or delete of an absent key
    does nothing. An insert of a present key replaces the row, or fails when ``strict``. A
    change without a key fails. Keys of the target are unique and not NULL.

    The batch is collapsed once and written, so Spark knows its size: it broadcasts a small
    one and reads the target in place, and shuffles both for a large one, with one result.
    """
    if strict and (bad := insert_conflicts(target, changes, key).take(5)):
        raise ChangeConflict(f"insert of a present {key}: {[row[0] for row in bad]}")
    columns = [c for c in target.columns if c != key]
    collapsed = collapse(changes, key, columns).select("_key", "_row", "_born", "_gone")
    batch = materialize(collapsed, "changes").withColumn("_changed", F.lit(True))
    changed = F.coalesce("_changed", F.lit(False))

    def value(c: str) -> Column:
        return F.when(changed, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c)

    kept = (
        target.join(batch, F.col(key) == F.col("_key"), "left")
        .filter(~F.coalesce("_gone", F.lit(False)))
        .select(*[F.col(c) if c == key else value(c) for c in target.columns])
    )
    held = target.select(key).join(batch.select("_key"), F.col(key) == F.col("_key"), "left_semi")
    added = (
        batch.filter("_born")
        .join(held, F.col("_key") == F.col(key), "left_anti")
        .select(*[F.col("_key").alias(c) if c == key else F.col(f"_row.{c}").alias(c) for c in target.columns])
    )
    return kept.unionByName(added)


def capture_changes(
    before: DataFrame, after: DataFrame, key: str, start_seq: int | None = None
) -> DataFrame:
    """Changes that lead from ``before`` to ``after``: op, key and the new column values.

    Deletes carry NULL columns. ``start_seq`` numbers the rows by key from that value on.
    """
    columns = [c for c in before.columns if c != key]
    old = before.select(F.col(key).alias("_k0"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_k1"), F.struct(*columns).alias("_new"))
    op = (
        F.when(F.col("_k0").isNull(), INSERT)
        .when(F.col("_k1").isNull(), DELETE)
        .when(~F.col("_old").eqNullSafe(F.col("_new")), UPDATE)
    )
    log = (
        old.join(new, F.col("_k0") == F.col("_k1"), "full")
        .select(
            op.alias("op"),
            F.coalesce("_k0", "_k1").alias(key),
            *[F.col(f"_new.{c}").alias(c) for c in columns],
        )
        .filter(F.col("op").isNotNull())
    )
    if start_seq is None:
        return log
    return dense_row_number(log, [key], out="seq").withColumn("seq", F.col("seq") + (start_seq - 1))


def compare_replicas(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every key of two copies with its state: same, diff, only_a or only_b."""
    columns = [c for c in a.columns if c != key]
    left = a.select(F.col(key).alias("_ka"), F.struct(*columns).alias("_a"))
    right = b.select(F.col(key).alias("_kb"), F.struct(*columns).alias("_b"))
    state = (
        F.when(F.col("_kb").isNull(), "only_a")
        .when(F.col("_ka").isNull(), "only_b")
        .when(F.col("_a").eqNullSafe(F.col("_b")), "same")
        .otherwise("diff")
    )
    return left.join(right, F.col("_ka") == F.col("_kb"), "full").select(
        F.coalesce("_ka", "_kb").alias(key), state.alias("state")
    )


# --- partial updates -------------------------------------------------------------------


def last_values(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per key and column, the value of the last change that sets the column.

    ``changes.sets`` lists the columns a change sets; without it every change sets them all.
    Each value is wrapped in a struct, NULL when no change set the column, so that setting
    a column to NULL is kept apart from not setting it.
    """
    partial = "sets" in changes.columns

    def latest(c: str) -> Column:
        when_set = F.when(F.array_contains("sets", c), F.col("seq")) if partial else F.col("seq")
        return F.max_by(F.struct(F.col(c).alias("v")), when_set).alias(f"_set_{c}")

    return changes.groupBy(F.col(key).alias("_key")).agg(*[latest(c) for c in columns])


def update_by_key(
    target: DataFrame, updates: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Set ``columns`` of the rows named by key; keys that are absent do nothing."""
    batch = last_values(updates, key, columns)
    return target.join(batch, F.col(key) == F.col("_key"), "left").select(
        *[
            F.when(F.col(f"_set_{c}").isNotNull(), F.col(f"_set_{c}.v")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def delete_by_key(target: DataFrame, keys: DataFrame, key: str, of: str | None = None) -> DataFrame:
    """Drop the rows whose ``key`` is in ``keys[of]`` (own key or the owner's key)."""
    gone = keys.select(F.col(of or key).alias("_gone"))
    return target.join(gone, F.col(key) == F.col("_gone"), "left_anti")


# --- updates through the global views --------------------------------------------------

#: Columns an update of a global view writes; other changed columns are dropped. Views that
#: are not listed refuse changes, and no view takes inserts or deletes.
VIEW_WRITABLE = {
    "v_rezervare": ["status", "total_de_plata"],
    "v_utilizator": ["nume", "prenume", "telefon"],
}


def accept_view_changes(view: str, changes: DataFrame) -> list[str]:
    """Writable columns of ``view``; refuses views and operations without an update rule."""
    if view not in VIEW_WRITABLE:
        raise ChangeConflict(f"{view} takes no changes")
    if changes.filter(F.col("op") != UPDATE).take(1):
        raise ChangeConflict(f"{view} takes updates only")
    return VIEW_WRITABLE[view]


def route_update(
    view: str, changes: DataFrame, fragments: dict[str, DataFrame], key: str,
    route: Callable[[Column], Column] = route_site,
) -> dict[str, DataFrame]:
    """Update a horizontally split relation: each change goes to the fragment of its key."""
    writable = accept_view_changes(view, changes)
    owner = route(F.col(key))
    columns = [c for c in writable if c in changes.columns]
    return {
        site: update_by_key(fragment, changes.filter(owner == site), key, columns)
        for site, fragment in fragments.items()
    }


def route_update_vertical(view: str, changes: DataFrame, data: DataFrame, key: str) -> DataFrame:
    """Update a vertically split relation: only the profile fragment takes changes."""
    writable = accept_view_changes(view, changes)
    return update_by_key(data, changes, key, [c for c in writable if c in changes.columns])


def cancel_bookings(
    ids: DataFrame, bookings: dict[str, DataFrame], payments: dict[str, DataFrame],
    route: Callable[[Column], Column] = route_site,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Cancel bookings by id: the booking at the site of its key, and all of its payments.

    Payments are looked up in every fragment by booking id and refunded whatever their state.
    """
    wanted = ids.select(F.col("id_rezervare").alias("_id")).distinct()

    def mark(df: DataFrame, hit: DataFrame, status: str) -> DataFrame:
        marked = df.join(hit.withColumn("_hit", F.lit(True)), F.col("id_rezervare") == F.col("_id"), "left")
        state = F.when(F.col("_hit"), F.lit(status)).otherwise(F.col("status"))
        return marked.withColumn("status", state).select(*df.columns)

    return (
        {s: mark(df, wanted.filter(route(F.col("_id")) == s), "ANULATA") for s, df in bookings.items()},
        {s: mark(df, wanted, "RAMBURSATA") for s, df in payments.items()},
    )
