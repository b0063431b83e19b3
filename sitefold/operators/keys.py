"""Surrogate keys: dense numbering without a single-task sort, remapping, allocation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import order_keys
from sitefold.session import materialize

# Layout of monotonically_increasing_id: partition number above, row in partition below.
_ROW_BITS = 33

#: (start, step) of the key sequence of each site: odd keys on AM, even keys on EU.
SITE_SEQUENCE = {"AM": (1, 2), "EU": (2, 2)}


def dense_row_number(
    df: DataFrame, order: list, by: tuple[str, ...] = (), out: str = "rn"
) -> DataFrame:
    """Row numbers 1..n in ``order`` (restarting for each ``by``), added as ``out``.

    A window without partitions would sort everything in one task, and one with a hot
    ``by`` value nearly everything. Here the rows are range-partitioned on (by, order) and
    numbered inside each partition; the result is written once, because a second run of
    the range sampling could place rows differently; then each (partition, by) run is
    shifted by the rows of that ``by`` before it. Only one row per run takes part in that
    last step, so a hot ``by`` value is spread over as many tasks as it needs.

    ``order`` should be unique; rows that tie are numbered in an arbitrary order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = order_keys([*by, *order])
    placed = materialize(
        df.repartitionByRange(parts, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS)),
        "numbered",
    )
    runs = placed.groupBy("_part", *by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_lo")
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = runs.select(
        F.col("_part").alias("_p"),
        *[F.col(b).alias(f"_by_{b}") for b in by],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_lo") + 1).alias("_shift"),
    )
    same_run = F.col("_part") == F.col("_p")
    for b in by:
        same_run = same_run & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return (
        placed.join(shift, same_run)
        .withColumn(out, F.col("_at") + F.col("_shift"))
        .select(*df.columns, out)
    )


def remap_keys(
    df: DataFrame, key: str, start: int, step: int, order: list | None = None, out: str = "new_id"
) -> DataFrame:
    """Key map of one fragment: every row with its new key ``start + step * (rn - 1)``."""
    numbered = dense_row_number(df, order or [key], out="_rn")
    return numbered.withColumn(out, F.lit(start) + F.lit(step) * (F.col("_rn") - 1)).drop("_rn")


def remap_keys_by_site(
    df: DataFrame, key: str, site: str, sequences: dict[str, tuple[int, int]] | None = None,
    order: list | None = None, out: str = "new_id",
) -> DataFrame:
    """Key maps of all fragments in one pass; ``site`` names the fragment of each row."""
    sequences = sequences or SITE_SEQUENCE
    numbered = dense_row_number(
        df.filter(F.col(site).isin(list(sequences))), order or [key], by=(site,), out="_rn"
    )
    new_key = F.lit(None).cast("bigint")
    for name, (start, step) in sequences.items():
        new_key = F.when(
            F.col(site) == name, F.lit(start) + F.lit(step) * (F.col("_rn") - 1)
        ).otherwise(new_key)
    return numbered.withColumn(out, new_key).drop("_rn")


def remap_children(
    child: DataFrame, key_map: DataFrame, fk: str, key: str, start: int, step: int,
    order: list | None = None,
) -> DataFrame:
    """Children of one fragment with their own new keys and the parent's new key.

    ``key_map`` holds (old_id, new_id) of the parent fragment; children of other fragments
    drop out in the join.
    """
    names = child.columns
    moved = child.join(
        key_map.select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new")),
        F.col(fk) == F.col("_old"),
    )
    numbered = remap_keys(moved.drop("_old"), key, start, step, order=order, out="_own")
    return numbered.select(
        *[
            F.col("_own").alias(key) if c == key else F.col("_new").alias(fk) if c == fk else F.col(c)
            for c in names
        ]
    )


def next_key(df: DataFrame, key: str, start: int, step: int) -> DataFrame:
    """One row: the key that follows the largest one; ``start`` for an empty table."""
    following = F.coalesce(F.max(key), F.lit(start - step)) + step
    return df.agg(following.cast("bigint").alias("next_key"))


def next_keys(tables: dict[str, tuple[DataFrame, str]], start: int, step: int) -> dict[str, int]:
    """The next key of several tables, ``{name: (table, key)}``, found in one job."""
    each = [
        next_key(df, key, start, step).withColumn("name", F.lit(name))
        for name, (df, key) in tables.items()
    ]
    return {row.name: row.next_key for row in reduce(DataFrame.unionByName, each).collect()}


def allocate_keys(
    new: DataFrame, order: list, key: str, next_value: int, step: int
) -> DataFrame:
    """Give new rows the keys ``next_value, next_value + step, …`` in ``order``."""
    numbered = dense_row_number(new, order, out="_rn")
    return numbered.withColumn(
        key, F.lit(next_value) + F.lit(step) * (F.col("_rn") - 1)
    ).drop("_rn")


def hand_down_keys(children: DataFrame, owners: DataFrame, tag: str, key: str) -> DataFrame:
    """Children take the key their owner was given; both carry the client's row ``tag``."""
    return children.join(owners.select(tag, key), tag)
