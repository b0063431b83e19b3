"""Projection, filter, join, aggregate, ranking and top-k building blocks of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import order_keys
from sitefold.session import materialize
from sitefold.sources.sites import SiteCatalog

# --- projection and filters ------------------------------------------------------------


def project(df: DataFrame, columns: list[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """Columns in the given order, renamed by ``aliases``."""
    names = aliases or {}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in columns])


_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def where_cmp(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """Comparison with a bound value; rows with a NULL on either side drop out."""
    return df.filter(_COMPARE[op](F.col(column), value if isinstance(value, Column) else F.lit(value)))


def where_in(df: DataFrame, column: str, values: list, negate: bool = False) -> DataFrame:
    inside = F.col(column).isin(values)
    return df.filter(~inside if negate else inside)


def where_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """``low < column <= high``."""
    return df.filter((F.col(column) > low) & (F.col(column) <= high))


def where_exists(df: DataFrame, other: DataFrame, on: dict[str, str], negate: bool = False) -> DataFrame:
    """EXISTS / NOT EXISTS on equal columns; ``on`` maps columns of ``df`` to ``other``.

    A NULL on the left matches nothing, so NOT EXISTS keeps that row.
    """
    side = other.select(*[F.col(o).alias(f"_x_{d}") for d, o in on.items()])
    match = F.lit(True)
    for d in on:
        match = match & (F.col(d) == F.col(f"_x_{d}"))
    return df.join(side, match, "left_anti" if negate else "left_semi")


def distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


# --- joins -----------------------------------------------------------------------------


def join_chain(df: DataFrame, steps: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Inner equi-joins in the written order; ``on`` maps columns so far to the new table.

    The joined column of the new table is dropped when it has the same name.
    """
    for other, on in steps:
        side = other.withColumnsRenamed({o: f"_j_{o}" for o in on.values()})
        match = F.lit(True)
        for left, right in on.items():
            match = match & (F.col(left) == F.col(f"_j_{right}"))
        df = df.join(side, match)
        keep = {o for o in on.values() if o not in df.columns}
        df = df.withColumnsRenamed({f"_j_{o}": o for o in keep}).drop(
            *[f"_j_{o}" for o in on.values() if o not in keep]
        )
    return df


def join_roles(df: DataFrame, dim: DataFrame, key: str, roles: dict[str, str]) -> DataFrame:
    """Join one dimension once per role: ``{suffix: foreign key}``; columns get the suffix."""
    for suffix, fk in roles.items():
        attributes = [F.col(c).alias(f"{c}_{suffix}") for c in dim.columns if c != key]
        side = dim.select(F.col(key).alias("_role"), *attributes)
        df = df.join(side, F.col(fk) == F.col("_role")).drop("_role")
    return df


def join_hashed(
    df: DataFrame, dims: list[tuple[DataFrame, dict[str, str]]], shuffled: bool = False
) -> DataFrame:
    """Joins in the written order, each as a hash join.

    Spark broadcasts a dimension whose bytes fit its own threshold. ``shuffled`` asks for hash
    tables per partition instead, for dimensions that are beyond it.
    """
    return join_chain(df, [(d.hint("shuffle_hash") if shuffled else d, on) for d, on in dims])


def join_site(df: DataFrame, catalog: SiteCatalog, site: str, name: str, on: str) -> DataFrame:
    """Join with a table of another site."""
    return df.join(catalog.table(site, name), on)


def join_where(df: DataFrame, other: DataFrame, on: str, condition: Column) -> DataFrame:
    """Equi-join with an extra condition on ``other``, applied before the join."""
    return df.join(other.filter(condition), on)


# --- aggregates and ranking ------------------------------------------------------------


def totals(df: DataFrame, key: str, aggregates: dict[str, Column]) -> DataFrame:
    return df.groupBy(key).agg(*[a.alias(name) for name, a in aggregates.items()])


def counts(df: DataFrame, keys: list[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def max_or(df: DataFrame, column: str, default) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias("max_value"))


def most_frequent(value: str, count: str) -> Column:
    """Aggregate over (value, count) rows: the value with the largest count.

    NULL values do not compete, the lowest of tied values wins.
    """
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))))
    return best["v"]


def mode_by(df: DataFrame, key: str, value: str, out: str = "mode") -> DataFrame:
    """Most frequent value of each key.

    Counted by (key, value) first: partial counts collapse before the shuffle, a hot key is
    spread by its values, and no task ever holds a key's values in one buffer.
    """
    return counts(df, [key, value], "_n").groupBy(key).agg(most_frequent(value, "_n").alias(out))


def rank_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count per (key, value) and its rank within the key; ties share a rank.

    The rank is one more than the number of values with a larger count. It is found per
    distinct count of the key: n rows have at most about sqrt(2n) distinct counts, so even a
    key with very many values is a short group there.
    """
    per_value = counts(df, [key, value])
    larger = Window.partitionBy("_key").orderBy(F.col("_cnt").desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        per_value.groupBy(F.col(key).alias("_key"), F.col("cnt").alias("_cnt"))
        .agg(F.count(F.lit(1)).alias("_values"))
        .select("_key", "_cnt", (F.coalesce(F.sum("_values").over(larger), F.lit(0)) + 1).alias("rnk"))
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("cnt") == F.col("_cnt"))
    return per_value.join(levels, same).select(key, value, "cnt", "rnk")


def match_count(df: DataFrame, other: DataFrame, on: list[str], out: str = "matches") -> DataFrame:
    """Number of rows of ``other`` with the same ``on`` values; 0 when there are none.

    ``other`` is counted per key before the join, so copies of a key do not multiply rows.
    """
    found = other.groupBy(*on).agg(F.count(F.lit(1)).alias(out))
    return df.join(found, on, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


# --- order and limits ------------------------------------------------------------------


def order(df: DataFrame, keys: list) -> DataFrame:
    return df.orderBy(*order_keys(keys))


def top_k(df: DataFrame, keys: list, k: int) -> DataFrame:
    """First ``k`` rows in order; end ``keys`` with a unique column. Keeps k rows per task."""
    return df.orderBy(*order_keys(keys)).limit(k)


def top_k_join(
    df: DataFrame, other: DataFrame, on: str, keys: list, k: int, slack: int = 20
) -> DataFrame:
    """First ``k`` rows of ``df`` ⋈ ``other``, ordered by columns of ``df``.

    Joining everything would shuffle both tables for k rows. The first ``slack * k`` rows of
    ``df`` are found in one pass, broadcast (their number is fixed) and joined by scanning
    ``other``. When at least k joined rows come out they are the result, because every row
    outside sorts later. Otherwise, with many partnerless rows or a short table, the whole
    join is run.
    """
    head = F.broadcast(top_k(df, keys, slack * k))
    near = materialize(other.join(head, on), "near")
    enough = near.limit(k).count() >= k
    return top_k(near if enough else df.join(other, on), keys, k)


def any_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows; the lowest keys, so that repeated runs agree."""
    return top_k(df, [key], n)
