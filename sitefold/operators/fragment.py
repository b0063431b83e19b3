"""Fragmentation: by row (primary and derived), by column, copies, and its verification."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.sources.sites import SiteCatalog

#: Source rows that one task of a verification is meant to group; how many tasks there are follows from it.
TASK_ROWS = 250_000


def fragment_horizontal(df: DataFrame, predicates: dict[str, Column]) -> dict[str, DataFrame]:
    """Primary horizontal fragments: the rows that satisfy each predicate.

    Each fragment is a plain filter, so it reaches the scan of the source.
    """
    return {name: df.filter(predicate) for name, predicate in predicates.items()}


def write_fragments(df: DataFrame, by: str, path: str) -> None:
    """Write all fragments of an equality predicate in one pass, one folder per value.

    Rebalancing on the value keeps the files few and still splits a hot value over tasks.
    """
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def fragment_derived(child: DataFrame, owner: DataFrame, fk: str, key: str) -> DataFrame:
    """Derived horizontal fragment: children whose owner row is in the owner's fragment."""
    owners = owner.select(F.col(key).alias("_owner"))
    return child.join(owners, F.col(fk) == F.col("_owner"), "left_semi")


def fragment_vertical(
    df: DataFrame, key: str, groups: dict[str, list[str]]
) -> dict[str, DataFrame]:
    """Vertical fragments: the key plus a group of columns each."""
    return {name: df.select(key, *columns) for name, columns in groups.items()}


def replicate(catalog: SiteCatalog, sites: list[str], name: str, df: DataFrame, key: str) -> int:
    """Publish a full copy of ``df`` on every site, all copies in one commit."""
    return catalog.publish({(site, name): (df, key) for site in sites})


def bag_difference(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, parts: int | None = None
) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on either side.

    One aggregation over both inputs (copies collapse before the shuffle) instead of two
    ``exceptAll`` in opposite directions. With ``parts``, rows are dealt over that many tasks first:
    each groups its share only, not what a split of the input or a shuffle partition holds.
    """
    tagged = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(*left.columns).withColumn("_n", F.lit(-1))
    )
    net = F.sum("_n")
    return (
        _dealt(tagged, left.columns, parts).groupBy(*left.columns)
        .agg(net.alias("_net"))
        .filter(F.col("_net") != 0)
        .withColumn(f"only_{left_name}", F.greatest(F.col("_net"), F.lit(0)))
        .withColumn(f"only_{right_name}", F.greatest(-F.col("_net"), F.lit(0)))
        .drop("_net")
    )


def _dealt(df: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    return df if parts is None else df.repartition(parts, *keys)


def _verdicts(counted: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per check out of a single row of counts."""
    found = F.array(
        *[F.struct(F.lit(c).alias("check"), n.cast("bigint").alias("violations")) for c, n in checks.items()]
    )
    return counted.select(F.explode(found).alias("v")).select(
        "v.check", "v.violations", (F.col("v.violations") == 0).alias("ok")
    )


def verify_fragmentation(
    df: DataFrame, fragments: dict[str, DataFrame], key: str, mode: str = "horizontal"
) -> DataFrame:
    """One row per property: complete, disjoint, rebuildable; with the number of violations.

    horizontal: no source row is missing, no key is in two fragments, the union has no row
    that the source lacks. vertical: every key is in every fragment, no non-key column is in
    two fragments, the join of the fragments has no row that the source lacks.

    Rows are grouped in as many tasks as the source's row count asks for (``TASK_ROWS``). A source that
    is costly to compute should be written first: it is read for the count and again by each fragment.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / TASK_ROWS))
    if mode == "horizontal":
        union = reduce(DataFrame.unionByName, [f.select(*df.columns) for f in fragments.values()])
        keyed = reduce(
            DataFrame.unionByName,
            [f.select(key, F.lit(k).alias("_f")) for k, f in enumerate(fragments.values())],
        )
        shared = (
            _dealt(keyed, [key], tasks).groupBy(key)
            .agg(F.min("_f").alias("lo"), F.max("_f").alias("hi"))
            .filter(F.col("lo") != F.col("hi"))
            .agg(F.count(F.lit(1)).alias("violations"))
        )
        rebuilt = union
    elif mode == "vertical":
        parts = list(fragments.values())
        keyed = reduce(DataFrame.unionByName, [p.select(key).distinct() for p in parts])
        incomplete = (
            df.select(key)
            .withColumn("_source", F.lit(1))
            .unionByName(keyed.withColumn("_source", F.lit(0)))
            .groupBy(key)
            .agg(F.max("_source").alias("s"), F.sum(1 - F.col("_source")).alias("n"))
            .filter((F.col("s") == 1) & (F.col("n") < len(parts)))
            .agg(F.count(F.lit(1)).alias("violations"))
        )
        columns = [c for p in parts for c in p.columns if c != key]
        doubled = len(columns) - len(set(columns))
        shared = df.sparkSession.range(1).select(F.lit(doubled).alias("violations"))
        rebuilt = reduce(lambda a, b: a.join(b, key), parts)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    surplus = bag_difference(df, rebuilt, "source", "rebuilt", tasks).agg(
        F.coalesce(F.sum("only_source"), F.lit(0)).alias("missing"),
        F.coalesce(F.sum("only_rebuilt"), F.lit(0)).alias("extra"),
    )
    disjoint = _verdicts(shared, {"disjoint": F.col("violations")})
    if mode == "horizontal":
        differing = _verdicts(surplus, {"complete": F.col("missing"), "rebuild": F.col("extra")})
        return differing.unionByName(disjoint)
    complete = _verdicts(incomplete, {"complete": F.col("violations")})
    rebuild = _verdicts(surplus, {"rebuild": F.col("missing") + F.col("extra")})
    return complete.unionByName(disjoint).unionByName(rebuild)
