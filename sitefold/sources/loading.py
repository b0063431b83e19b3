"""Loading and appending: typed reads, copies, keyed inserts, key look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitefold.operators.keys import dense_row_number
from sitefold.sources.schema import Relation, conform


def load_table(
    spark: SparkSession, path: str, relation: Relation | T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read a relation with its declared schema.

    Parquet columns are cast from whatever type the file has, so only the declared columns
    are scanned. CSV is read as text first and then cast by the same rules.
    """
    schema = relation.schema if isinstance(relation, Relation) else relation
    dates = relation.dates if isinstance(relation, Relation) else ()
    if fmt == "csv":
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        raw = spark.read.schema(text).option("header", True).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return conform(raw, schema, dates)


def copy_table(source: DataFrame, path: str) -> None:
    """Append a whole relation to the table at ``path``."""
    source.write.mode("append").parquet(path)


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` plus ``rows``, matched by column name; missing nullable columns are NULL."""
    typed = rows.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
            if f.name in rows.columns
        ]
    )
    return table.unionByName(typed, allowMissingColumns=True)


def absent_rows(target: DataFrame, rows: DataFrame, keys: list[str], first_by: str) -> DataFrame:
    """Rows whose natural key is not in ``target``; of equal keys the first one is kept.

    A key with a NULL part never equals another key, so those rows are all kept. Copies of a
    key are collapsed before the shuffle (partial aggregation), however many there are.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    first = (
        rows.filter(complete)
        .groupBy(*keys)
        # A NULL order value comes last, but still makes a row.
        .agg(F.min_by(F.struct(*rows.columns), F.struct(F.col(first_by).isNull(), F.col(first_by))).alias("_row"))
        .select("_row.*")
    )
    return first.join(target.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(
        rows.filter(~complete)
    )


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: list[str], first_by: str
) -> DataFrame:
    """``target`` plus the rows whose natural key it does not hold yet."""
    new = absent_rows(target, rows, keys, first_by)
    return append_rows(target, new.select(*[c for c in new.columns if c in target.columns]))


def resolve_fk(
    rows: DataFrame, dim: DataFrame, on: dict[str, str], key: str, out: str
) -> DataFrame:
    """Look up ``dim[key]`` by natural key and add it as ``out``; NULL when there is none.

    ``on`` maps row columns to dimension columns. A natural key that names two dimension
    rows fails the job, as a scalar sub-query would.
    """
    look = dim.groupBy(*[F.col(d).alias(f"_on_{r}") for r, d in on.items()]).agg(
        F.min(key).alias("_key"), F.count(F.lit(1)).alias("_hits")
    )
    match = F.lit(True)
    for r in on:
        match = match & (F.col(r) == F.col(f"_on_{r}"))
    found = F.when(
        F.col("_hits") > 1, F.raise_error(F.lit(f"more than one {key} for a natural key"))
    ).otherwise(F.col("_key"))
    return rows.join(look, match, "left").select(*rows.columns, found.alias(out))


def at_position(dim: DataFrame, key: str, out: str = "rn") -> DataFrame:
    """Positions 1..n of ``dim`` in key order, as ``(rn, key)``."""
    return dense_row_number(dim.select(key), [key], out=out)


def resolve_position(rows: DataFrame, dim: DataFrame, position: str, key: str, out: str) -> DataFrame:
    """Look up the key of the row at a given position of ``dim``; NULL past the end."""
    places = at_position(dim, key, out="_rn").select("_rn", F.col(key).alias(out))
    return rows.join(places, F.col(position) == F.col("_rn"), "left").drop("_rn")
