"""Keeping copies equal: change streams, refresh on demand, chained propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sitefold.operators.changes import apply_changes, capture_changes, collapse, route_update_vertical
from sitefold.operators.integrity import check_fk
from sitefold.sources.schema import EAGER_REPLICAS, table_schema
from sitefold.sources.sites import SiteCatalog

#: Bookkeeping columns of a streamed replica: the newest sequence seen, those of the last write,
#: insert and delete, and whether the row is absent. Rows that a replica starts with count as
#: inserted before everything.
_SEQ, _WRITTEN, _INSERTED, _REMOVED, _DEAD = "_seq", "_written", "_inserted", "_removed", "_deleted"
_BOOKS = (_SEQ, _WRITTEN, _INSERTED, _REMOVED, _DEAD)
_BEFORE_ALL = -(1 << 63)


# --- continuous replication ------------------------------------------------------------


def initial_state(rows: DataFrame) -> DataFrame:
    """The state of a replica that holds ``rows`` and has seen no change."""
    none, first = F.lit(None).cast("bigint"), F.lit(_BEFORE_ALL).cast("bigint")
    return rows.withColumns({_SEQ: none, _WRITTEN: first, _INSERTED: first, _REMOVED: none, _DEAD: F.lit(False)})


def start_replica(
    catalog: SiteCatalog, site: str, name: str, initial: DataFrame, key: str, buckets: int | None = None
) -> None:
    """Publish the first state of a replica that a stream will keep up to date."""
    catalog.publish({(site, f"{name}__state"): (initial_state(initial), key)}, buckets=buckets)


def read_replica(catalog: SiteCatalog, site: str, name: str) -> DataFrame:
    """The rows of a streamed replica."""
    return catalog.table(site, f"{name}__state").filter(~F.col(_DEAD)).drop(*_BOOKS)


def merge_late(state: DataFrame, changes: DataFrame, key: str, forget_before: int | None = None) -> DataFrame:
    """Replica state after a micro-batch, the same however the changes were cut into batches.

    The batch is collapsed per key before it meets the state, so a hot key is reduced before the
    shuffle. Of batch and state the newest write, insert and delete count: a row is there when its
    last insert is newer than its last delete, and holds the values of the last write. So an insert
    that comes after a newer update of its key is born with the update's values.

    Absent keys keep a mark for what may still come; marks whose newest change is older than
    ``forget_before`` are dropped.
    """
    columns = [c for c in state.columns if c not in (key, *_BOOKS)]
    collapsed = collapse(changes, key, columns)
    batch = collapsed.select(
        "_key", "_row", *[F.col(c).alias(f"_new{c}") for c in (_SEQ, _WRITTEN, _INSERTED, _REMOVED)]
    )
    newest = {c: F.greatest(F.col(c), F.col(f"_new{c}")) for c in (_SEQ, _WRITTEN, _INSERTED, _REMOVED)}
    inserted, removed = newest[_INSERTED], newest[_REMOVED]
    alive = F.coalesce(inserted.isNotNull() & (removed.isNull() | (inserted > removed)), F.lit(False))
    ours = F.col(f"_new{_WRITTEN}").isNotNull() & (
        F.col(_WRITTEN).isNull() | (F.col(f"_new{_WRITTEN}") > F.col(_WRITTEN))
    )
    merged = state.join(batch, F.col(key) == F.col("_key"), "full").select(
        F.coalesce(key, "_key").alias(key),
        *[F.when(ours, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        *[newest[c].alias(c) for c in (_SEQ, _WRITTEN, _INSERTED, _REMOVED)],
        (~alive).alias(_DEAD),
    )
    if forget_before is None:
        return merged
    return merged.filter(~F.col(_DEAD) | (F.col(_SEQ) >= forget_before))


def replicate_stream(
    changes: DataFrame, catalog: SiteCatalog, site: str, name: str, key: str, checkpoint: str,
    once: bool = True, retain: int | None = None,
) -> StreamingQuery:
    """Keep the replica ``name`` at ``site`` equal to its source by a stream of changes.

    One way only: nothing flows back. Each micro-batch rewrites the buckets it touches and
    is committed under the batch's id, so a batch that is retried after a failure is applied
    once. With ``once`` the stream stops when it has read what is there. Marks of absent keys are
    kept, or for ``retain`` sequence numbers behind the newest of a batch that touches their bucket.
    """
    label = f"{site}/{name}@{checkpoint}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        tag = f"{label}#{batch_id}"
        batch.persist()  # read twice or more: for the touched buckets and for the merge
        try:
            newest = batch.agg(F.max("seq")).first()[0] if retain is not None else None
            forget = None if newest is None else newest - retain

            def apply(current: DataFrame, part: DataFrame) -> DataFrame:
                return merge_late(current, part, key, forget)

            catalog.publish_changes({(site, f"{name}__state"): (batch, apply)}, tag=tag)
        finally:
            batch.unpersist()

    writer = changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_changes(
    spark: SparkSession, folder: str, schema: T.StructType | str, **options
) -> DataFrame:
    """A folder of Parquet change files as a stream."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def start_sync(
    catalog: SiteCatalog, site: str, folder: str, checkpoints: str, once: bool = True, **options
) -> dict[str, StreamingQuery]:
    """Start a stream for every relation that is pushed to its copy as it changes.

    Changes of a relation are read from ``folder/<name>``. Airports are copied but never
    pushed, and flights wait for a refresh, so neither has a stream. ``options`` go to the source,
    such as maxFilesPerTrigger, which bounds a batch.
    """
    queries = {}
    for name in EAGER_REPLICAS:
        schema, key = table_schema(name)
        # A delete carries its key only, so no column of a change is required.
        optional = [T.StructField(f.name, f.dataType) for f in schema.fields]
        layout = T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()), *optional])
        changes = read_changes(catalog.spark, f"{folder}/{name}", layout, **options)
        queries[name] = replicate_stream(changes, catalog, site, name, key, f"{checkpoints}/{name}", once)
    return queries


# --- refresh on demand -----------------------------------------------------------------


def refresh_incremental(
    replica: DataFrame, log: DataFrame, since: int, key: str
) -> tuple[DataFrame, int]:
    """A copy brought up to date from the log rows after ``since``; also the new position.

    The log's sequence filter reaches the scan, so only the new part of the log is read.
    """
    last = log.filter(F.col("seq") > since).agg(F.max("seq")).first()[0]
    if last is None:
        return replica, since
    # Up to the position that is returned: rows that are logged meanwhile wait for the next refresh.
    pending = log.filter((F.col("seq") > since) & (F.col("seq") <= last))
    return apply_changes(replica, pending, key), last


def stale_keys(master: DataFrame, replica: DataFrame, key: str) -> DataFrame:
    """What a refresh would have to change in the copy, as change rows."""
    return capture_changes(replica, master, key)


class RefreshRefused(ValueError):
    """A refreshed copy would leave child rows without a parent."""


def refresh_validated(
    replica: DataFrame, log: DataFrame, since: int, key: str,
    children: list[tuple[str, DataFrame, str, str]],
) -> tuple[DataFrame, int, DataFrame]:
    """Refresh first, check foreign keys afterwards.

    ``children``: (name, rows, key, foreign key). Returns the refreshed copy, the new
    position, and the child rows it would orphan; publish only when there are none.
    """
    refreshed, position = refresh_incremental(replica, log, since, key)
    orphans = None
    for name, rows, child_key, fk in children:
        found = check_fk(rows, name, child_key, fk, refreshed, key)
        orphans = found if orphans is None else orphans.unionByName(found)
    if orphans is None:
        orphans = replica.sparkSession.createDataFrame([], "rule string, name string, key string, detail string")
    return refreshed, position, orphans


def publish_refresh(
    catalog: SiteCatalog, site: str, name: str, log: DataFrame, since: int, key: str,
    children: list[tuple[str, DataFrame, str, str]] = (),
) -> int:
    """Refresh a published copy in place: only touched buckets are rewritten, after the check."""
    last = log.filter(F.col("seq") > since).agg(F.max("seq")).first()[0]
    if last is None:
        return since
    pending = log.filter((F.col("seq") > since) & (F.col("seq") <= last))
    if children:
        _, _, orphans = refresh_validated(catalog.table(site, name), pending, since, key, list(children))
        if bad := orphans.take(5):
            raise RefreshRefused(f"rows without a parent after refresh: {[tuple(r) for r in bad]}")
    catalog.publish_changes(
        {(site, name): (pending, lambda current, batch: apply_changes(current, batch, key))},
        tag=f"refresh {site}/{name}@{last}",
    )
    return last


# --- chained propagation ---------------------------------------------------------------


def propagate_vertical(
    changes: DataFrame, data: DataFrame, replica: DataFrame, key: str = "id_user"
) -> tuple[DataFrame, DataFrame]:
    """An update of the global user view: into the master's profile fragment, then its copy.

    The copy receives what actually changed at the master, as full-row updates.
    """
    updated = route_update_vertical("v_utilizator", changes, data, key)
    # Only rows that the batch names can have changed.
    named = data.join(changes.select(key).distinct(), key, "left_semi")
    renamed = route_update_vertical("v_utilizator", changes, named, key)
    forwarded = capture_changes(named, renamed, key).withColumn("seq", F.lit(1).cast("bigint"))
    return updated, apply_changes(replica, forwarded, key)
