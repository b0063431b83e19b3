"""Sites, their tables, and all-or-nothing publishing of several tables.

A site is a name. Its tables are either registered DataFrames (a view over existing files)
or tables published below the catalog's root. A published table is a set of Parquet folders
for the hash buckets of its key; a commit log of small JSON files says which folders are
current. A bucket may have several folders: one that was written whole, and what was appended
to it since. One publish writes its data first and then adds ONE log file, so readers see all
of its tables or none. Published folders are never changed, so a reader keeps what it resolved.

A snapshot resolves all tables by one look at the log; what reads several tables takes one. A
publish may name the version it was made from; it fails when a table that it writes or relied
on has moved since. There is one writing driver at a time per root.
"""

from __future__ import annotations

import functools
import json
import math
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG_SCHEMA = (
    "version bigint, site string, name string, buckets int, bucket int, path string, added boolean, "
    "columns string, key string, tag string"
)

#: Rows a bucket is meant to hold; how many buckets a whole table gets follows from its rows.
BUCKET_ROWS = 2_000_000

Place = tuple[str, str]


class StaleBase(RuntimeError):
    """A table that a publish writes or relied on has moved since it was read."""


class _Table(NamedTuple):
    """A published table: when it last moved, its layout, and the folders of each bucket."""

    version: int
    buckets: int
    columns: str
    key: str
    paths: dict[int, list[str]]


class _Head(NamedTuple):
    version: int
    tables: dict[Place, _Table]
    tagged: bool


class Snapshot:
    """All tables of a catalog at one version; reads like the catalog and never moves."""

    def __init__(self, catalog: SiteCatalog, head: _Head):
        self.catalog, self.spark, self.master = catalog, catalog.spark, catalog.master
        self.version = head.version
        self._tables = head.tables
        self._frames: dict[Place, DataFrame] = {}

    def snapshot(self) -> Snapshot:
        return self

    def has(self, site: str, name: str) -> bool:
        return (site, name) in self.catalog._registered or (site, name) in self._tables

    def table(self, site: str, name: str) -> DataFrame:
        known = self.catalog._known(site, name)
        if known is not None:
            return known
        if (site, name) not in self._tables:
            raise KeyError(f"no table {name!r} at site {site!r}")
        if (site, name) not in self._frames:
            self._frames[site, name] = self.catalog._read(self._tables[site, name])
        return self._frames[site, name]

    def synonym(self, name: str, view: str | None = None) -> DataFrame:
        df = self.table(self.master, name)
        df.createOrReplaceTempView(view or name)
        return df


def one_version(job: Callable) -> Callable:
    """A job whose first argument is a catalog, run on a snapshot: all its tables are of one version,
    found by one look at the log."""

    @functools.wraps(job)
    def run(catalog: SiteCatalog | Snapshot, *args, **options):
        return job(catalog.snapshot(), *args, **options)

    return run


class SiteCatalog:
    """Tables of named sites. ``master`` is the site whose copy synonyms point at."""

    def __init__(self, spark: SparkSession, root: str | None = None, master: str = "AM"):
        self.spark = spark
        self.root = root
        self.master = master
        self._registered: dict[tuple[str, str], DataFrame | Callable[[], DataFrame]] = {}
        # Streams of one driver publish through the same catalog, one after the other.
        self._writing = threading.RLock()

    # --- reading -----------------------------------------------------------------------

    def register(self, site: str, name: str, df: DataFrame | Callable[[], DataFrame]) -> None:
        """Make ``df`` the table ``name`` of ``site``; a function is called on first use."""
        self._registered[site, name] = df

    def unregister(self, site: str, name: str) -> None:
        """Forget a registered table; a published one of that name is read from then on."""
        self._registered.pop((site, name), None)

    def _known(self, site: str, name: str) -> DataFrame | None:
        known = self._registered.get((site, name))
        if known is not None and not isinstance(known, DataFrame):
            known = self._registered[site, name] = known()
        return known

    def snapshot(self) -> Snapshot:
        """All tables as they are now, by one look at the log."""
        return Snapshot(self, self._head())

    def table(self, site: str, name: str) -> DataFrame:
        """The table ``name`` of ``site``; the same call for local and remote sites."""
        known = self._known(site, name)
        return known if known is not None else Snapshot(self, self._head([(site, name)])).table(site, name)

    def has(self, site: str, name: str) -> bool:
        return (site, name) in self._registered or (site, name) in self._head([(site, name)]).tables

    def synonym(self, name: str, view: str | None = None) -> DataFrame:
        """The master site's copy, also registered as a temporary view."""
        df = self.table(self.master, name)
        df.createOrReplaceTempView(view or name)
        return df

    # --- publishing --------------------------------------------------------------------

    def publish(
        self, tables: dict[Place, tuple[DataFrame, str]], buckets: int | None = None, tag: str | None = None,
        base: int | None = None,
    ) -> int:
        """Publish whole tables together: ``{(site, name): (df, key)}``. Returns the version.

        Without ``buckets`` their number follows from the rows of each table (``BUCKET_ROWS``), so it
        grows with the data; that costs a count. ``base``: see :meth:`publish_changes`.
        """
        if self.root is None:
            raise ValueError("a catalog without a root cannot publish")
        with self._writing:
            head = self._head(list(tables))
            self._check_base(head, tables, base)
            version = head.version + 1

            def write(entry) -> list[tuple]:
                (site, name), (df, key) = entry
                n = buckets or max(1, math.ceil(df.count() / BUCKET_ROWS))
                written = self._write(site, name, df, key, n, version)
                columns = df.schema.json()
                return [
                    (version, site, name, n, b, written.get(b), False, columns, key, tag) for b in range(n)
                ]

            self._commit(self._side_by_side(write, tables.items()))
        return version

    def publish_changes(
        self,
        tables: dict[Place, tuple[DataFrame, Callable[[DataFrame, DataFrame], DataFrame]]] | None = None,
        appends: dict[Place, DataFrame] | None = None,
        tag: str | None = None,
        base: int | None = None,
        relied_on: Iterable[Place] = (),
    ) -> int:
        """Rewrite only the buckets that changes touch, and append rows, for several tables together.

        ``tables``: ``{(site, name): (changes, apply)}``, where ``apply(current, changes)`` gets the rows
        of the touched buckets and ``changes`` carries the key column. ``appends``: new rows, which add
        folders and rewrite nothing. Nothing happens when the log has a commit with this ``tag`` already,
        so a batch can be retried. ``base`` is the version all this was made from: when a table it
        writes, or one in ``relied_on``, has moved since, :class:`StaleBase` is raised and nothing written.
        """
        tables, appends, relied_on = tables or {}, appends or {}, list(relied_on)
        with self._writing:
            head = self._head([*tables, *appends, *relied_on], tag)
            if head.tagged:
                return head.version
            self._check_base(head, [*tables, *appends, *relied_on], base)
            for place in (*tables, *appends):
                if place not in head.tables:
                    raise KeyError(f"no published table {place}")
            version = head.version + 1

            def put(entry) -> list[tuple]:
                place, change = entry
                table = head.tables[place]
                if isinstance(change, DataFrame):
                    written = self._write(*place, change.select(*_names(table)), table.key, table.buckets, version)
                    return [
                        (version, *place, table.buckets, b, path, True, table.columns, table.key, tag)
                        for b, path in written.items()
                    ]
                return self._rewrite(place, table, *change, version, tag)

            rows = self._side_by_side(put, [*tables.items(), *appends.items()])
            if rows or tag:
                self._commit(rows or [(version, *[None] * 8, tag)])
        return version

    @staticmethod
    def _check_base(head: _Head, places: Iterable[Place], base: int | None) -> None:
        moved = [p for p in places if base is not None and p in head.tables and head.tables[p].version > base]
        if moved:
            raise StaleBase(f"{sorted(set(moved))} moved after version {base}")

    @staticmethod
    def _side_by_side(write: Callable[[tuple], list[tuple]], tables) -> list[tuple]:
        """Write several tables at the same time, so small ones do not wait for large ones."""
        with ThreadPoolExecutor(max_workers=8) as pool:
            return [row for rows in pool.map(write, list(tables)) for row in rows]

    def _rewrite(self, place: Place, table: _Table, changes, apply, version, tag) -> list[tuple]:
        """New folders for the buckets that ``changes`` touches, as log rows."""
        n, key = table.buckets, table.key
        # At most one row per bucket reaches the driver.
        hit = [r.b for r in changes.select(bucket_of(key, n).alias("b")).distinct().collect()]
        if not hit:
            return []
        current = self._read(table._replace(paths={b: table.paths.get(b, []) for b in hit}))
        written = self._write(*place, apply(current, changes), key, n, version)
        return [(version, *place, n, b, written.get(b), False, table.columns, key, tag) for b in hit]

    def committed(self, tag: str) -> bool:
        """True when a publish with this tag is in the log."""
        return self._head(tag=tag).tagged

    # --- the commit log ----------------------------------------------------------------

    def _log(self) -> DataFrame:
        if self.root is None:
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        try:
            return self.spark.read.schema(_LOG_SCHEMA).json(f"{self.root}/_log")
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], _LOG_SCHEMA)
            raise

    def _head(self, places: list[Place] | None = None, tag: str | None = None) -> _Head:
        """What the log says, in one job: newest version, folders of ``places`` (or all), tag known.

        Of every bucket the newest whole folder counts, and what was added since; a publish of the
        whole table renews all of its buckets.
        """
        if self.root is None:
            return _Head(0, {}, False)
        log = self._log()
        wanted = F.col("name").isNotNull() if places is None else F.lit(False)
        for site, name in places or ():
            wanted = wanted | ((F.col("site") == site) & (F.col("name") == name))
        whole = F.when(~F.col("added"), F.col("version"))
        newest = (
            log.filter(wanted)
            .groupBy("site", "name", "bucket")
            .agg(
                F.max_by(F.struct("version", "buckets", "path", "columns", "key"), whole).alias("e"),
                F.collect_list(F.when(F.col("added"), F.struct("version", "path"))).alias("added"),
            )
            .select("site", "name", "bucket", "e.*", "added", F.lit(False).alias("tagged"))
        )
        top = log.agg(
            F.coalesce(F.max("version"), F.lit(0)).alias("version"),
            F.coalesce(F.max(F.col("tag") == F.lit(tag)), F.lit(False)).alias("tagged"),
        )
        found: dict[Place, list[T.Row]] = {}
        for row in newest.unionByName(top, allowMissingColumns=True).collect():
            if row.name is None:
                last = row
            else:
                found.setdefault((row.site, row.name), []).append(row)
        tables = {}
        for place, rows in found.items():
            # The bucket count may have changed with a later publish; older rows are stale then.
            latest = max(rows, key=lambda r: r.version)
            paths, moved = {}, latest.version
            for row in rows:
                if row.buckets != latest.buckets:
                    continue
                since = [a for a in row.added if a.version > row.version]
                moved = max([moved, *(a.version for a in since)])
                paths[row.bucket] = [p for p in (row.path, *(a.path for a in since)) if p]
            tables[place] = _Table(moved, latest.buckets, latest.columns, latest.key, paths)
        return _Head(last.version, tables, last.tagged)

    def _read(self, table: _Table) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.columns))
        paths = [p for folders in table.paths.values() for p in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(
        self, site: str, name: str, df: DataFrame, key: str, buckets: int, version: int
    ) -> dict[int, str]:
        """Write ``df`` split by key bucket; returns the folders of the buckets with rows."""
        path = f"{self.root}/{site}/{name}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        # Rebalancing gives few files per bucket and still splits a bucket that is large.
        (
            df.withColumn("_bucket", bucket_of(key, buckets))
            .hint("rebalance", "_bucket")
            .write.partitionBy("_bucket")
            .parquet(path)
        )
        # One row per bucket that has rows; only the folders' names and the files' footers are read.
        found = self.spark.read.parquet(path).select("_bucket").distinct().collect() if self._has_rows(path) else []
        return {r._bucket: f"{path}/_bucket={r._bucket}" for r in found}

    def _has_rows(self, path: str) -> bool:
        """Whether a partitioned write made any partition: without one there is nothing to infer from."""
        try:
            return "_bucket" in self.spark.read.parquet(path).columns
        except AnalysisException as problem:
            if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return False
            raise

    def _commit(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, _LOG_SCHEMA).coalesce(1).write.mode("append").json(
            f"{self.root}/_log"
        )


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _names(table: _Table) -> list[str]:
    return [f["name"] for f in json.loads(table.columns)["fields"]]
