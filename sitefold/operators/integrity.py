"""Integrity rules as data jobs: local, between sites, and over the global relations.

Every check returns the offending rows as ``(rule, name, key, detail)``; an empty result means
the rule holds. A loader may refuse the batch or set the rows aside.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType, TimestampType

from sitefold.functions import check_fails
from sitefold.session import materialize
from sitefold.sources.schema import RELATIONS, Relation
from sitefold.sources.sites import SiteCatalog, one_version

# Error numbers of the cross-site rules.
ERROR_UNKNOWN_USER = -20001
ERROR_UNKNOWN_PASSENGER = -20002
ERROR_SEAT_TAKEN = {"AM": -20003, "EU": -20004}


def _violation(df: DataFrame, rule: str, name: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(name).alias("name"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


# --- one table -------------------------------------------------------------------------


def check_rules(df: DataFrame, name: str, key: str, rules: dict[str, Callable[[], Column]]) -> DataFrame:
    """Rows that break row rules, one output row per broken rule; one pass over the table."""
    broken = F.array_compact(
        F.array(*[F.when(check_fails(p()), F.lit(rule)) for rule, p in rules.items()])
    )
    return (
        df.select(F.col(key), broken.alias("_broken"))
        .filter(F.size("_broken") > 0)
        .select(F.explode("_broken").alias("rule"), key)
        .select(
            "rule",
            F.lit(name).alias("name"),
            F.col(key).cast("string").alias("key"),
            F.lit("row rule").alias("detail"),
        )
    )


def check_not_null(df: DataFrame, name: str, key: str, columns: list[str]) -> DataFrame:
    """Rows with a NULL in a required column, one output row per column; one pass."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return (
        df.select(F.col(key), missing.alias("_missing"))
        .filter(F.size("_missing") > 0)
        .select(F.explode("_missing").alias("column"), key)
        .select(
            F.concat(F.lit("not_null_"), F.col("column")).alias("rule"),
            F.lit(name).alias("name"),
            F.col(key).cast("string").alias("key"),
            F.col("column").alias("detail"),
        )
    )


def _complete(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _any_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])


def key_text(keys: list[str]) -> Column:
    """Composite keys are shown as their parts joined by ``|``."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def check_unique(df: DataFrame, name: str, keys: list[str], rule: str | None = None) -> DataFrame:
    """Key values held by more than one row; rows whose key is all NULL do not count.

    Partial counts collapse before the shuffle, so a value held by many rows is harmless.
    """
    repeated = (
        df.filter(_any_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    return _violation(
        repeated, rule or f"unique_{'_'.join(keys)}", name, key_text(keys), F.col("_n")
    )


def check_fk(
    child: DataFrame, name: str, key: str, fk: str, parent: DataFrame, pk: str, rule: str | None = None
) -> DataFrame:
    """Child rows whose parent is missing; a NULL foreign key passes.

    The anti join keeps only keys of both sides. A hot foreign key is a skewed left side,
    which adaptive execution splits because each parent key occurs once.
    """
    parents = parent.select(F.col(pk).alias("_pk"))
    orphans = (
        child.select(F.col(key).alias("_key"), F.col(fk).alias("_fk"))
        .filter(F.col("_fk").isNotNull())
        .join(parents, F.col("_fk") == F.col("_pk"), "left_anti")
    )
    return _violation(orphans, rule or f"fk_{fk}", name, F.col("_key"), F.col("_fk"))


def check_fragment(df: DataFrame, name: str, key: str, predicate: Column, rule: str = "fragment") -> DataFrame:
    """Rows stored in a fragment whose predicate they do not satisfy."""
    return _violation(
        df.filter(check_fails(predicate)), rule, name, F.col(key), F.lit("not of this fragment")
    )


# --- between sites ---------------------------------------------------------------------


def check_fk_site(
    child: DataFrame, name: str, key: str, fk: str, catalog: SiteCatalog, site: str, parent: str,
    pk: str, rule: str | None = None,
) -> DataFrame:
    """Foreign key to a table of another site.

    Checked for the rows at hand: pass the inserted rows, or the rows whose foreign key was
    changed. Deleting a parent is not checked.
    """
    return check_fk(child, name, key, fk, catalog.table(site, parent), pk, rule or f"fk_{fk}_at_{site}")


def check_unique_sites(
    new: DataFrame, site: str, fragments: dict[str, DataFrame], name: str, key: str,
    keys: list[str], mode: str = "cross_site", rule: str | None = None,
) -> DataFrame:
    """Uniqueness of ``keys`` over the fragments of all sites.

    cross_site: rows of ``new`` (at ``site``) whose key exists in a fragment of another site.
    Repeats inside one site are not seen. global: key values held more than once anywhere,
    with ``new`` counted as part of its site.
    """
    rule = rule or f"unique_{'_'.join(keys)}_sites"
    if mode == "global":
        everything = reduce(
            DataFrame.unionByName, [f.select(*keys) for f in fragments.values()], new.select(*keys)
        )
        return check_unique(everything, name, keys, rule)
    if mode != "cross_site":
        raise ValueError(f"unknown mode {mode!r}")
    others = reduce(
        DataFrame.unionByName,
        [f.select(*keys).filter(_complete(keys)) for s, f in fragments.items() if s != site],
    )
    clash = new.join(others, keys, "left_semi")
    return _violation(clash, rule, name, F.col(key), key_text(keys))


# --- registry and report ---------------------------------------------------------------


@dataclass(frozen=True)
class Keys:
    """Key columns of a table. ``source`` names the table: equal names are one table and one scan."""

    source: str
    df: DataFrame = field(compare=False, repr=False)
    columns: tuple[str, ...]

    @property
    def place(self) -> tuple[str, tuple[str, ...]]:
        return self.source, self.columns


@dataclass(frozen=True)
class Rule:
    """A registered rule: a row rule with its predicate, or a key rule with the keys it compares.

    A key rule without ``other`` asks that values of ``own`` are unique. With ``other``, a row of ``own``
    breaks it when its value is missing there (``present`` false) or held there (``present`` true).
    """

    name: str
    table: str
    kind: str
    predicate: Callable[[], Column] | None = None
    own: Keys | None = None
    other: tuple[Keys, ...] = ()
    present: bool = False


def row_rules(relation: Relation, table: str, skip: tuple[str, ...] = ()) -> list[Rule]:
    """CHECK and NOT NULL rules of a relation as stored in ``table``."""
    checks = [
        Rule(rule, table, "check", predicate)
        for rule, predicate in relation.checks.items()
        if rule not in skip
    ]
    required = [
        Rule(f"not_null_{c}", table, "not_null", (lambda c=c: F.col(c).isNotNull()))
        for c in relation.required
    ]
    return checks + required


def _key_value(schema: StructType, columns: tuple[str, ...]) -> tuple[str, str]:
    """Key values of any table in one form, as SQL: a whole number, or text in which each part follows its
    length. Timestamps count their microseconds: as text two instants of a changed clock would look alike."""
    kinds = [schema[c].dataType for c in columns]
    if len(kinds) == 1 and isinstance(kinds[0], IntegralType):
        return f"CAST(`{columns[0]}` AS BIGINT)", "CAST(NULL AS STRING)"

    def part(c: str, kind) -> str:
        value = f"CAST(unix_micros(`{c}`) AS STRING)" if isinstance(kind, TimestampType) else f"CAST(`{c}` AS STRING)"
        return f"coalesce(concat(length({value}), ':', {value}), '-')"

    return "CAST(NULL AS BIGINT)", f"concat({', '.join(map(part, columns, kinds))})"


class SharedRules:
    """All rules of some tables, decided by one aggregation over one scan of each table.

    Key rules meet in *domains*: the values of a key where they are held, once for all rules about them
    (that they are unique, and each foreign key that points to them). A row gives one entry for each
    domain that it takes part in and one for each row rule that it breaks: (domain, key, role, count),
    role 0 where the value is held and a number of its own for each rule that asks for it. Entries are
    added up per key before and after the only shuffle, so a value that very many rows hold is one row
    of each task.
    """

    def __init__(self, tables: dict[str, DataFrame], rules: list[Rule]):
        self.rules = rules
        self._domains: dict[object, int] = {}
        self._asking: dict[int, int] = {}  # roles of a domain beside the holders
        self._measures: list[tuple[int, str]] = []  # of each rule: its domain and its measure there
        self._sources: dict[str, DataFrame] = {}
        self._schemas: dict[str, StructType] = {}
        self._entries: dict[str, list[tuple[int, int, Keys | None, Column]]] = {}
        for name, df in tables.items():
            self._source(self._source_of(name), df)
        for rule in rules:
            self._measures.append(self._row_rule(rule) if rule.own is None else self._key_rule(rule))
        self.roles = 1 + max(self._asking.values(), default=0)

    def _source_of(self, table: str) -> str:
        return next((r.own.source for r in self.rules if r.table == table and r.own), table)

    def _source(self, source: str, df: DataFrame) -> None:
        if source not in self._sources:
            self._sources[source], self._schemas[source] = df, df.schema

    def _entry(self, source: str, domain: int, role: int, keys: Keys | None, wanted: Column) -> None:
        self._entries.setdefault(source, []).append((domain, role, keys, wanted))

    def _row_rule(self, rule: Rule) -> tuple[int, str]:
        domain = self._domains.setdefault((rule.table, rule.name), len(self._domains))
        self._entry(self._source_of(rule.table), domain, 0, None, check_fails(rule.predicate()))
        return domain, "held"

    def _held(self, places: tuple[Keys, ...]) -> int:
        """The domain of values held at ``places``."""
        known = tuple(sorted(k.place for k in places))
        if known not in self._domains:
            self._domains[known] = len(self._domains)
            self._asking[self._domains[known]] = 0
            for keys in places:
                self._source(keys.source, keys.df)
                self._entry(keys.source, self._domains[known], 0, keys, _any_key(list(keys.columns)))
        return self._domains[known]

    def _key_rule(self, rule: Rule) -> tuple[int, str]:
        if not rule.other:
            return self._held((rule.own,)), "repeated"
        domain = self._held(rule.other)
        self._source(rule.own.source, rule.own.df)
        for keys in rule.other:
            self._comparable(rule.own, keys)
        self._asking[domain] = role = self._asking[domain] + 1
        self._entry(rule.own.source, domain, role, rule.own, _complete(list(rule.own.columns)))
        return domain, f"{'clash' if rule.present else 'orphan'}_{role}"

    def _comparable(self, a: Keys, b: Keys) -> None:
        for x, y in zip(a.columns, b.columns, strict=True):
            one, two = self._schemas[a.source][x].dataType, self._schemas[b.source][y].dataType
            if one != two and not (isinstance(one, IntegralType) and isinstance(two, IntegralType)):
                raise ValueError(f"{a.source}.{x} and {b.source}.{y} differ in type: {one} and {two}")

    def entries(self, source: str, df: DataFrame, sign: int = 1) -> DataFrame:
        """What rows of a table add to (``sign`` 1) or take from (-1) the counts, added up by task and key."""

        def entry(domain: int, role: int, keys: Keys | None, wanted: Column) -> Column:
            number, text = "CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)"
            if keys:
                number, text = _key_value(self._schemas[source], keys.columns)
            given = f"named_struct('domain', {domain}, 'role', {role}, 'number', {number}, 'text', {text})"
            return F.when(wanted, F.expr(given))

        rows = df.select(F.explode(F.array(*[entry(*e) for e in self._entries[source]])).alias("e"))
        return rows.where("e IS NOT NULL").selectExpr("e.*", f"CAST({sign} AS BIGINT) AS n")

    def add_up(self, entries: DataFrame) -> DataFrame:
        """(domain, number, text, n_0 …): rows of each role by key."""
        of_role = [f"sum(CASE WHEN role = {i} THEN n ELSE 0 END) AS n_{i}" for i in range(self.roles)]
        return entries.groupBy("domain", "number", "text").agg(*map(F.expr, of_role))

    def key_counts(self) -> DataFrame:
        """Counts of all tables; each is read once."""
        parts = [self.entries(s, df) for s, df in self._sources.items() if s in self._entries]
        return self.add_up(reduce(DataFrame.unionByName, parts))

    def measures(self, key_counts: DataFrame) -> DataFrame:
        """(domain, measure, violations) of counted keys."""
        found = {"held": "n_0", "repeated": "CAST(n_0 > 1 AS BIGINT)"}
        for i in range(1, self.roles):
            found[f"orphan_{i}"] = f"CASE WHEN n_0 = 0 THEN n_{i} ELSE 0 END"
            found[f"clash_{i}"] = f"CASE WHEN n_0 > 0 THEN n_{i} ELSE 0 END"
        sums = key_counts.groupBy("domain").agg(*[F.expr(f"sum({v}) AS {k}") for k, v in found.items()])
        return sums.unpivot("domain", list(found), "measure", "violations")

    def listing(self, measures: DataFrame) -> DataFrame:
        """(name, rule, kind, violations), a row for each rule, also where nothing was counted."""
        rows = [
            (r.table, r.name, r.kind, domain, measure)
            for r, (domain, measure) in zip(self.rules, self._measures, strict=True)
        ]
        schema = "name string, rule string, kind string, domain int, measure string"
        rules = measures.sparkSession.createDataFrame(rows, schema)
        # Both sides have a row or a few for each rule.
        return rules.join(F.broadcast(measures), ["domain", "measure"], "left").select(
            "name", "rule", "kind", F.coalesce("violations", F.lit(0).cast("long")).alias("violations")
        )


@dataclass(frozen=True)
class KeptCounts:
    """State of maintained rules: count rows in key ranges of a hash, and the totals of each measure."""

    rules: SharedRules
    counts: DataFrame  # domain, number, text, n_0 …, spread; several rows of a key add up
    totals: DataFrame  # domain, measure, violations; several rows of a measure add up
    folders: int

    def report(self) -> DataFrame:
        """(name, rule, kind, violations) from the totals alone; no table and no count is read."""
        summed = self.totals.groupBy("domain", "measure").agg(F.sum("violations").alias("violations"))
        return self.rules.listing(summed)


def _spread(counts: DataFrame, folders: int) -> DataFrame:
    return counts.withColumn("spread", F.pmod(F.xxhash64("domain", "number", "text"), F.lit(folders)).cast("int"))


def keep_counts(tables: dict[str, DataFrame], rules: list[Rule], folders: int = 64) -> KeptCounts:
    """Count all keys once and write them; from here on batches move the counts.

    Counts are spread over ``folders`` by a hash of their key: choose as many as give files of usual size.
    """
    shared = SharedRules(tables, rules)
    counts = materialize(_spread(shared.key_counts(), folders), "key_counts", partition_by="spread")
    return KeptCounts(shared, counts, materialize(shared.measures(counts), "totals"), folders)


def move_counts(kept: KeptCounts, source: str, before: DataFrame, after: DataFrame) -> KeptCounts:
    """The state after rows ``before`` of table ``source`` have become rows ``after``.

    Pass the rows that a batch touches, as they were and as they are: an inserted row is only in
    ``after``, a deleted one only in ``before``. What a batch changes is counted like a table, taken from
    and added to the counts of its keys; the violations of just these keys are measured before and
    after. The counts are joined on their folder too, so Spark reads only folders that the batch hits.
    """
    shared = kept.rules
    moved = shared.entries(source, before, -1).unionByName(shared.entries(source, after))
    sums = [f"n_{i}" for i in range(shared.roles)]
    some = " OR ".join(f"{n} <> 0" for n in sums)
    delta = materialize(_spread(shared.add_up(moved).where(some), kept.folders), "moved", partition_by="spread")
    key = ["spread", "domain", "number", "text"]
    meets = [kept.counts[c].eqNullSafe(delta[c]) if c in ("number", "text") else kept.counts[c] == delta[c] for c in key]
    old = kept.counts.join(delta, reduce(lambda a, b: a & b, meets), "left_semi")
    added = lambda *parts: reduce(DataFrame.unionByName, parts).groupBy(*key).agg(
        *[F.sum(n).alias(n) for n in sums]
    )
    gone = shared.measures(added(old)).withColumn("violations", -F.col("violations"))
    came = shared.measures(added(old, delta))
    shift = materialize(gone.unionByName(came), "shift")
    return KeptCounts(shared, kept.counts.unionByName(delta), kept.totals.unionByName(shift), kept.folders)


def rule_report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All rules with the number of rows (or key values) that break them, and their status."""
    shared = SharedRules(tables, rules)
    status = F.when(F.col("violations") == 0, "OK").otherwise("VIOLATED")
    return (
        shared.listing(shared.measures(shared.key_counts()))
        .withColumn("status", status)
        .orderBy("name", "kind", "rule")
    )


@one_version
def site_rules(catalog: SiteCatalog, site: str) -> tuple[dict[str, DataFrame], list[Rule]]:
    """Tables of a site and every rule that applies to them, local and cross-site."""
    tables: dict[str, DataFrame] = {}
    rules: list[Rule] = []
    suffix = f"_{site.lower()}"

    def add(table: str, relation: Relation, skip: tuple[str, ...] = ()) -> DataFrame | None:
        if not catalog.has(site, table):
            return None
        df = tables[table] = catalog.table(site, table)
        rules.extend(
            r for r in row_rules(relation, table, skip)
            if r.kind == "check" or r.name.removeprefix("not_null_") in df.columns
        )
        return df

    def at(place: str, table: str, keys: tuple[str, ...]) -> Keys:
        return Keys(f"{place}.{table}", catalog.table(place, table), keys)

    def unique(table: str, keys: tuple[str, ...]) -> None:
        rules.append(Rule(f"unique_{'_'.join(keys)}", table, "unique", own=at(site, table, keys)))

    def foreign(table: str, fk: str, parent_site: str, parent: str, pk: str) -> None:
        if not catalog.has(parent_site, parent):
            return
        kind = "fk" if parent_site == site else "fk_site"
        rules.append(
            Rule(f"{kind}_{fk}", table, kind, own=at(site, table, (fk,)), other=(at(parent_site, parent, (pk,)),))
        )

    for name in ("tara", "oras", "aeroport", "avion", "zbor", "pasager"):
        relation = RELATIONS[name]
        if add(name, relation) is not None:
            for keys in relation.unique:
                unique(name, keys)
            for fk, parent, pk in relation.foreign:
                foreign(name, fk, site, parent, pk)
    users = RELATIONS["utilizator"]
    if add("utilizator_sec", users) is not None:
        unique("utilizator_sec", ("id_user",))
        unique("utilizator_sec", ("email",))
    if catalog.has(site, "utilizator_data"):
        add("utilizator_data", users, skip=("user_email", "user_role"))
        unique("utilizator_data", ("id_user",))
        if site == catalog.master:
            foreign("utilizator_data", "id_user", site, "utilizator_sec", "id_user")
    for name in ("rezervare", "plata", "bilet"):
        relation, table = RELATIONS[name], f"{name}{suffix}"
        if add(table, relation, skip=("booking_region",)) is None:
            continue
        unique(table, (relation.key,))
        for fk, parent, pk in relation.foreign:
            split = parent in ("rezervare", "plata", "bilet")
            home = site if split or catalog.has(site, parent) else catalog.master
            foreign(table, fk, home, f"{parent}{suffix}" if split else parent, pk)
        if name == "rezervare":
            rules.append(
                Rule("fragment_region", table, "fragment",
                     lambda: F.col("regiune_vanzare") == site)
            )
        if name == "bilet":
            seat = ("id_zbor", "numar_rand", "litera_scaun")
            others = tuple(
                at(s, f"bilet_{s.lower()}", seat)
                for s in ("AM", "EU")
                if s != site and catalog.has(s, f"bilet_{s.lower()}")
            )
            if others:
                rules.append(
                    Rule("unique_seat_sites", table, "unique_site", own=at(site, table, seat), other=others,
                         present=True)
                )
    return tables, rules
