"""Guarded writes: which rows of a batch a table of a site may take, and which rule refuses the others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.functions import check_fails
from sitefold.operators.integrity import ERROR_SEAT_TAKEN, ERROR_UNKNOWN_PASSENGER, ERROR_UNKNOWN_USER
from sitefold.session import materialize
from sitefold.sources.schema import RELATIONS
from sitefold.sources.sites import SiteCatalog, Snapshot

#: Relations that are split by site; the others are copies.
SPLIT = ("rezervare", "plata", "bilet")
SEAT = ("id_zbor", "numar_rand", "litera_scaun")
#: Error numbers of foreign keys that lead to the central site.
_CENTRAL_ERRORS = {"id_user": ERROR_UNKNOWN_USER, "id_pasager": ERROR_UNKNOWN_PASSENGER}


class Refused(ValueError):
    """Rows that break a rule of the table they were meant for."""


@dataclass(frozen=True)
class Admitted:
    """Rows that may be written, and (seq, key, rule, error) for each rule that refuses a row.

    ``base`` is the version of the catalog they were checked against.
    """

    accepted: DataFrame
    refused: DataFrame
    base: int


def _place(name: str, site: str) -> str:
    return f"{name}_{site.lower()}" if name in SPLIT else name


def _same(columns: tuple[str, ...], suffix: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (F.col(c) == F.col(f"{c}{suffix}"))
    return out


def _broken(rule: str, when: Column, error: int | None = None) -> Column:
    return F.when(when, F.struct(F.lit(rule).alias("rule"), F.lit(error).cast("int").alias("error")))


def admit(
    catalog: SiteCatalog | Snapshot, site: str, name: str, rows: DataFrame, changed: list[str] | None = None
) -> Admitted:
    """Check ``rows`` (the relation's columns and ``seq``) before they enter relation ``name`` at ``site``.

    Without ``changed`` the rows are inserts and all rules apply. With it they are the new values of
    existing rows, and only row rules, and the keys and foreign keys among the changed columns, are
    checked. Of rows of the batch that want one unique key, the one with the lowest ``seq`` that
    breaks no other rule gets it. Seats are checked against the tickets of all sites.
    """
    catalog = catalog.snapshot()
    relation, table = RELATIONS[name], catalog.table(site, _place(name, site))
    touched = set(rows.columns if changed is None else changed)
    own = relation.key
    found: list[Column] = [
        _broken(rule, check_fails(predicate())) for rule, predicate in relation.checks.items()
    ]
    found += [_broken(f"not_null_{c}", F.col(c).isNull()) for c in relation.required]
    if name == "rezervare":
        found.append(_broken("fragment_region", F.col("regiune_vanzare") != site))
    judged = rows
    for k, (fk, parent, pk) in enumerate(relation.foreign):
        if fk not in touched:
            continue
        home = site if parent in SPLIT or catalog.has(site, parent) else catalog.master
        parents = catalog.table(home, _place(parent, home)).select(F.col(pk).alias(f"_p{k}"))
        judged = judged.join(parents, F.col(fk) == F.col(f"_p{k}"), "left")
        error = _CENTRAL_ERRORS.get(fk) if home == catalog.master else None
        found.append(_broken(f"fk_{fk}", F.col(fk).isNotNull() & F.col(f"_p{k}").isNull(), error))
    contests = [keys for keys in relation.unique if touched & set(keys)]
    for k, keys in enumerate(contests):
        wanted = rows.select(*keys).distinct()
        holders = (
            table.join(wanted, list(keys), "left_semi")
            .groupBy(*[F.col(c).alias(f"{c}_u{k}") for c in keys])
            .agg(F.min(own).alias(f"_least{k}"), F.max(own).alias(f"_most{k}"))
        )
        judged = judged.join(holders, _same(keys, f"_u{k}"), "left")
        held = F.col(f"_least{k}").isNotNull()
        if changed is not None:  # a row may keep its own key
            held = held & ((F.col(f"_least{k}") != F.col(own)) | (F.col(f"_most{k}") != F.col(own)))
        found.append(_broken(f"unique_{'_'.join(keys)}", held))
    if name == "bilet" and touched & set(SEAT):
        for other in (s for s in ("AM", "EU") if s != site and catalog.has(s, f"bilet_{s.lower()}")):
            seats = (
                catalog.table(other, f"bilet_{other.lower()}")
                .join(rows.select(*SEAT).distinct(), list(SEAT), "left_semi")
                .select(*[F.col(c).alias(f"{c}_{other}") for c in SEAT])
                .distinct()
            )
            judged = judged.join(seats, _same(SEAT, f"_{other}"), "left")
            found.append(_broken("unique_seat_sites", F.col(f"{SEAT[0]}_{other}").isNotNull(), ERROR_SEAT_TAKEN[site]))
    # Used several times below; written once, so the joins above run once.
    judged = materialize(judged.select(*rows.columns, F.array_compact(F.array(*found)).alias("_broken")), "admitted")
    lost = []
    for k, keys in enumerate(contests):
        winners = (
            judged.filter((F.size("_broken") == 0) & F.coalesce(*[F.col(c).cast("string") for c in keys]).isNotNull())
            .groupBy(*[F.col(c).alias(f"{c}_w{k}") for c in keys])
            .agg(F.min("seq").alias(f"_first{k}"))
        )
        judged = judged.join(winners, _same(keys, f"_w{k}"), "left")
        later = (F.size("_broken") == 0) & (F.col("seq") > F.col(f"_first{k}"))
        lost.append(_broken(f"unique_{'_'.join(keys)}_batch", later))
    if lost:
        judged = materialize(
            judged.select(*rows.columns, F.concat("_broken", F.array_compact(F.array(*lost))).alias("_broken")), "admitted"
        )
    return Admitted(
        judged.filter(F.size("_broken") == 0).drop("_broken"),
        judged.select("seq", F.col(own).alias("key"), F.explode("_broken").alias("b")).select(
            "seq", "key", "b.rule", "b.error"
        ),
        catalog.version,
    )


def publish_admitted(
    catalog: SiteCatalog, site: str, name: str, rows: DataFrame, changed: list[str] | None = None,
    tag: str | None = None, all_or_nothing: bool = False,
) -> Admitted:
    """Check a batch and write what may enter the published table, against the version it was checked on.

    Inserts are appended, updates rewrite the buckets they touch. ``all_or_nothing`` raises
    :class:`Refused` instead when any row is refused.
    """
    admitted = admit(catalog, site, name, rows, changed)
    if all_or_nothing and (bad := admitted.refused.take(5)):
        raise Refused(f"rows refused by {name} at {site}: {[tuple(r) for r in bad]}")
    place, own = (site, _place(name, site)), RELATIONS[name].key
    new = admitted.accepted.drop("seq")
    relied_on = [(s, f"bilet_{s.lower()}") for s in ("AM", "EU")] if name == "bilet" else []
    if changed is None:
        catalog.publish_changes(appends={place: new}, tag=tag, base=admitted.base, relied_on=relied_on)
        return admitted

    def replace(current: DataFrame, batch: DataFrame) -> DataFrame:
        kept = current.join(batch.select(own), own, "left_anti")
        present = batch.join(current.select(own), own, "left_semi")  # an absent key does nothing
        return kept.unionByName(present.select(*current.columns))

    catalog.publish_changes({place: (new, replace)}, tag=tag, base=admitted.base, relied_on=relied_on)
    return admitted
