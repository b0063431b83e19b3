"""Global relations rebuilt from the fragments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefold.sources.sites import SiteCatalog


def union_fragments(*parts: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, parts)


#: What is true of every row of a fragment: keys of AM are odd, keys of EU even, and the
#: bookings carry their region.
FRAGMENT_RULES = {
    "rezervare": {
        "AM": lambda: (F.col("regiune_vanzare") == "AM") & (F.col("id_rezervare") % 2 != 0),
        "EU": lambda: (F.col("regiune_vanzare") == "EU") & (F.col("id_rezervare") % 2 == 0),
    },
    "plata": {
        "AM": lambda: F.col("id_rezervare") % 2 != 0,
        "EU": lambda: F.col("id_rezervare") % 2 == 0,
    },
    "bilet": {
        "AM": lambda: F.col("id_rezervare") % 2 != 0,
        "EU": lambda: F.col("id_rezervare") % 2 == 0,
    },
}


def view_horizontal(
    catalog: SiteCatalog, name: str, site_column: str | None = None, prune: bool = False
) -> DataFrame:
    """Union of the site fragments ``<name>_<site>``.

    ``site_column`` adds a literal with the site, and ``prune`` attaches the predicate that
    defines each fragment. Catalyst drops a branch when a filter on the view contradicts the
    literal or the predicate, so a query about one site or one key reads one fragment. Rows
    that break their fragment's predicate would be hidden, so ``prune`` is for checked data.
    """
    parts = []
    for site in _fragment_sites(catalog, name):
        part = catalog.table(site, f"{name}_{site.lower()}")
        if prune:
            part = part.filter(FRAGMENT_RULES[name][site]())
        if site_column:
            part = part.withColumn(site_column, F.lit(site))
        parts.append(part)
    return union_fragments(*parts)


def _fragment_sites(catalog: SiteCatalog, name: str) -> list[str]:
    sites = [s for s in ("AM", "EU") if catalog.has(s, f"{name}_{s.lower()}")]
    if not sites:
        raise KeyError(f"no fragment of {name!r}")
    return sites


def view_vertical(catalog: SiteCatalog) -> DataFrame:
    """The user relation: both vertical fragments are read at the master site and joined.

    Inner join: a user without a profile row is not visible.
    """
    sec = catalog.table(catalog.master, "utilizator_sec")
    data = catalog.table(catalog.master, "utilizator_data")
    return sec.join(data, "id_user").select(
        "id_user", "nume", "prenume", "email", "parola", "telefon", "data_inregistrare", "rol"
    )


def global_catalog(
    catalog: SiteCatalog, prune: bool = False, site_column: str | None = None
) -> dict[str, DataFrame]:
    """Register every global relation as a temporary view and return them by view name.

    All views show one version of the catalog. ``prune`` and ``site_column`` are those of
    :func:`view_horizontal`: with ``prune``, SQL that asks for one region or key reads one fragment.
    """
    catalog = catalog.snapshot()
    views = {
        f"v_{name}": view_horizontal(catalog, name, site_column, prune) for name in ("rezervare", "plata", "bilet")
    }
    views["v_utilizator"] = view_vertical(catalog)
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    for name in ("tara", "oras", "aeroport", "avion", "zbor", "pasager"):
        views[name] = catalog.synonym(name)
    return views
