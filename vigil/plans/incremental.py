"""Incremental refresh of the feature table (A8/G17): only sites whose inputs changed are computed again.

A row of the feature table depends on rows of its own site alone, so a refresh needs to know which sites have other
inputs than at the last build. Every source row gets a 64-bit hash of the columns the features read; a site's *print* is
the count, the sum and the exclusive or of its rows' hashes, per source: it does not depend on their order and is summed
map-side. Prints are small (one row per site) and are kept beside the feature table.

A refresh compares prints, filters the sources to the changed sites before anything else is done, builds their features by
the ordinary plan, and replaces what differs: rows of a changed site before its first differing day stay as they are, with the
``created_at`` they had; late rows, corrections and deletions are all changes of a print.
"""

from __future__ import annotations

from functools import reduce
from types import SimpleNamespace
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.plans.features import DAY, KEY, FeaturePlan, site_key
from vigil.session import set_aside

# The columns of each source that the features read.
INPUTS = {
    "inspections": ("inspection_id", "fei_number", "country", "inspection_end_date", "classification_code", "state", "product_type", "project_area"),
    "published483": ("fei_number", "record_id", "record_date", "publish_date"),
    "compliance_actions": ("fei_number", "case_injunction_id", "action_taken_date", "action_type"),
    "recalls": ("fei_number", "event_id", "center_classification_date"),
}
CITATION_INPUTS = ("inspection_id", "act_cfr_number")


def _hash(columns: tuple[str, ...]):
    # the flags keep (NULL, x) and (x, NULL) apart
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _sites_of_inspections(tables) -> DataFrame:
    """Distinct (inspection_id, site): citations reach a site by their inspection."""
    return tables.inspections.where(F.col("inspection_id").isNotNull() & F.col("fei_number").isNotNull()).select(
        "inspection_id", site_key("fei_number").alias(KEY)
    ).distinct()


def site_prints(tables) -> DataFrame:
    """(fei_number, source, rows, total, mixed): one row per site and source it has rows in."""
    parts = []
    for source, columns in INPUTS.items():
        rows = getattr(tables, source).where(F.col("fei_number").isNotNull()).select(site_key("fei_number").alias(KEY), _hash(columns).alias("h"))
        parts.append(rows.select(KEY, F.lit(source).alias("source"), F.lit(1).cast("long").alias("n"), F.col("h").cast("decimal(38,0)").alias("s"), F.col("h").alias("x")))
    cited = tables.citations.where(F.col("inspection_id").isNotNull()).select("inspection_id", _hash(CITATION_INPUTS).alias("h"))
    # summed per inspection first, so an inspection's citations move as one row
    cited = cited.groupBy("inspection_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("s"), F.bit_xor("h").alias("x"))
    parts.append(cited.join(_sites_of_inspections(tables), "inspection_id").select(KEY, F.lit("citations").alias("source"), "n", "s", "x"))
    sums = (F.sum("n").alias("rows"), F.sum("s").cast("decimal(38,0)").alias("total"), F.bit_xor("x").alias("mixed"))
    # a source is summed and set aside before the next one is read, so their shuffle files are not on disk at once
    return reduce(DataFrame.unionByName, [set_aside(p.groupBy(KEY, "source").agg(*sums), "prints") for p in parts])


def changed_sites(before: DataFrame, now: DataFrame) -> DataFrame:
    """(fei_number) of the sites whose prints differ, or are in one of the two only."""
    old = before.select(KEY, "source", F.struct("rows", "total", "mixed").alias("old"))
    new = now.select(KEY, "source", F.struct("rows", "total", "mixed").alias("new"))
    return old.join(new, [KEY, "source"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select(KEY).distinct()


def of_sites(tables, sites: DataFrame) -> SimpleNamespace:
    """The source tables with the rows of the given sites only (citations: of their inspections)."""
    wanted = sites.select(F.col(KEY).alias("wanted_site"))
    kept = {s: getattr(tables, s).join(wanted, site_key("fei_number") == F.col("wanted_site"), "left_semi") for s in INPUTS}
    ids = kept["inspections"].select("inspection_id").distinct()
    return SimpleNamespace(**kept, citations=tables.citations.join(ids, "inspection_id", "left_semi"))


class Refresh(NamedTuple):
    features: DataFrame  # the whole table after the refresh
    prints: DataFrame  # the prints to keep for the next one
    first_changes: DataFrame  # (fei_number, first_day): the first day of each site on which a row differs


def refresh_features(tables, stored: DataFrame, prints: DataFrame, dataset_version: str = "v1", cutoff_date: str | None = None) -> Refresh:
    """Bring ``stored`` (an earlier build of the same version, with or without ``created_at``) up to date with ``tables``;
    ``prints`` are the site prints of that build. The result equals a full build; rows that did not change keep what they had."""
    now = site_prints(tables)
    sites = set_aside(changed_sites(prints, now))
    fresh = FeaturePlan(of_sites(tables, sites), cutoff_date, stepwise=True).features(dataset_version)
    columns = fresh.columns
    if "created_at" in stored.columns:
        fresh = fresh.withColumn("created_at", F.current_timestamp().cast(stored.schema["created_at"].dataType))
    fresh = set_aside(fresh)
    old = stored.join(sites, KEY, "left_semi")

    def marked(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("inspection_id", KEY, F.col(DAY).alias(f"{name}_day"), F.struct(*[c for c in columns if c not in ("inspection_id", KEY)]).alias(name))

    both = marked(old, "was").join(marked(fresh, "is"), ["inspection_id", KEY], "full_outer")
    differs = both.where(~F.col("was").eqNullSafe(F.col("is")))
    first = set_aside(differs.groupBy(KEY).agg(F.min(F.least("was_day", "is_day")).alias("first_day")))
    # a site whose print changed without a change of any row is left as it is
    untouched = stored.join(first, KEY, "left").where(F.col("first_day").isNull() | (F.col(DAY) < F.col("first_day"))).drop("first_day")
    renewed = fresh.join(first, KEY).where(F.col(DAY) >= F.col("first_day")).drop("first_day")
    return Refresh(untouched.unionByName(renewed.select(*stored.columns)).select(*stored.columns), now, first)
