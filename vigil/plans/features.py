"""Point-in-time inspection features (one row per physical inspection, only strictly earlier events).

Plan shape (the scalable replacement of "join every target with all earlier rows of its site"):

1. Every source is reduced to *site-day deltas*: one row per (fei_number, day) with counts / maxima of
   what became known that day. Distinct counts use the first-date trick: a value is +1 on the first
   day it is seen at the site (``min(day)`` per (site, value)); "cited in >= 2 inspections" is +1 on
   the day the second distinct inspection cites it.
2. The deltas of all sources are unioned and aggregated per (fei_number, day) with map-side partial
   aggregation, so a hot site never ships more than one row per day through the next shuffle.
3. One window ``partitionBy(fei).orderBy(day).rowsBetween(unboundedPreceding, -1)`` turns deltas into
   "everything strictly before this day" (days are distinct after step 2, so ``-1`` row == earlier day;
   same-day inspections never see each other). A window partition holds at most one row per calendar
   day of the site, a bound that does not grow with the row count.
4. Targets equi-join the running table on (fei_number, prediction_date). AQE splits skewed join keys.

Shuffles: G2 aggregate, the per-source first-date aggregates, the (fei, day) aggregate, the window and
the final equi-join. No range join, no cross join, nothing collected per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import set_aside

# Classification codes in severity order (NAI = 0, VAI = 1, OAI = 2).
SEVERITY_CODES = ("NAI", "VAI", "OAI")

# Product-type categories as lower-case substrings (SQL ``LIKE '%word%'``).
# A product type may fall in several categories ("Animal Drugs" is drug and veterinary).
PRODUCT_CATEGORIES = {
    "food": ("food",),
    "drug": ("drug", "pharma"),
    "device": ("device",),
    "biologic": ("biologic", "blood", "tissue"),
    "veterinary": ("veterinar", "animal"),
    "tobacco": ("tobacco",),
}

DAY = "prediction_date"
KEY = "fei_number"

#: intervals of one site and year that go to one join key in ``cfr_history``
CFR_PART_ROWS = 50_000

SOURCES = ("inspections", "products", "citations", "cfr", "published483", "warning_letters", "recalls")


# ---------------------------------------------------------------------------------------------- G1-G3


def site_key(col: str | Column) -> Column:
    """Site key as the feature statement normalises it: text, surrounding spaces removed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c.cast("string"))


def severity_of(code: Column) -> Column:
    norm = F.upper(F.trim(code))
    out = F.lit(None).cast("int")
    for level, name in reversed(list(enumerate(SEVERITY_CODES))):
        out = F.when(norm == name, F.lit(level)).otherwise(out)
    return out


def classification_of(severity: Column) -> Column:
    out = F.lit(None).cast("string")
    for level, name in reversed(list(enumerate(SEVERITY_CODES))):
        out = F.when(severity == level, F.lit(name)).otherwise(out)
    return out


def normalized_inspection_rows(inspections: DataFrame, cutoff_date: str | None = None) -> DataFrame:
    """G1: US rows with a site, a date and a known code; severity NAI 0 / VAI 1 / OAI 2.

    ``cutoff_date`` (G20) keeps rows dated on or before it; the default keeps everything.
    """
    fei = site_key("fei_number")
    code = F.upper(F.trim(F.col("classification_code")))
    cond = (
        F.col("inspection_id").isNotNull()
        & F.col("fei_number").isNotNull()
        & (F.col("country") == "United States")
        & (fei != "")
        & F.col("inspection_end_date").isNotNull()
        & code.isin(*SEVERITY_CODES)
    )
    if cutoff_date is not None:
        cond = cond & (F.col("inspection_end_date") <= F.to_date(F.lit(cutoff_date)))
    return inspections.where(cond).select(
        "inspection_id",
        fei.alias(KEY),
        "inspection_end_date",
        F.nullif(F.trim("state"), F.lit("")).alias("state"),
        F.nullif(F.trim("product_type"), F.lit("")).alias("product_type"),
        "project_area",
        severity_of(F.col("classification_code")).alias("severity"),
    )


def inspection_events(rows: DataFrame) -> DataFrame:
    """Project-area rows collapsed per (inspection, site); the worst area is the target."""
    return rows.groupBy("inspection_id", KEY).agg(
        F.max("inspection_end_date").alias("inspection_end_date"),
        F.max("severity").alias("severity"),
        F.max("state").alias("state"),
        F.count(F.lit(1)).cast("int").alias("source_row_count"),
        F.count_distinct("project_area").cast("int").alias("project_area_count"),
    )


def labeled_inspections(events: DataFrame) -> DataFrame:
    """Date becomes the prediction date; severity becomes the label."""
    return events.select(
        "inspection_id",
        KEY,
        F.col("inspection_end_date").alias(DAY),
        "state",
        "severity",
        classification_of(F.col("severity")).alias("classification"),
        (F.col("severity") > 0).alias("adverse_classification"),
        "source_row_count",
        "project_area_count",
    )


def inspection_product_types(rows: DataFrame) -> DataFrame:
    """Distinct (inspection, site, product type)."""
    return rows.where(F.col("product_type").isNotNull()).select("inspection_id", KEY, "product_type").distinct()


def compliance_action_events(actions: DataFrame) -> DataFrame:
    """Action-product rows deduplicated into site-level actions with a stable key.

    The key is the trimmed case id, or ``fei|date|type`` when the case id is blank.
    """
    fei = site_key("fei_number")
    typ = F.lower(F.trim(F.col("action_type")))
    key = F.coalesce(
        F.nullif(F.trim(F.col("case_injunction_id").cast("string")), F.lit("")),
        F.concat_ws("|", fei, F.col("action_taken_date").cast("string"), typ),
    )
    return (
        actions.where(F.col("fei_number").isNotNull() & (fei != "") & F.col("action_taken_date").isNotNull())
        .select(fei.alias(KEY), "action_taken_date", typ.alias("action_type"), key.alias("action_key"))
        .distinct()
    )


def category_flag(product: Column, name: str) -> Column:
    lc = F.lower(product)
    return reduce(lambda a, b: a | b, [lc.contains(w) for w in PRODUCT_CATEGORIES[name]])


def other_flag(product: Column) -> Column:
    lc = F.lower(product)
    words = [w for ws in PRODUCT_CATEGORIES.values() for w in ws]
    return product.isNotNull() & ~reduce(lambda a, b: a | b, [lc.contains(w) for w in words])


# ------------------------------------------------------------------------------ site-day delta frames


def citations_per_inspection(citations: DataFrame) -> DataFrame:
    """Citation rows per inspection id (partial aggregation before the shuffle)."""
    return (
        citations.where(F.col("inspection_id").isNotNull())
        .groupBy("inspection_id")
        .agg(F.count(F.lit(1)).alias("n_cit"))
    )


def inspection_days(labeled: DataFrame, citations: DataFrame | None = None) -> DataFrame:
    """Per inspection event, its site-day delta: one inspection, its severity, the latest (date, id)
    with severity and citation count, its citation rows, and whether it has any citation.

    Delta frames are *not* aggregated here: :func:`site_timeline` aggregates all sources in one
    (site, day) aggregate, partial aggregation running map-side on the unioned rows."""
    ev = labeled
    if citations is not None:
        ev = ev.join(citations_per_inspection(citations), "inspection_id", "left")
        n_cit = F.coalesce(F.col("n_cit"), F.lit(0).cast("long"))
    else:
        n_cit = F.lit(0).cast("long")
    ev = ev.withColumn("n_cit", n_cit)
    latest = F.struct(
        F.col(DAY).alias("date"),
        F.col("inspection_id").alias("id"),
        F.col("severity").alias("sev"),
        F.col("n_cit").alias("n_cit"),
    )
    return ev.select(
        KEY,
        DAY,
        F.lit(1).cast("long").alias("d_insp"),
        F.col("severity").alias("m_sev"),
        latest.alias("m_latest"),
        F.col("n_cit").alias("d_cit"),
        (F.col("n_cit") > 0).cast("long").alias("d_insp_cited"),
    )


def product_days(rows: DataFrame, labeled: DataFrame) -> DataFrame:
    """Per (site, product type): +1 on the day the type is first seen, with its category flags."""
    dated = inspection_product_types(rows).join(labeled.select("inspection_id", KEY, DAY), ["inspection_id", KEY])
    first = dated.groupBy(KEY, "product_type").agg(F.min(DAY).alias(DAY))
    p = F.col("product_type")
    flags = [category_flag(p, n).cast("int").alias(f"m_{n}") for n in PRODUCT_CATEGORIES]
    flags.append(other_flag(p).cast("int").alias("m_other"))
    return first.select(KEY, DAY, F.lit(1).cast("long").alias("d_new_product"), *flags)


def cited_cfrs(citations: DataFrame, labeled: DataFrame) -> DataFrame:
    """Distinct (inspection, site, date, normalised CFR) for non-blank CFRs of labelled inspections."""
    cfr = F.upper(F.trim(F.col("act_cfr_number")))
    cited = (
        citations.where(F.col("act_cfr_number").isNotNull() & (F.trim(F.col("act_cfr_number")) != ""))
        .select("inspection_id", cfr.alias("normalized_cfr"))
        .distinct()
    )
    return cited.join(labeled.select("inspection_id", KEY, DAY), "inspection_id")


def cfr_day_counts(cfrs: DataFrame) -> DataFrame:
    """Per (site, CFR, day): distinct inspections citing it, with the running total up to that day.

    The window partition is one (site, CFR) pair and holds one row per day it was cited."""
    per_day = cfrs.groupBy(KEY, "normalized_cfr", DAY).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(KEY, "normalized_cfr").orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("cum", F.sum("n").over(w))


def cfr_intervals(cfrs: DataFrame) -> DataFrame:
    """(site, CFR, since, until, cited): one row per change of a pair's count; it holds for days after ``since`` up to and
    including ``until`` (NULL: no further change)."""
    later = Window.partitionBy(KEY, "normalized_cfr").orderBy(DAY)
    return cfr_day_counts(cfrs).withColumn("until", F.lead(DAY).over(later)).select(
        KEY, "normalized_cfr", F.col(DAY).alias("since"), "until", F.col("cum").cast("int").alias("cited")
    )


def cfr_days(cfrs: DataFrame) -> DataFrame:
    """Per (site, CFR, day): +1 new CFR on its first cited day, +1 repeated CFR on the day its second
    distinct inspection cites it."""
    c = cfr_day_counts(cfrs)
    before = F.col("cum") - F.col("n")
    return c.select(
        KEY,
        DAY,
        (before == 0).cast("long").alias("d_new_cfr"),
        ((F.col("cum") >= 2) & (before < 2)).cast("long").alias("d_repeat_cfr"),
    )


def published483_days(published: DataFrame) -> DataFrame:
    """Per (site, record): +1 on the day the record is known (record and publish date both passed)."""
    fei = site_key("fei_number")
    usable = published.where(
        F.col("fei_number").isNotNull()
        & (fei != "")
        & F.col("record_id").isNotNull()
        & F.col("record_date").isNotNull()
        & F.col("publish_date").isNotNull()
    )
    first = usable.groupBy(fei.alias(KEY), "record_id").agg(
        F.min(F.greatest("record_date", "publish_date")).alias(DAY)
    )
    return first.select(KEY, DAY, F.lit(1).cast("long").alias("d_new_483"))


def warning_letter_days(action_events: DataFrame) -> DataFrame:
    """Per (site, warning-letter action key): +1 on the day it is first seen."""
    first = (
        action_events.where(F.col("action_type").like("%warning%"))
        .groupBy(KEY, "action_key")
        .agg(F.min("action_taken_date").alias(DAY))
    )
    return first.select(KEY, DAY, F.lit(1).cast("long").alias("d_new_warning"))


def recall_days(recalls: DataFrame) -> DataFrame:
    """Per (site, recall event): +1 on the day it is first classified."""
    fei = site_key("fei_number")
    usable = recalls.where(
        F.col("fei_number").isNotNull()
        & (fei != "")
        & F.col("event_id").isNotNull()
        & F.col("center_classification_date").isNotNull()
    )
    first = usable.groupBy(fei.alias(KEY), "event_id").agg(F.min("center_classification_date").alias(DAY))
    return first.select(KEY, DAY, F.lit(1).cast("long").alias("d_new_recall"))


# ------------------------------------------------------------------------------------- the timeline


def site_timeline(deltas: list[DataFrame]) -> DataFrame:
    """Union the site-day deltas, aggregate per (site, day), then one running window of all earlier days.

    Columns ``d_*`` are summed, ``m_*`` are maxed. Output columns drop the prefix and hold the value
    over all strictly earlier days: ``p_<name>`` (counts default 0) and ``p_<name>`` for maxima (NULL
    when nothing earlier).
    """
    unioned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), deltas)
    cols = [c for c in unioned.columns if c not in (KEY, DAY)]
    daily = unioned.groupBy(KEY, DAY).agg(
        *[(F.sum(c) if c.startswith("d_") else F.max(c)).alias(c) for c in cols]
    )
    w = Window.partitionBy(KEY).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    running = []
    for c in cols:
        name = "p_" + c[2:]
        if c.startswith("d_"):
            running.append(F.coalesce(F.sum(c).over(w), F.lit(0)).cast("int").alias(name))
        else:
            running.append(F.max(c).over(w).alias(name))
    if "d_insp" in cols:
        day_if_insp = F.when(F.col("d_insp") > 0, F.col(DAY))
        running.append(F.min(day_if_insp).over(w).alias("p_first_date"))
        running.append(F.max(day_if_insp).over(w).alias("p_last_date"))
    return daily.select(KEY, DAY, *running)


class FeaturePlan:
    """Builds the point-in-time frames of one set of canonical tables.

    ``tables`` needs ``inspections`` and, per source used, ``citations``, ``published483``,
    ``compliance_actions``, ``recalls`` (a :class:`vigil.sources.catalog.Catalog` fits).
    """

    def __init__(self, tables, cutoff_date: str | None = None, stepwise: bool = False):
        """``stepwise`` sets aside the rows, the events and the deltas of each source, one after the other, so that the shuffle
        files of all sources are not on disk at once; for callers that run the plan right away."""
        self.t = tables
        self._held = set_aside if stepwise else lambda df: df
        self.rows = self._held(normalized_inspection_rows(tables.inspections, cutoff_date))
        self.events = self._held(inspection_events(self.rows))
        # one row per inspection, fed to the timeline, the product and CFR joins and the final join. Callers that build
        # several frames from one plan may cache it with ``keep`` and must then ``close``.
        self.labeled = labeled_inspections(self.events)
        self._kept = False

    def keep(self) -> FeaturePlan:
        """Hold the labelled events (memory, then disk) until ``close``."""
        self.labeled.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept = True
        return self

    def close(self) -> None:
        if self._kept:
            self.labeled.unpersist()
            self._kept = False

    def deltas(self, sources=SOURCES) -> list[DataFrame]:
        out = [inspection_days(self.labeled, self.t.citations if "citations" in sources else None)]
        if "products" in sources:
            out.append(product_days(self.rows, self.labeled))
        if "cfr" in sources:
            out.append(cfr_days(cited_cfrs(self.t.citations, self.labeled)))
        if "published483" in sources:
            out.append(published483_days(self.t.published483))
        if "warning_letters" in sources:
            out.append(warning_letter_days(compliance_action_events(self.t.compliance_actions)))
        if "recalls" in sources:
            out.append(recall_days(self.t.recalls))
        return [self._held(d) for d in out]

    def history(self, sources=SOURCES) -> DataFrame:
        """Labelled targets with every ``p_*`` running column of the requested sources."""
        timeline = site_timeline(self.deltas(sources))
        return self.labeled.join(timeline, [KEY, DAY], "inner")

    # --- per-CTE views -------------------------------------------------------------------------

    def inspection_history(self) -> DataFrame:
        """Prior count, first/previous date, worst severity, previous id and severity."""
        h = self.history(("inspections",))
        return h.select(
            "inspection_id",
            F.col("p_insp").alias("prior_inspection_count"),
            F.col("p_first_date").alias("first_inspection_date"),
            F.col("p_last_date").alias("previous_inspection_date"),
            F.col("p_sev").cast("int").alias("historical_worst_severity"),
            F.col("p_latest.id").alias("previous_inspection_id"),
            F.col("p_latest.sev").cast("int").alias("previous_severity"),
        )

    def product_history(self) -> DataFrame:
        """Distinct earlier product types and category flags."""
        h = self.history(("inspections", "products"))
        flags = [
            F.coalesce(F.col(f"p_{n}"), F.lit(0)).cast("short").alias(f"has_prior_product_{n}")
            for n in (*PRODUCT_CATEGORIES, "other")
        ]
        return h.select(
            "inspection_id", F.col("p_new_product").alias("historical_product_type_count"), *flags
        )

    def citation_history(self) -> DataFrame:
        """Earlier citation rows, those of the previous inspection, earlier inspections having any."""
        h = self.history(("inspections", "citations"))
        return h.select(
            "inspection_id",
            F.col("p_cit").alias("prior_citation_count"),
            F.coalesce(F.col("p_latest.n_cit"), F.lit(0)).cast("int").alias("previous_inspection_citation_count"),
            F.col("p_insp_cited").alias("prior_inspections_with_citations"),
        )

    def repeated_cfr(self) -> DataFrame:
        """Targets with at least one earlier cited CFR, and how many were cited in >= 2 inspections."""
        h = self.history(("inspections", "cfr"))
        return h.where(F.col("p_new_cfr") > 0).select(
            "inspection_id", F.col("p_repeat_cfr").alias("repeated_cfr_count")
        )

    def cfr_history(self, part_rows: int = CFR_PART_ROWS) -> DataFrame:
        """Per target and CFR, distinct earlier inspections citing that CFR at the site.

        The output is one row per (target, CFR seen before it) by definition; nothing is expanded to that size before. A pair's
        count is stored where it changes, as an interval of days, written once per calendar year that it reaches into; a
        target meets the intervals of its site and year, of which exactly one per CFR holds its day. A (site, year) with
        more than ``part_rows`` intervals is split by CFR, and its targets are given to every part.
        """
        changes = cfr_intervals(cited_cfrs(self.t.citations, self.labeled))
        last = self.labeled.groupBy(KEY).agg(F.max(DAY).alias("last_day"))
        until = F.least(F.coalesce("until", "last_day"), F.col("last_day"))
        intervals = changes.join(last, KEY).where(F.col("since") < F.col("last_day")).select(
            KEY, "normalized_cfr", "since", until.alias("until"), "cited",
            F.explode(F.sequence(F.year(F.date_add("since", 1)), F.year(until))).alias("year"),
        )
        heavy = intervals.groupBy(KEY, "year").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows)
        heavy = heavy.select(KEY, "year", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))
        parts = F.coalesce("parts", F.lit(1))
        split = intervals.join(heavy, [KEY, "year"], "left").withColumn("part", F.pmod(F.xxhash64("normalized_cfr"), parts).cast("int"))
        targets = self.labeled.select("inspection_id", KEY, DAY, F.year(DAY).alias("year")).join(heavy, [KEY, "year"], "left")
        targets = targets.select("inspection_id", KEY, DAY, "year", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        held = targets.join(split.drop("parts"), [KEY, "year", "part"]).where((F.col("since") < F.col(DAY)) & (F.col(DAY) <= F.col("until")))
        return held.select("inspection_id", "normalized_cfr", F.col("cited").alias("cited_inspection_count"))

    def published_483_history(self) -> DataFrame:
        h = self.history(("inspections", "published483"))
        return h.select("inspection_id", F.col("p_new_483").alias("prior_published_483_count"))

    def warning_letter_history(self) -> DataFrame:
        h = self.history(("inspections", "warning_letters"))
        return h.select("inspection_id", F.col("p_new_warning").alias("prior_warning_letter_count"))

    def recall_history(self) -> DataFrame:
        h = self.history(("inspections", "recalls"))
        return h.select("inspection_id", F.col("p_new_recall").alias("prior_recall_event_count"))

    # --- the feature table ---------------------------------------------------------------------

    def features(self, dataset_version: str = "v1", variant: str = "production", min_prior: int = 0, strict_storage: bool = False) -> DataFrame:
        """The feature table (``created_at`` is added by the writer, not here).

        ``min_prior`` keeps rows with at least so many earlier inspections; ``strict_storage`` stores the recall rate
        as the integer that the reference's table holds (rounded half to even) instead of a double.

        ``variant="exploratory"`` is the notebook form: no ``dataset_version``/``target_severity``,
        raw 483 / warning / recall counts, warning rate NULL without prior inspections, no recall rate.
        """
        h = self.history(SOURCES)
        prior = F.col("p_insp")
        if min_prior:
            h = h.where(prior >= min_prior)

        def rate(x: str, none_value=0.0) -> Column:
            return F.when(prior == 0, F.lit(none_value).cast("double")).otherwise(
                F.try_divide(F.col(x).cast("double"), prior.cast("double"))
            )

        prev_sev = F.col("p_latest.sev")
        prev_adverse = (
            F.when(F.col("p_latest.id").isNull(), 0)
            .when(prev_sev == 0, 0)
            .when(prev_sev.isin(1, 2), 1)
            .cast("short")
        )
        flags = [
            F.coalesce(F.col(f"p_{n}"), F.lit(0)).cast("short").alias(f"has_prior_product_{n}")
            for n in (*PRODUCT_CATEGORIES, "other")
        ]
        head = [
            "inspection_id",
            KEY,
            DAY,
            F.col("classification").alias("target_classification"),
        ]
        if variant == "production":
            head = [F.lit(dataset_version).alias("dataset_version")] + head + [
                F.col("severity").cast("short").alias("target_severity")
            ]
        body = [
            F.col("adverse_classification").alias("target_adverse"),
            prior.alias("prior_inspection_count"),
            F.when(prior == 0, 1).otherwise(0).cast("short").alias("is_first_observed_inspection"),
            F.coalesce(F.datediff(F.col(DAY), F.col("p_last_date")), F.lit(0)).alias("days_since_previous_inspection"),
            prev_adverse.alias("previous_classification_adverse"),
            F.col("p_new_product").alias("historical_product_type_count"),
            *flags,
            F.col("p_cit").alias("prior_citation_count"),
            F.coalesce(F.col("p_latest.n_cit"), F.lit(0)).cast("int").alias("previous_inspection_citation_count"),
            rate("p_cit").alias("prior_citations_per_inspection"),
            F.col("p_repeat_cfr").alias("repeated_cfr_count"),
            "state",
        ]
        if variant == "production":
            tail = [
                rate("p_new_483").alias("prior_published_483_count_per_inspection"),
                rate("p_new_warning").alias("prior_warning_letter_count_per_inspection"),
                (F.bround(rate("p_new_recall")).cast("int") if strict_storage else rate("p_new_recall")).alias("prior_recall_event_count_per_inspection"),
            ]
        elif variant == "exploratory":
            tail = [
                F.col("p_new_483").alias("prior_published_483_count"),
                rate("p_new_483").alias("prior_published_483_count_per_inspection"),
                F.col("p_new_warning").alias("prior_warning_letter_count"),
                rate("p_new_warning", None).alias("prior_warning_letter_count_per_inspection"),
                F.col("p_new_recall").alias("prior_recall_event_count"),
            ]
        else:
            raise ValueError(f"unknown variant {variant!r}")
        return h.select(*head, *body, *tail)

    def cold_start(self) -> DataFrame:
        f = self.features()
        return f.select(
            "inspection_id",
            "is_first_observed_inspection",
            "days_since_previous_inspection",
            "previous_classification_adverse",
        )

    def per_inspection_rates(self) -> DataFrame:
        f = self.features()
        return f.select(
            "inspection_id",
            "prior_citations_per_inspection",
            "prior_published_483_count_per_inspection",
            "prior_warning_letter_count_per_inspection",
            "prior_recall_event_count_per_inspection",
        )
