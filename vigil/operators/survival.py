"""2.I survival: inspection intervals, Kaplan-Meier curves, horizons, medians and simple hazard ratios.

All curves are computed per group from (group, duration) counts, so a window partition holds one row
per distinct duration of a group (bounded by the number of calendar days observed), never per site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.quantiles import exact_quantiles
from vigil.plans.features import site_key

# Horizons (days) reported by the survival summary.
HORIZONS = (180, 365, 730, 1095)
ALL = "all"


def inspection_starts(inspections: DataFrame) -> DataFrame:
    """Per (inspection, trimmed site): latest date and the largest non-blank product type (I2 base)."""
    fei = site_key("fei_number")
    rows = inspections.where(
        F.col("inspection_id").isNotNull() & F.col("fei_number").isNotNull() & (fei != "") & F.col("inspection_end_date").isNotNull()
    )
    return rows.groupBy("inspection_id", fei.alias("fei_number")).agg(
        F.max("inspection_end_date").alias("inspection_date"),
        F.max(F.nullif(F.trim("product_type"), F.lit(""))).alias("product_type"),
    )


def product_starts(inspections: DataFrame) -> DataFrame:
    """I2 with one row per (inspection, product): no product is picked for an inspection that covers several."""
    starts = inspection_starts(inspections).drop("product_type")
    products = inspections.select("inspection_id", site_key("fei_number").alias("fei_number"), F.nullif(F.trim("product_type"), F.lit("")).alias("product_type"))
    products = products.where(F.col("product_type").isNotNull()).distinct()
    return starts.join(products, ["inspection_id", "fei_number"], "left")


def survival_intervals(inspections: DataFrame, cutoff: str, per_product: bool = False) -> DataFrame:
    """Each inspection starts an interval that ends at the site's next inspection (ordered by date,
    then id) or is censored at ``cutoff``. Only intervals starting before the cutoff are kept.

    The next inspection is found without a window over the whole site: within a day the next one is
    the same day unless this id is the day's largest; otherwise it is the site's next inspection day
    (one window over (site, day) rows). ``per_product`` gives an inspection one row per product.
    """
    ev = product_starts(inspections) if per_product else inspection_starts(inspections)
    days = ev.groupBy("fei_number", F.col("inspection_date").alias("day")).agg(F.max("inspection_id").alias("day_max_id"))
    w = Window.partitionBy("fei_number").orderBy("day")
    days = days.withColumn("next_day", F.lead("day").over(w))
    j = ev.join(days, (ev["fei_number"] == days["fei_number"]) & (ev["inspection_date"] == days["day"])).drop(days["fei_number"])
    nxt = F.when(F.col("inspection_id") < F.col("day_max_id"), F.col("inspection_date")).otherwise(F.col("next_day"))
    cut = F.to_date(F.lit(cutoff))
    observed = nxt <= cut
    return j.where(F.col("inspection_date") < cut).select(
        "inspection_id",
        "fei_number",
        F.col("inspection_date").alias("interval_start_date"),
        nxt.alias("next_inspection_date"),
        "product_type",
        F.when(observed, F.datediff(nxt, F.col("inspection_date"))).otherwise(F.datediff(cut, F.col("inspection_date"))).alias("duration_days"),
        F.when(observed, 1).otherwise(0).alias("event_observed"),
    )


def survival_summary(intervals: DataFrame, group: str = "product_type") -> DataFrame:
    """Per group: facilities, events, censored, median duration (exact, interpolated, by rank selection)."""
    known = intervals.where(F.col(group).isNotNull())
    counts = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("facilities"),
        F.sum("event_observed").alias("next_inspections"),
        F.count_if(F.col("event_observed") == 0).alias("censored"),
    )
    medians = exact_quantiles(known, "duration_days", [0.5], [group]).select(group, F.col("quantiles")[0].alias("median_observed_days"))
    return counts.join(medians, group, "left")


def _grouped(intervals: DataFrame, group: str | None) -> DataFrame:
    if group is None:
        return intervals.select(F.lit(ALL).alias("grp"), "duration_days", "event_observed")
    return intervals.where(F.col(group).isNotNull()).select(F.col(group).alias("grp"), "duration_days", "event_observed")


def km_curve(intervals: DataFrame, group: str | None = None) -> DataFrame:
    """Kaplan-Meier steps per group: at each event time S *= 1 - d/n, n = durations >= t, plus the
    first row (0, N, 0, 1.0). Same-day intervals have duration 0, so time 0 can appear twice."""
    g = _grouped(intervals, group)
    per_t = g.groupBy("grp", F.col("duration_days").alias("t")).agg(
        F.sum("event_observed").cast("long").alias("d"), F.count(F.lit(1)).alias("c")
    )
    suffix = Window.partitionBy("grp").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    at_risk = per_t.withColumn("n", F.sum("c").over(suffix)).where(F.col("d") > 0)
    running = Window.partitionBy("grp").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    steps = at_risk.select(
        "grp",
        F.col("t").cast("double").alias("time"),
        F.col("n").alias("at_risk"),
        F.col("d").alias("events"),
        F.product(1.0 - F.col("d") / F.col("n")).over(running).alias("survival_probability"),
        F.lit(1).alias("step"),
    )
    start = g.groupBy("grp").agg(F.count(F.lit(1)).alias("at_risk")).select(
        "grp", F.lit(0.0).alias("time"), "at_risk", F.lit(0).cast("long").alias("events"),
        F.lit(1.0).alias("survival_probability"), F.lit(0).alias("step"),
    )
    return start.unionByName(steps)


def _s_at(h: int) -> Column:
    """S(h): the last step at or before h (curve order = time, then start row before event row); 1.0 if none."""
    key = F.when(F.col("time") <= h, F.struct("time", "step"))
    return F.coalesce(F.max_by("survival_probability", key), F.lit(1.0))


def survival_at_horizon(curve: DataFrame, horizons=HORIZONS) -> DataFrame:
    """I4: probability of no inspection by each horizon, and its complement (one aggregate per group)."""
    agg = curve.groupBy("grp").agg(*[_s_at(h).alias(f"s{h}") for h in horizons])
    stack = ", ".join(f"{h}, s{h}" for h in horizons)
    out = agg.selectExpr("grp", f"stack({len(horizons)}, {stack}) AS (horizon_days, probability_no_inspection)")
    return out.withColumn("probability_inspected", 1.0 - F.col("probability_no_inspection"))


def median_survival(curve: DataFrame) -> DataFrame:
    """First time with S <= 0.5, NULL when the curve never gets there."""
    return curve.groupBy("grp").agg(F.min(F.when(F.col("survival_probability") <= 0.5, F.col("time"))).alias("median_days"))


def survival_by_product(intervals: DataFrame, group: str = "product_type") -> DataFrame:
    """Per group: facilities, median days to next inspection, P(inspected within 1 and 2 years)."""
    curve = km_curve(intervals, group)
    stats = curve.groupBy("grp").agg(
        F.max(F.when(F.col("step") == 0, F.col("at_risk"))).alias("facilities"),
        F.min(F.when(F.col("survival_probability") <= 0.5, F.col("time"))).alias("median_days_to_next_inspection"),
        (1.0 - _s_at(365)).alias("probability_inspected_within_1_year"),
        (1.0 - _s_at(730)).alias("probability_inspected_within_2_years"),
    )
    return stats.withColumnRenamed("grp", group)


def hazard_ratios(intervals: DataFrame, reference: str, group: str = "product_type") -> DataFrame:
    """Events per observed site-year by group, ratio to the reference group, log ratio.

    The reference hazard is a scalar subquery (one value), not a driver round trip."""
    h = intervals.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("facilities"),
        F.sum("event_observed").alias("next_inspections"),
        F.sum("duration_days").alias("observed_site_days"),
    )
    rate = F.try_divide(F.col("next_inspections").cast("double"), F.col("observed_site_days").cast("double")) * 365.25
    h = h.withColumn("inspection_hazard_per_site_year", rate)
    ref = h.where(F.col(group) == reference).agg(F.max("inspection_hazard_per_site_year")).scalar()
    ratio = F.try_divide(F.col("inspection_hazard_per_site_year"), ref)
    return h.withColumn("hazard_ratio", ratio).withColumn("log_hazard_ratio", F.ln("hazard_ratio"))


def hazard_adjusted_curves(intervals: DataFrame, reference: str, group: str = "product_type") -> DataFrame:
    """I8: proportional-hazard curves S0(t) ** HR for every group, S0 = the reference group's KM curve.

    The result has groups x baseline steps rows by definition; the two sides meet through a constant key, so Spark
    picks a broadcast only for a side under the session's size limit."""
    one = F.lit(1).alias("one")
    ratios = hazard_ratios(intervals, reference, group).select(F.col(group).alias("g"), F.col("hazard_ratio").alias("hr"), one)
    base = km_curve(intervals.where(F.col(group) == reference), group).select("time", "step", "survival_probability", one)
    return base.join(ratios, "one").select(
        F.col("g").alias(group), "time", "step", F.pow(F.col("survival_probability"), F.col("hr")).alias("adjusted_survival")
    )
