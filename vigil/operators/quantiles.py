"""Exact quantiles by distributed rank selection: histograms narrow down where a wanted rank lies, only those brackets are sorted.

``percentile`` keeps every distinct value of a group in one aggregation buffer. Here no buffer, window or task grows with the
number of distinct values:

1. Round 0 counts each group's rows per bucket of a monotone function of the value (its sign and logarithm, so that a bucket spans
   at most a factor of two), with the least and greatest value seen; at most a few thousand rows per group, summed map-side.
2. Running counts over those rows tell which buckets hold a wanted rank: at most two per probability and group. A bracket whose
   least and greatest value agree is resolved, however many rows it has.
3. Brackets with more than ``rows_at_once`` rows are split again into equal widths. A double has 53 significant bits and every
   round takes twelve of them, so at most five such rounds exist; a bracket narrows around the values that are there.
4. The rows of the remaining brackets, at most ``rows_at_once`` each, are counted per value and ranked.

The values are read once and cut off from their lineage; every later round reads that copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import cut_lineage

ROWS_AT_ONCE = 1 << 16
SPLITS = 1 << 12
_PER_E = 2.8  # buckets per factor of e in round 0
_SMALLEST = 746.0  # above -ln of the least positive double


def _rough(v: Column) -> Column:
    """Round 0's bucket: monotone in v, infinities and NaN (the greatest value, as in a sort) have buckets of their own."""
    size = F.when(F.abs(v) == float("inf"), 1470.0).otherwise(F.ln(F.abs(v)) + _SMALLEST)
    place = F.when(F.isnan(v), 1480.0).when(v == 0, 0.0).when(v > 0, size).otherwise(-size)
    return F.floor(place * _PER_E).cast("int")


def _holding(histogram: DataFrame, within: list[str]) -> DataFrame:
    """The histogram's rows that hold a wanted rank, with ``below`` (rows of the group before them) and those ``ranks``."""
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.withColumn("below", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    held = F.filter("wanted", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))
    return placed.withColumn("ranks", held).where(F.size("ranks") > 0).select("g", "below", "n", "low", "high", "ranks")


def _inside(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """(g, v, below, low, high, ranks) of the rows that lie in a bracket of their group; brackets do not overlap."""
    per_group = brackets.groupBy("g").agg(F.collect_list(F.struct("low", "high", "below", "ranks")).alias("all"))  # two per probability
    own = F.filter("all", lambda b: (F.col("v") >= b["low"]) & (F.col("v") <= b["high"]))
    found = rows.join(per_group, "g").select("g", "v", own.alias("own")).where(F.size("own") > 0)
    return found.select("g", "v", F.col("own")[0].alias("b")).select("g", "v", "b.below", "b.low", "b.high", "b.ranks")


def _ranked(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """(g, rank, v) of the wanted ranks in brackets of bounded size."""
    counts = _inside(rows, brackets).groupBy("g", "below", "v").agg(F.count(F.lit(1)).alias("n"), F.first("ranks").alias("ranks"))
    before = Window.partitionBy("g", "below").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("at", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    hit = F.filter("ranks", lambda r: (r >= F.col("at")) & (r < F.col("at") + F.col("n")))
    return placed.select("g", F.explode(hit).alias("rank"), "v")


def brackets_of(rows: DataFrame, probabilities: Sequence[float], rows_at_once: int = ROWS_AT_ONCE) -> tuple[DataFrame, int]:
    """Brackets (g, below, n, low, high, ranks) that hold the wanted ranks of ``rows`` (g, v), each of one value or of at most
    ``rows_at_once`` rows, and the number of rounds it took after round 0."""
    hist = rows.groupBy("g", _rough(F.col("v")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    total = F.sum("n").over(Window.partitionBy("g"))  # a few thousand buckets at most
    position = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    wanted = F.array_distinct(F.array(*[f(x).cast("long") for x in position for f in (F.floor, F.ceil)]))
    hist = hist.withColumn("total", total).withColumns({"wanted": wanted, "start": F.lit(0).cast("long")})
    found, rounds = cut_lineage(_holding(hist, ["g"])), 0
    wide = (~F.col("low").eqNullSafe(F.col("high"))) & (F.col("n") > rows_at_once)
    while not found.where(wide).isEmpty():
        rounds += 1
        inner = _inside(rows, found.where(wide))
        bucket = F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * SPLITS).cast("int")
        split = inner.groupBy("g", "below", bucket.alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lower"), F.max("v").alias("upper"), F.first("ranks").alias("wanted")
        ).withColumnsRenamed({"below": "start", "lower": "low", "upper": "high"})
        found = cut_lineage(found.where(~wide).unionByName(_holding(split, ["g", "start"])))
    return found, rounds


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (), rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """One row per group (NULLs form a group): its columns and ``quantiles``, an array of doubles, one per probability, by linear
    interpolation between the neighbouring ranks (as ``percentile``). NULL values are left out; a group without values has no
    row; without ``groups`` there is one row, or none for an empty input."""
    if not probabilities or any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    key = F.struct(*[F.col(f"`{g}`").alias(f"g{i}") for i, g in enumerate(groups)]) if groups else F.struct(F.lit(0).alias("g0"))
    # 0.0 takes the sign of -0.0 away: both are one value
    rows = cut_lineage(df.select(key.alias("g"), (F.col(value).cast("double") + F.lit(0.0)).alias("v")).where("v IS NOT NULL"))
    found, _ = brackets_of(rows, probabilities, rows_at_once)
    single = F.col("low").eqNullSafe(F.col("high"))
    ranked = found.where(single).select("g", F.explode("ranks").alias("rank"), F.col("low").alias("v")).unionByName(_ranked(rows, found.where(~single)))
    per_group = ranked.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    totals = rows.groupBy("g").agg(F.count(F.lit(1)).alias("total"))
    joined = per_group.join(totals, "g")

    def interpolated(p: float) -> Column:
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.floor(position).cast("long"), F.ceil(position).cast("long")
        mixed = F.element_at("at", low) * (high - position) + F.element_at("at", high) * (position - low)
        return F.when(low == high, F.element_at("at", low)).otherwise(mixed)

    return joined.select(*[F.col(f"g.g{i}").alias(g) for i, g in enumerate(groups)], F.array(*[interpolated(p) for p in probabilities]).alias("quantiles"))
