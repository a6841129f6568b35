"""Exact running sums over a *global* order without funnelling all rows through one task.

``Window.orderBy(x)`` with no partition key moves every row to a single partition. For orders over
unbounded domains (e.g. model scores) we use the two-level scheme instead:

1. ``repartitionByRange(n, order)``: contiguous, ordered key ranges; equal keys share a partition
   (range ids checkpointed, so every consumer sees the same ones).
2. Per-range totals (n rows) -> exclusive running offsets (a window over n rows only).
3. Within each range: a window partitioned by the range id, ordered by the key, plus the offset.

Every step is parallel; only the n per-range totals meet in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import cut_lineage


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], partitions: int | None = None,
                 inclusive: bool = True, prefix: str = "cum_") -> DataFrame:
    """Add ``<prefix><col>`` = sum of ``col`` over rows with ``order_col`` <= (or <, if not inclusive) this
    row's key, in ascending key order. Rows must be unique per ``order_col`` (aggregate first)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The range id is stored as data by a reliable checkpoint: both consumers below (totals and local
    # sums) then see the same ids whatever adaptive coalescing or a recomputation after executor loss does.
    ranged = cut_lineage(df.repartitionByRange(n, F.col(order_col)).withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # n rows: bounded
    offsets = totals.select(
        "__range", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sum_cols]
    )
    frame = (0 if inclusive else -1)
    w = Window.partitionBy("__range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, frame)
    local = ranged.select(
        "*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"__l_{c}") for c in sum_cols]
    )
    out = local.join(F.broadcast(offsets), "__range")  # offsets: one row per range partition
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"__l_{c}") + F.col(f"__o_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
    )
