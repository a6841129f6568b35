"""Connected components by alternating large-star and small-star steps, in DataFrame operations.

Each round rewires edges towards the smallest node of a neighbourhood; both steps are one grouped minimum and one
join. The edges stay distributed; rounds are cut by tables in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stored


def _star(around: DataFrame, small: bool) -> DataFrame:
    """Link the neighbours v of each node u to the smallest of them and u; ``small``: u is linked as well."""
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = around.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        linked = linked.unionByName(least.select("u", F.col("m").alias("v")))
    return linked.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the component's smallest node."""
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    current, mark = stored(ordered, "edges"), None
    while True:
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: only larger neighbours move; u itself stays where it is
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        current = stored(_star(large, small=True), "edges")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
