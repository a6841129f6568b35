"""Mixing sources to target weights by systematic sampling.

Sources, in code point order with null last, weigh 5, 2, 1, repeating, and share ``SHARE`` times the words of all documents;
no target exceeds ``MAX_COPIES`` times its source's words, and what is cut there goes to the others by weight. A document's
expected copies are its source's target over its source's words. Within a source the documents stand in order of size (then of a
hash of their id): the prefix sum of expected copies, moved by one random offset per source, crosses an integer as often as the
document is emitted. Neighbours are of like size, so what one document takes too much the next ones take less, and a source's
words stay within about one long document of its target.

Scale: the texts are read once, to (row, doc_id, source, size), stored in the shared folder. Positions within a source come
from ``running_sums`` over (source, size, hash, id): contiguous ranges sorted apart, joined by one total per range, so a source
with a third of all rows is many ranges. The table of sources is summed map-side, its weights and water level are running
sums as well; it meets the documents in an equi-join, which Spark broadcasts when it is small and splits when it is skewed.

Defined cases: null text = no words; a null source is a source of its own, the last; a source without words has target 0 and
nothing of it is emitted; a null doc_id comes first of its size; rows that repeat a doc_id are rows of their own; an empty table gives an empty
result; further columns ride along in ``mix``. The offset is a function of the source and ``seed``, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.ordered import running_sums
from vigil.llm.common import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
OFFSET_DIGITS = 5  # the offset is a multiple of 16**-5, so that whole expected copies stay whole


def sized(docs: DataFrame, row_no: Column | None = None) -> DataFrame:
    """(row_no, doc_id, source, size) of every row, stored."""
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    number = F.monotonically_increasing_id() if row_no is None else row_no
    return stored(docs.select(number.alias("row_no"), "doc_id", F.col("source").cast("string").alias("source"), size.alias("size")), "sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES) -> DataFrame:
    """(source, n_docs, docs_before, source_size, target) of every source."""
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"), F.lit(1).alias("one"))
    in_order = running_sums(totals.withColumn("key", F.struct(F.col("source").isNull(), "source")), "key", ["one", "n_docs"], inclusive=False, prefix="before_")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    weighed = in_order.withColumns({"weight": weight.cast("double"), "cap": (F.col("source_size") * most).cast("double")})
    # by cap per weight, the sources that reach their cap come first; the level is what is left, over the weights left
    by_cap = running_sums(weighed.withColumn("key", F.struct(F.col("cap") / F.col("weight"), "before_one")), "key", ["cap", "weight"], inclusive=False, prefix="capped_")
    all_words, all_weight = weighed.agg(F.sum("source_size") * share).scalar(), weighed.agg(F.sum("weight")).scalar()
    left = by_cap.withColumn("level", (all_words - F.col("capped_cap")) / (all_weight - F.col("capped_weight")))
    level = left.where(F.col("cap") > F.col("level") * F.col("weight")).agg(F.min_by("level", "key").alias("level"))
    target = F.least(F.col("cap"), F.coalesce(level.scalar() * F.col("weight"), F.col("cap")))
    return weighed.select("source", "n_docs", F.col("before_n_docs").alias("docs_before"), "source_size", target.alias("target"))


def copies(sizes: DataFrame, by_source: DataFrame, seed: int = 0, most: int = MAX_COPIES) -> DataFrame:
    """(row_no, doc_id, size, source_size, target, copies) of every row of ``sizes``."""
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    key = F.struct(F.col("source").isNull().alias("last"), "source", "size", mixed.alias("mixed"), "doc_id", "row_no")
    placed = running_sums(sizes.withColumns({"key": key, "one": F.lit(1)}), "key", ["one"], inclusive=False, prefix="place_").drop("key", "one")
    facts = by_source.withColumnRenamed("source", "of_source")
    joined = placed.join(facts, F.col("source").eqNullSafe(F.col("of_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))))
    offset = F.conv(F.substring(named, 1, OFFSET_DIGITS), 16, 10).cast("double") / float(16**OFFSET_DIGITS)
    place = F.col("place_one") - F.col("docs_before")
    crossed = (F.floor((place + 1) * rate + offset) - F.floor(place * rate + offset)).cast("long")
    return joined.select("row_no", "doc_id", "size", "source_size", "target", F.least(crossed, F.lit(most).cast("long")).alias("copies"))


def plan(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, the words that the mix takes of it."""
    sizes = sized(docs)
    found = copies(sizes, stored(targets(sizes), "targets"), seed)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, all columns as they came."""
    columns = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("doc")
    # stored first: a row's number must mean the same row to the plan and to the join
    held = stored(docs.select(row, F.monotonically_increasing_id().alias("at"), "doc_id", "source", "text"), "mix-rows")
    sizes = sized(held, F.col("at"))
    chosen = copies(sizes, stored(targets(sizes), "targets"), seed).where("copies > 0").select(F.col("row_no").alias("at"), "copies")
    emitted = held.select("at", "doc").join(chosen, "at").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return emitted.select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(columns)])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][pos % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT a.*, (SELECT sum(source_size) * 1.5::DOUBLE FROM w) - coalesce(sum(b.cap), 0) AS words_left,
             (SELECT sum(weight) FROM w) - coalesce(sum(b.weight), 0) AS weight_left
      FROM w a LEFT JOIN w b ON (b.cap / b.weight, b.pos) < (a.cap / a.weight, a.pos) GROUP BY ALL),
l AS (SELECT arg_min(words_left / weight_left, (cap / weight, pos)) AS level FROM v WHERE cap > words_left / weight_left * weight),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target,
             ('0x' || left(md5('0:' || coalesce(source, '')), 5))::BIGINT / 1048576.0::DOUBLE AS shift FROM w, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.shift, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5('0:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id) - 1 AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(2, floor((place + 1) * rate + shift) - floor(place * rate + shift)) * size)::BIGINT AS taken FROM p"""
