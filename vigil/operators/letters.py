"""2.D warning letters as a Spark job over landed listing payloads and landed pages (no HTTP here).

HTML is handled by expressions on the JVM side (``functions/html.py``): a fragment's text is its text nodes, each
stripped of surrounding whitespace, empty ones dropped, joined by a space (listing cells, titles) or a
newline (page content). Script, style and comment contents are not text nodes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.clean import py_strip
from vigil.functions.html import element, text_nodes, unescape, without_non_text
from vigil.functions.ordered import running_sums

PAGE_SIZE = 10


def fragment_text(fragment: Column, sep: str = " ") -> Column:
    """The text nodes of an HTML fragment, stripped, empty ones dropped, joined by ``sep``."""
    return F.array_join(text_nodes(without_non_text(fragment)), sep)


def first_href(fragment: Column) -> Column:
    """The href of the first ``<a href=...>`` in a fragment, references decoded, NULL when none."""
    h = F.regexp_extract(fragment, r"""<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']""", 1)
    return F.when(h != "", unescape(h, closed=True))


def absolute_url(href: Column, base: str) -> Column:
    """Absolute hrefs kept; root-relative ones joined to the scheme and host of ``base``."""
    root = F.regexp_extract(F.lit(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    return F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), href).when(href.startswith("/"), F.concat(root, href))


def url_allowed(url: Column, host: str, schemes: tuple[str, ...] = ("https",)) -> Column:
    """Scheme and host guard."""
    return F.lower(F.parse_url(url, F.lit("PROTOCOL"))).isin(*schemes) & (F.lower(F.parse_url(url, F.lit("HOST"))) == host)


def us_date(text: Column) -> Column:
    """``%m/%d/%Y`` after stripping (one or two digit month/day)."""
    return F.try_to_date(py_strip(text), "M/d/yyyy")


# ------------------------------------------------------------------------------------------ fixture


# Listing payloads and landed pages derived from ``pages``, ten pages per batch, so that every rule of D1-D7 has
# rows that trigger it (all of them over the whole table):
# - a row's dates vary with the page id; id % 29 = 28 has an impossible one
# - id % 13 = 5 is linked root-relative and landed under that address
# - id % 10 = 3 in every third batch is listed twice in its batch, the second time with another office
# - id % 25 = 24 is listed again in the next batch
# - every fourth batch has two extra rows: one of four cells, one without a link
# - known letters: every fourth page, and every ninth batch as a whole
# - near the end of the listing, so that a run covers nearly all of it: two successive batches are known, then in one all rows
#   have four cells, then one has not landed
# - id % 6 = 1: the page's article holds further articles, and references by name and by number; id % 8 = 2: its heading does
FIXTURE_HOST = "www.fda.gov"


def _batch() -> Column:
    return F.floor(F.col("page_id") / 10).cast("long")


def landed_url() -> Column:
    own = F.concat(F.lit(f"https://{FIXTURE_HOST}/letters/"), F.col("page_id").cast("string"))
    return F.when(F.col("page_id") % 13 == 5, own).otherwise(F.col("url"))


# What the fixture adds to pages.
NESTED = ("<section title='a>b'>It&#8217;s R&amp;D &mdash; &frac12; &#x1F600;&#150; &bogus; a&lt;b 1 < 2</section>"
          '<article class="x">inner<Article/>deep</ARTICLE >tail &eacute;t&eacute</article>')
HEADING = " &ndash; Q&amp;A&hellip;</h1>"


def landed_pages(pages: DataFrame) -> DataFrame:
    html = F.when(F.col("page_id") % 6 == 1, F.replace("html", F.lit("</article>"), F.lit(NESTED))).otherwise(F.col("html"))
    html = F.when(F.col("page_id") % 8 == 2, F.replace(html, F.lit("</h1>"), F.lit(HEADING))).otherwise(html)
    return pages.select("page_id", landed_url().alias("url"), html.alias("html"))


def _from_end(pages: DataFrame, batch: Column) -> Column:
    """How many batches come after this one, by the largest page id (a scalar subquery)."""
    return pages.agg(F.floor(F.max("page_id") / 10).cast("long")).scalar() - batch


def listing_fixture(pages: DataFrame) -> DataFrame:
    """One JSON payload per landed batch; see the list above."""
    pid, batch = F.col("page_id"), _batch()
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)
    link = F.when(pid % 13 == 5, F.concat(F.lit("/letters/"), pid.cast("string"))).otherwise(F.col("url"))
    day = F.concat_ws("/", (pid % 12 + 1).cast("string"), (pid % 28 + 1).cast("string"), F.lit("2024"))
    cell = {
        "posted": F.when(pid % 29 == 28, "13/45/2024").otherwise(day),
        "issued": F.lit(" 01/01/2024 "),
        "company": F.concat(F.lit('<a href="'), link, F.lit('">'), host, F.lit("</a>")),
        "office": F.concat(F.lit("Office "), (pid % 3).cast("string")),
        "subject": F.concat(F.lit("<b>"), host, F.lit("</b> subject")),
    }

    def row(batch: Column, place: int, **other: Column) -> tuple[Column, ...]:
        cells = cell | other
        return batch.alias("batch"), (pid * 10 + place).alias("pos"), F.array(*[c for c in cells.values() if c is not None]).alias("cells")

    four = F.array(*[cell[c] for c in ("posted", "issued", "company", "office")])
    base = pages.select(*row(batch, 0)[:2], F.when(_from_end(pages, batch) == 4, four).otherwise(F.array(*cell.values())).alias("cells"))
    parts = [
        base,
        pages.where((pid % 10 == 3) & (batch % 3 == 1)).select(*row(batch, 1, office=F.lit("Office again"))),
        pages.where(pid % 25 == 24).select(*row(batch + 1, 2)),
        pages.where((pid % 10 == 0) & (batch % 4 == 2)).select(*row(batch, 3, subject=None)),
        pages.where((pid % 10 == 1) & (batch % 4 == 2)).select(*row(batch, 4, company=host)),
    ]
    rows = reduce(DataFrame.unionByName, parts).where(_from_end(pages, F.col("batch")) != 3)
    # a batch is a page of the listing: a dozen rows
    cells_in_order = F.transform(F.sort_array(F.collect_list(F.struct("pos", "cells"))), lambda s: s["cells"])
    return rows.groupBy("batch").agg(F.to_json(F.struct(cells_in_order.alias("data"))).alias("payload"))


def stored_fixture(pages: DataFrame) -> DataFrame:
    """Letters already in the store before the run."""
    known = (F.col("page_id") % 4 == 0) | (_batch() % 9 == 5) | _from_end(pages, _batch()).isin(6, 7)
    return pages.where(known).select("page_id", landed_url().alias("url"))


# --------------------------------------------------------------------------------------------- D1-D8


def listing_rows(payloads: DataFrame, base_url: str) -> DataFrame:
    """Payload -> one row per listing row with >= 5 cells and a link (others dropped)."""
    parsed = payloads.select("batch", F.from_json("payload", "data array<array<string>>").alias("p"))
    rows = parsed.select("batch", F.posexplode("p.data").alias("row_index", "cells"))
    rows = rows.where(F.size("cells") >= 5).select("batch", "row_index", first_href(F.col("cells")[2]).alias("href"), F.slice("cells", 1, 5).alias("cells"))
    rows = rows.where(F.col("href").isNotNull())
    rows = rows.select("batch", "row_index", "href", F.transform("cells", lambda c: fragment_text(c)).alias("texts"))
    text = F.col("texts")
    return rows.select(
        "batch",
        "row_index",
        us_date(text[0]).alias("posted_date"),
        us_date(text[1]).alias("issue_date"),
        text[2].alias("company_name"),
        absolute_url(F.col("href"), base_url).alias("url"),
        text[3].alias("issuing_office"),
        text[4].alias("subject"),
    )


def parse_detail(pages: DataFrame, root: str = "main", keep: tuple[str, ...] = ()) -> DataFrame:
    """title = text of the first ``h1`` in the first root element; content = its text nodes joined by newlines."""
    cleaned = pages.select(*keep, "url", without_non_text(F.col("html")).alias("cleaned"))
    inside = cleaned.select(*keep, "url", element(F.col("cleaned"), root).alias("body"))
    parts = inside.select(*keep, "url", "body", element(F.col("body"), "h1").alias("heading"))
    return parts.select(*keep, "url", F.array_join(text_nodes(F.col("heading")), " ").alias("title"), F.array_join(text_nodes(F.col("body")), "\n").alias("content"))


def letter_hash(posted: Column, company: Column, url: Column, content: Column) -> Column:
    """SHA-256 of ``posted\\ncompany\\nurl\\ncontent`` (NULL prints as ``None``)."""
    none = F.lit("None")
    return F.sha2(F.concat_ws("\n", F.coalesce(posted.cast("string"), none), F.coalesce(company, none),
                              F.coalesce(url, none), F.coalesce(content, none)), 256)


def dedup_seen(rows: DataFrame) -> DataFrame:
    """D3: keep rows whose URL was not listed in an earlier batch (repeats inside a batch pass)."""
    first = rows.groupBy("url").agg(F.min("batch").alias("first_batch"))
    return rows.join(first, "url").where(F.col("batch") == F.col("first_batch")).drop("first_batch")


def allowed_rows(rows: DataFrame, host: str, schemes: tuple[str, ...] = ("https",)) -> DataFrame:
    """B12 in the letter path: rows whose address has an allowed scheme and the given host."""
    return rows.where(F.coalesce(url_allowed(F.col("url"), host, schemes), F.lit(False)))


def existing(rows: DataFrame, store: DataFrame) -> DataFrame:
    """D4."""
    return rows.join(store.select("url").distinct(), "url", "left_semi")


def missing(rows: DataFrame, store: DataFrame) -> DataFrame:
    """D5."""
    return rows.join(store.select("url").distinct(), "url", "left_anti")


def has_detail(df: DataFrame) -> Column:
    """D8."""
    return F.col("title").isNotNull() & F.col("content").isNotNull()


def batch_table(payloads: DataFrame, rows: DataFrame, missing_rows: DataFrame) -> DataFrame:
    """Per landed batch: usable rows returned, missing letters. A batch whose rows were all dropped returned none."""
    counts = rows.select("batch", F.lit(1).alias("r"), F.lit(0).alias("m")).unionByName(
        missing_rows.select("batch", F.lit(0).alias("r"), F.lit(1).alias("m"))
    ).unionByName(payloads.select("batch", F.lit(0).alias("r"), F.lit(0).alias("m")))
    return counts.groupBy("batch").agg(F.sum("r").alias("returned"), F.sum("m").alias("missing"))


def stop_rule(batches: DataFrame, known_before_stop: int | None, page_size: int = PAGE_SIZE) -> DataFrame:
    """Batches processed before the run stops: at a short batch (< page size), after
    ``known_before_stop`` consecutive fully known batches (no missing letters), or at an empty batch
    (a gap in the batch numbers, or the end of the listing).

    Gaps and islands without a global window: running counts (distributed, see ``running_sums``) of
    batches and of not-known batches; each run of known batches gets its first batch from one aggregate
    per run; the stop batch is a scalar ``min``. ``stopped_here`` marks the batch that ended the run."""
    first = batches.agg(F.min("batch")).scalar()
    b = batches.withColumns({"unknown": (F.col("missing") > 0).cast("long"), "one": F.lit(1).cast("long")})
    b = running_sums(b, "batch", ["unknown", "one"], inclusive=True, prefix="run_")
    b = b.where(F.col("batch") - first + 1 == F.col("run_one"))  # rows before the first gap (empty batch)
    known = F.col("missing") == 0
    starts = b.where(known).groupBy("run_unknown").agg(F.min("batch").alias("run_start"))
    b = b.join(starts, "run_unknown", "left")
    b = b.withColumn("consecutive_known", F.when(known, F.col("batch") - F.col("run_start") + 1).otherwise(F.lit(0)))
    stop_cond = F.col("returned") < page_size
    if known_before_stop is not None:
        stop_cond = stop_cond | (F.col("consecutive_known") >= known_before_stop)
    b = b.withColumn("stops", stop_cond)
    stop = b.where("stops").agg(F.min("batch")).scalar()
    return b.where(stop.isNull() | (F.col("batch") <= stop)).select(
        "batch", "returned", "missing", "consecutive_known", F.coalesce(F.col("batch") == stop, F.lit(False)).alias("stopped_here")
    )


def run_summary(processed: DataFrame, details: DataFrame) -> DataFrame:
    """Batches requested, letters discovered, stored and failed over the processed batches. One
    extra (empty) request is counted when no stop condition ended the run."""
    stored = details.agg(F.count_if(has_detail(details))).scalar()
    failed = details.agg(F.count_if(~has_detail(details))).scalar()
    return processed.agg(
        (F.count(F.lit(1)) + F.when(F.max(F.col("stopped_here").cast("int")) == 1, 0).otherwise(1)).alias("batches"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("discovered"),
    ).select("batches", "discovered", stored.alias("stored"), failed.alias("failed"))
