"""WARC writing and reading with boundary-chain verification.

Writing: one record per page, text files whose line separator is the record terminator, so Spark's own writer lays
out byte-exact archives. Pages with equal payloads share one ``response`` record (smallest page_id); the others are
``revisit`` records that carry no payload but name the response's page and digest.

Reading: archives are read through Spark's splittable text source with the record magic as separator, so a large
file is many tasks and no file has to fit into memory. Every piece between two magics is a candidate record; its
header gives the offset at which its successor must start. Pieces whose successor is the very next piece form runs;
pointer jumping over the (few) runs from each file's start keeps what is reachable. Magic inside payloads, even
a whole fake record, is never reachable and is joined back into its owner's payload.

Defined cases: null html = empty payload; null url = ``urn:page``; null page_id = a record without that header;
pages that repeat a page_id and html are separate records; a file that does not start with a record gives none; a
chain that breaks (truncated file) keeps the whole records before the break; empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import stored, tidy, with_python

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_BYTES = 0  # payloads shorter than this are never replaced by a revisit


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four 40-bit groups of eight base-32 digits each."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records_of(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to for each page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("payload")).withColumns(
        {"payload_digest": base32_sha1(F.col("payload").cast("binary")), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    # only digests that occur twice matter; ids and digests alone are grouped, pre-aggregated before the shuffle
    shared = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_id")
    )
    shared = stored(shared, "shared-payloads")
    # the stored size decides: broadcast under the session's threshold, else a shuffle whose hot digests AQE splits
    joined = rows.join(shared, "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & (F.col("page_id") != F.col("first_id")) & (F.col("payload_bytes") >= min_bytes)
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing when the value is null. Control characters and blanks are percent-encoded as %20."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7f]", "%20"), F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write one WARC record per page under ``path``, one archive file per partition."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"), _line("Content-Length", F.col("payload_bytes")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    uid = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), F.col("payload_digest")))
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.regexp_replace(uid, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">\r\n")),
        F.lit("WARC-Date: 2000-01-01T00:00:00Z\r\n"),
        _line("WARC-Target-URI", F.coalesce(F.col("url"), F.lit("urn:page"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        _line("X-Page-Id", F.col("page_id")),
        _line("X-Refers-To-Page", F.col("refers_to")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length("block")),
        F.lit("\r\n"),
    )
    rows = records_of(pages, min_bytes).withColumn("block", block)
    rows.select(F.concat(head, "block").alias("value")).write.option("lineSep", END).text(path)


PIECE = """file string, split long, rel long, bytes long, candidate boolean, head_bytes long, block_bytes long, whole boolean,
 type string, uri string, digest string, page_id long, refers_to long, content_type string,
 payload_bytes long, payload_digest string, payload binary, body binary"""
_FIELDS = {b"warc-type": "type", b"warc-target-uri": "uri", b"warc-payload-digest": "digest", b"x-page-id": "page_id",
           b"x-refers-to-page": "refers_to", b"content-type": "content_type", b"content-length": "block_bytes"}


def parse_head(piece: bytes) -> tuple[dict, int] | None:
    """Header fields and header length of a piece that follows a magic; None when it is no whole record header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    found: dict = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        if (field := _FIELDS.get(name.strip().lower())) and field not in found:
            found[field] = value.strip().decode("utf-8", "replace")
    try:
        for field in ("block_bytes", "page_id", "refers_to"):
            if field in found:
                found[field] = int(found[field])
    except ValueError:
        return None
    if found.get("block_bytes", -1) < 0 or "type" not in found:
        return None
    return found, end + 4


def payload_of(block: bytes, content_type: str | None) -> bytes:
    """The payload of a record block: for application/http what follows the HTTP header, else the block."""
    if not (content_type or "").startswith("application/http"):
        return block
    end = block.find(b"\r\n\r\n")
    return block[end + 4 :] if end >= 0 else b""


def _pieces(batches: Iterator[pa.RecordBatch], payloads: bool, bodies: bool = False) -> Iterator[pa.RecordBatch]:
    """One row per piece. Whole records give size and digest (and payload if asked); other pieces keep their body."""
    names = [c.split()[0] for c in PIECE.replace("\n", " ").split(",")]
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]])
                        for n, c in zip(names, PIECE.replace("\n", " ").split(","))])
    at, pos = None, 0
    for batch in batches:
        rows = []
        for file, split, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if at != (file, split):
                at, pos = (file, split), 0
            head = parse_head(body)
            row = dict.fromkeys(names)
            row |= {"file": file, "split": split, "rel": pos, "bytes": len(body), "candidate": head is not None, "whole": False}
            if head:
                row |= head[0] | {"head_bytes": head[1]}
                row["whole"] = len(body) == head[1] + row["block_bytes"] + 4
            if row["whole"] and not bodies:
                payload = payload_of(body[head[1] : -4], row["content_type"])
                row |= {"payload_bytes": len(payload), "payload_digest": python_digest(payload)}
                if payloads:
                    row["payload"] = payload
            else:
                row["body"] = body
            rows.append(row)
            pos += len(body) + len(MAGIC)
        yield pa.RecordBatch.from_pylist(rows, schema)


def reachable_runs(light: DataFrame) -> DataFrame:
    """(file, run, entry) of the runs that a chain from offset 0 of the file enters, by pointer jumping.

    ``light`` has file, run, offset, exit (successor offset of the run's last piece; null when it has none).
    """
    start = light.where("offset = 0").select("file", "run", F.col("offset").alias("entry"))
    exits = light.where("last").select("file", "run", "exit")
    landing = light.select("file", F.col("run").alias("next_run"), F.col("offset").alias("exit"))
    jump = stored(exits.join(landing, ["file", "exit"]).select("file", "run", "next_run", F.col("exit").alias("next_entry")), "jumps")
    reached = stored(start, "reached")
    n = reached.count()
    if not n:
        return reached
    while not jump.isEmpty():
        more = reached.join(jump, ["file", "run"]).select("file", F.col("next_run").alias("run"), F.col("next_entry").alias("entry"))
        reached = stored(reached.unionByName(more).groupBy("file", "run").agg(F.min("entry").alias("entry")), "reached")
        m = reached.count()
        if m == n:
            break
        n = m
        then = jump.select("file", F.col("run").alias("next_run"), F.col("next_run").alias("run2"), F.col("next_entry").alias("entry2"))
        jump = stored(jump.join(then, ["file", "next_run"]).select("file", "run", F.col("run2").alias("next_run"), F.col("entry2").alias("next_entry")), "jumps")
    return reached


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """file, offset, type, uri, digest, page_id, refers_to, payload_bytes, payload_digest (computed from the payload)
    and payload (null unless asked for) of every record reachable from its file's start."""
    with_python(spark)
    lines = spark.read.option("lineSep", MAGIC).text(path)
    raw = lines.select("_metadata.file_path", F.col("_metadata.file_block_start"), F.col("value").cast("binary"))
    pieces = stored(raw.mapInArrow(tidy(lambda it: _pieces(it, payloads)), PIECE), "warc-pieces")

    # absolute offsets: what lies in earlier splits of the file plus the place in the split, minus the magic in front
    per_split = pieces.groupBy("file", "split").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("total"))
    before = F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = per_split.select("file", "split", before.alias("base"))
    offset = (F.col("base") + F.col("rel") - len(MAGIC)).alias("offset")
    light = pieces.select("file", "split", "rel", "candidate", "whole", "head_bytes", "block_bytes").join(bases, ["file", "split"])
    light = light.select("file", "split", "rel", offset, "whole",
                         F.when(F.col("candidate"), F.col("base") + F.col("rel") + F.col("head_bytes") + F.col("block_bytes") + 4).alias("succ"))
    # the piece before a file's first magic is empty in a valid archive and lies at -len(MAGIC)
    in_file = Window.partitionBy("file").orderBy("offset")
    light = light.where("offset >= 0").withColumn("next", F.lead("offset").over(in_file))
    linked = F.coalesce(F.col("succ") == F.col("next"), F.lit(False))
    light = light.withColumn("cut", F.lag(F.when(linked, 0).otherwise(1), 1, 0).over(in_file))
    light = light.withColumns({"run": F.sum("cut").over(in_file), "last": ~linked})
    light = stored(light.select("file", "split", "rel", "offset", "whole", "run", "last", F.when(~linked, F.col("succ")).alias("exit")), "warc-chain")

    reached = reachable_runs(light)
    marked = light.join(reached, ["file", "run"], "left").withColumn("is_start", F.coalesce(F.col("offset") >= F.col("entry"), F.lit(False)))
    owner = F.last(F.when(F.col("is_start"), F.col("offset")), ignorenulls=True).over(in_file)
    marked = marked.withColumn("owner", owner).where(F.col("owner").isNotNull())
    marked = marked.select("file", "split", "rel", "offset", "owner", "is_start", "whole", (F.col("is_start") & F.col("whole")).alias("simple"))
    marked = stored(marked, "warc-marked")

    out = ["file", "offset", "type", "uri", F.regexp_replace("digest", "^sha1:", "").alias("digest"), "page_id", "refers_to", "payload_bytes", "payload_digest", "payload"]
    simple = pieces.where("whole").join(marked.where("simple").select("file", "split", "rel", "offset"), ["file", "split", "rel"]).select(*out)

    # records with magic in their payload: the pieces they own are joined back; pieces that look like whole records
    # kept no body, so those, if there are any, are read again
    owned = marked.where(~F.col("simple"))
    fields = ["type", "uri", "digest", "page_id", "refers_to", "content_type", "head_bytes", "block_bytes"]
    inner = pieces.where("NOT whole").join(owned.select("file", "split", "rel", "offset", "owner", "is_start"), ["file", "split", "rel"]).select("file", "owner", "offset", "is_start", "body", *fields)
    posing = owned.where("whole")
    if not posing.isEmpty():
        again = raw.mapInArrow(tidy(lambda it: _pieces(it, False, bodies=True)), PIECE)
        inner = inner.unionByName(again.join(posing.select("file", "split", "rel", "offset", "owner", "is_start"), ["file", "split", "rel"]).select("file", "owner", "offset", "is_start", "body", *fields))
    parts = inner.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "body", "is_start", *fields))).alias("parts"))
    first = F.col("parts")[0]
    rest = F.transform(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), lambda p: p["body"])
    whole = F.aggregate(rest, first["body"], lambda acc, p: F.concat(acc, F.lit(MAGIC.encode()), p))
    broken = parts.where(first["is_start"]).select("file", F.col("owner").alias("offset"), *[first[c].alias(c) for c in fields], whole.alias("body"))
    broken = broken.where(F.octet_length("body") >= F.col("head_bytes") + F.col("block_bytes")).withColumn(
        "block", F.expr("substring(body, CAST(head_bytes + 1 AS INT), CAST(block_bytes AS INT))"))
    http = F.coalesce(F.col("content_type").startswith("application/http"), F.lit(False))
    gap = F.expr("position(X'0D0A0D0A' IN block)")
    payload = F.when(~http, F.col("block")).when(gap > 0, F.expr("substring(block, position(X'0D0A0D0A' IN block) + 4)")).otherwise(F.lit(b""))
    broken = broken.withColumn("payload", payload).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    if not payloads:
        broken = broken.withColumn("payload", F.lit(None).cast("binary"))
    return simple.unionByName(broken.select(*out))


def digest(records: DataFrame) -> DataFrame:
    """The op10 columns from records read back; a revisit takes its size from the response it refers to."""
    rows = records.where(F.col("type").isin("response", "revisit")).select(
        "page_id", "type", "digest", "refers_to", F.col("payload_bytes").alias("own_bytes"), F.col("payload_digest").alias("own_digest"))
    rows = stored(rows, "warc-rows")
    revisits, responses = rows.where("type = 'revisit'"), rows.where("type = 'response'")
    target = responses.select(F.col("page_id").alias("refers_to"), F.col("own_digest").alias("digest"), F.col("own_bytes").alias("payload_bytes"))
    target = target.dropDuplicates(["refers_to", "digest"])
    resolved = revisits.join(target, ["refers_to", "digest"], "left")
    return responses.select("page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"),
                            F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        resolved.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"))


def python_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_CHUNK = "('0x' || substr(h, {at}, 10))::BIGINT"
_DIGEST = " || ".join(
    f"substr('{BASE32}', CAST((({_CHUNK.format(at=1 + 10 * g)}) >> {35 - 5 * i}) & 31 AS BIGINT) + 1, 1)" for g in range(4) for i in range(8)
)
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
     q AS (SELECT page_id, strlen(body) AS payload_bytes, {_DIGEST} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q"""
