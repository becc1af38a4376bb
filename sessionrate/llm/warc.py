"""Operator 7: content-addressed archive of web records.

:func:`write_archive` writes two tables: ``payloads`` holds every payload's bytes once
under its SHA-256, ``headers`` holds the exact header bytes of every record and the
digest it points to.  :func:`read_records` rebuilds each WARC record (header, blank line,
body, two line ends) by a join on the digest, after checking every stored payload once
against its digest.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the largest
page_id is the response and the others are revisits of it; smaller payloads are responses.

Defined cases: NULL html is the empty payload; NULL url is the empty URI, line ends in a
url are percent-encoded; repeated rows (equal page_id and payload) get equal records, all
responses where that page_id is the largest; a NULL page_id sorts below all others and
its record id is empty; extra columns are ignored; no pages give empty tables.

Scale: only digests and ids are grouped (map-side maximum per digest, so thousands of
copies of one payload cost one row per task); the payload bytes are shuffled once, after a
semi join on (digest, page_id) has left one row per distinct payload; a hot digest in the
header join is split by AQE's skew join, as the join stands alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1000
CRLF = "\r\n"
NO_PAGE = -(1 << 63)      # stands for a NULL page_id in keys
ARCHIVE_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_rows(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"),
                        F.coalesce(F.col(url), F.lit("")).alias("url"),
                        payload.alias("payload"))
    return rows.withColumns({"digest": F.sha2("payload", 256),
                             "n_bytes": F.octet_length("payload").cast("long")})


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">"))


def _uri(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def header_bytes() -> Column:
    """Exact header block of a record, from columns of :func:`typed_headers`."""
    revisit = F.col("record_type") == "revisit"
    refers_to = F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.lit(f"WARC-Date: {ARCHIVE_DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("WARC-Refers-To: "), refers_to),          # NULL line: skipped
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "),
                 F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF)).cast("binary")


def typed_headers(rows: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Record type and target of every row; digests and ids only, no payload is moved."""
    light = rows.select("page_id", "url", "digest", "n_bytes", F.sha1("payload").alias("sha1"))
    newest = (light.filter(F.col("n_bytes") >= min_revisit).groupBy("digest")
                   .agg(F.max("page_id").alias("newest")))
    out = light.join(newest, "digest", "left")
    older = ~F.col("page_id").eqNullSafe(F.col("newest")) & F.col("newest").isNotNull()
    return out.select("page_id", "url", "digest", "n_bytes", "sha1",
                      F.when(older, "revisit").otherwise("response").alias("record_type"),
                      F.when(older, F.col("newest")).alias("refers_to"))


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, **names) -> None:
    """Write ``path/payloads`` and ``path/headers``."""
    rows = payload_rows(pages, **names)
    # plain equality on both keys: the join's partitioning then serves the grouping too
    held = rows.select("digest", F.coalesce("page_id", F.lit(NO_PAGE)).alias("page"), "payload")
    keep = held.groupBy("digest").agg(F.max("page").alias("page"))
    once = (held.join(keep, ["digest", "page"], "left_semi")
                .dropDuplicates(["digest", "page"]).select("digest", "payload"))
    once.write.parquet(f"{path}/payloads")
    (typed_headers(rows, min_revisit)
     .select("digest", header_bytes().alias("header")).write.parquet(f"{path}/headers"))


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("_head"), rf"\r\n{name}: ([^\r\n]*)", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rebuild the records.  Columns: page_id, record_type, refers_to, payload_bytes,
    payload_digest (of the rebuilt record's body; of a revisit, of the payload it refers to),
    record (exact bytes).

    Each payload is checked once against its SHA-256, each record against its header's
    SHA-1 and Content-Length; a mismatch fails the job.
    """
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), "digest")))
    store = (spark.read.parquet(f"{path}/payloads")
             .select("digest", checked.alias("payload")))
    heads = spark.read.parquet(f"{path}/headers").withColumn("_head", F.col("header").cast("string"))
    heads = heads.withColumns({
        "record_type": _field("WARC-Type"),
        "page_id": F.regexp_extract(_field("WARC-Record-ID"), r"<urn:x-page:(-?\d+)>", 1),
        "refers_to": F.regexp_extract(_field("WARC-Refers-To"), r"<urn:x-page:(-?\d+)>", 1),
        "_sha1": F.regexp_extract(_field("WARC-Payload-Digest"), r"sha1:(\w+)", 1),
        "_length": _field("Content-Length").cast("long")})
    response = F.col("record_type") == "response"
    tail = F.lit((CRLF + CRLF).encode())
    # every figure below is taken from the record's own bytes, so no reader skips rebuilding it
    out = heads.join(store, "digest", "left").withColumn("record", F.concat(
        "header", F.when(response, F.col("payload")).otherwise(F.lit(b"")), tail))
    start, ends = F.octet_length("header"), len(CRLF + CRLF)
    out = out.withColumn("_body", F.substring("record", start + 1, F.octet_length("record") - start - ends))
    # a revisit has no body: its payload is the one referred to by its digest
    out = out.withColumn("_payload", F.when(response, F.col("_body")).otherwise(F.col("payload")))
    out = out.withColumns({"payload_bytes": F.octet_length("_payload").cast("long"),
                           "payload_digest": F.sha1("_payload")})
    good = (F.col("_sha1").eqNullSafe(F.col("payload_digest"))
            & F.octet_length("_body").cast("long").eqNullSafe(F.col("_length")))
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return out.select(
        number("page_id").alias("page_id"), "payload_bytes",
        F.when(good, F.col("payload_digest")).otherwise(
            F.raise_error(F.lit("a record does not match its header"))).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
        "record")
