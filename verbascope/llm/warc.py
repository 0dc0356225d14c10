"""WARC archives of pages: records of every page, revisits of equal payloads, and their resolution on reading."""

from __future__ import annotations

from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.llm.common import stable_table
from verbascope.operators.joins import small_side
from verbascope.session import ensure_checkpoint_dir

# Payloads below this many bytes are not worth a revisit record.
MIN_BYTES = 100
FILE_RECORDS = 200_000

# The WARC 1.1 profile of a revisit that has the payload of an earlier record, and line ends.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
GAP = EOL + EOL


def _start(run: str) -> str:
    """What every record of one run begins with. The run's id is random, so no payload can hold these lines."""
    return f"WARC/1.1{EOL}WARC-Warcinfo-ID: <urn:uuid:{run}>{EOL}"


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line ends in it are escaped."""
    text = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(EOL)), F.lit(""))


def _write(records: DataFrame, folder: str) -> None:
    """One WARC record a row of ``records`` (type, record_id, uri, date, page_id, digest, payload, original), gzipped.

    ``original`` is null, or names the record (record_id, uri, date) that a revisit refers to; its payload stays out.
    """
    run = folder.rstrip("/").rpartition("-")[2]
    is_revisit = F.col("original").isNotNull()
    body = F.when(is_revisit, "").otherwise(F.col("payload"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(GAP),
    )
    record = F.concat(
        F.lit(_start(run)),
        _field("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("Page-ID", F.col("page_id")),
        _field("WARC-Profile", F.when(is_revisit, PROFILE)),
        _field("WARC-Refers-To", F.col("original.record_id")),
        _field("WARC-Refers-To-Target-URI", F.col("original.uri")),
        _field("WARC-Refers-To-Date", F.col("original.date")),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length("http") + F.octet_length("body")),
        F.lit(EOL), F.col("http"), F.col("body"),
    )
    lines = records.select("*", http.alias("http"), body.alias("body")).select(record.alias("value"))
    lines.write.option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def write_archives(pages: DataFrame, folder: str) -> None:
    """A response record for each row of ``pages`` (page_id, url, html) in gzipped files under ``folder``.

    ``folder`` ends in ``-`` and the id of the run. The payload is the html in UTF-8, a null one is empty. Null ids and
    addresses leave their header out. Every row gets a record id of its own, also a repeated one. Other columns are
    ignored.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    _write(pages.select(
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("record_id"), F.col("url").cast("string").alias("uri"),
        F.lit(datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")).alias("date"), F.col("page_id").cast("long"),
        F.sha2(payload.cast("binary"), 256).alias("digest"), payload.alias("payload"),
        F.lit(None).cast("struct<record_id: string, uri: string, date: string>").alias("original"),
    ), folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """type, record_id, uri, date, page_id, digest, refers_to and payload (binary) of each record that ``folder`` holds.

    Records are cut at their first two lines, which only this run has, and blocks by their Content-Length, so payloads
    may hold anything, also whole records of other archives.
    """
    run = folder.rstrip("/").rpartition("-")[2]
    lines = spark.read.option("lineSep", _start(run)).text(folder).where("value != ''")
    head = F.substring_index("value", GAP, 1)
    cut = lines.select(F.str_to_map(head, F.lit(EOL), F.lit(": ")).alias("head"), F.octet_length(head).alias("n_head"), F.col("value").cast("binary").alias("raw"))
    block = F.substring("raw", F.col("n_head") + len(GAP) + 1, F.col("head")["Content-Length"].cast("int"))
    cut = cut.select("head", block.alias("block"))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), GAP, 1)) + len(GAP)
    name = lambda key: F.col("head")[key]
    return cut.select(
        name("WARC-Type").alias("type"), name("WARC-Record-ID").alias("record_id"), name("WARC-Target-URI").alias("uri"), name("WARC-Date").alias("date"),
        name("Page-ID").cast("long").alias("page_id"), F.substring_index(name("WARC-Payload-Digest"), ":", -1).alias("digest"),
        name("WARC-Refers-To").alias("refers_to"), F.substring("block", http + 1, F.octet_length("block")).alias("payload"),
    )


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> None:
    """Rewrite the archives of ``source`` into ``target`` with fresh headers, equal payloads only once.

    Headers are shuffled by payload digest, reduced before the shuffle, so a hot payload is a row a task. Of records with
    equal payloads of ``min_bytes`` at least, that with the least page id (null last, then the least record id) stays a
    response; the others become revisits that name it. Digests that occur once do not come back to the records; the
    others do by a join that is broadcast if their table is measured as small, and on the digest otherwise.
    """
    records = read_records(spark, source)
    size = F.octet_length("payload")
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id", "uri", "date")).alias("first")
    groups = records.where(size >= min_bytes).groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated, _ = small_side(groups.select("digest", F.struct("first.record_id", "first.uri", "first.date").alias("original")))
    joined = records.join(repeated, "digest", "left")
    is_revisit = F.col("original.record_id") != F.col("record_id")
    _write(joined.select(
        "record_id", "uri", "date", "page_id", "digest", F.col("payload").cast("string").alias("payload"), F.when(is_revisit, F.col("original")).alias("original")
    ), target)


def read_resolved(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, revisits by their originals.

    Length and digest come from the payload that is read, a revisit's from the response it refers to; ``refers_to`` is
    that response's page id. A payload that does not have the digest its header names is an error; a revisit of a
    record that is not there has nulls. Only these short columns are shuffled.
    """
    found = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest in record "), "record_id"))
    digest = F.when(F.col("type") == "revisit", F.col("digest")).when(found == F.col("digest"), found).otherwise(wrong)
    records = stable_table(read_records(spark, folder).select(
        "type", "record_id", "page_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest")
    ))
    responses = records.where("type = 'response'")
    originals = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_id"), "payload_bytes", "payload_digest")
    revisits = records.where("type = 'revisit'").select("page_id", "refers_to").join(originals, "refers_to", "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    ).unionByName(revisits.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), F.col("original_id").alias("refers_to")
    ))


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write ``pages`` as archives, deduplicate them, and read the result back, all in the shared folder.

    See ``write_archives`` for nulls, repeated rows and other columns, ``deduplicate`` for ties, ``read_resolved`` for
    the columns. An empty table gives archives without records and no rows.
    """
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    crawled, kept = (f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}" for name in ("crawl", "archive"))
    write_archives(pages, crawled)
    deduplicate(spark, crawled, kept, min_bytes)
    return read_resolved(spark, kept)
