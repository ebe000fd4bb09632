"""Content-addressed WARC archive (operator 1).

``write_archive`` turns records (key, url, payload) into two Parquet tables under one folder:

* ``headers``: one row per record with its exact WARC header block, its type and its payload's
  digest. A payload that is there already is a *revisit* of the record with the smallest key.
* ``payloads``: each distinct payload once, under its SHA-256.

``read_archive`` joins the two again and gives every record's header and full payload back.

The digest is verified twice. On writing, all records under one digest must agree in length and
in an independent 64-bit hash; on reading, every stored payload is hashed again. Either failing
ends the job with an error, so two different payloads never become one.

Defined cases: a null payload is the empty payload; a null url has no WARC-Target-URI line; line
breaks in a url are percent-encoded in the header, and the exact url is kept beside it; a null key counts as larger than any other.
Repeated rows are records of their own: all but one revisit. An empty table makes an empty
archive. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _lower_hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _record_urn(key: Column, no: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("null")),
                    F.lit(":"), no.cast("string"), F.lit(">"))


def _header_line(name: str, value: Column) -> Column:
    """The line, or nothing where the value is null."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise("")


def write_archive(records: DataFrame, path: str, key: str = "page_id", url: str = "url",
                  payload: str = "html", min_revisit_bytes: int = 100,
                  date: str = "1970-01-01T00:00:00Z", content_type: str = "text/html") -> None:
    """Write the archive of ``records`` to ``path`` (a folder that all executors share)."""
    spark = records.sparkSession
    rows = records.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))

    # one row per record, without the payload: fixes each record's number
    rows.select("key", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes"),
                F.xxhash64("payload").alias("second"), F.monotonically_increasing_id().alias("no")) \
        .write.parquet(f"{path}/index")
    # each distinct payload once; equal ones meet on the map side first
    rows.select("digest", "payload").dropDuplicates(["digest"]).write.parquet(f"{path}/payloads")

    index = spark.read.parquet(f"{path}/index")
    first = index.groupBy("digest").agg(
        F.min(F.struct(F.col("key").isNull().alias("n"), "key", "no")).alias("first"),
        F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n_bytes"),
        F.min("n_bytes").alias("least"), F.min("second").alias("s0"), F.max("second").alias("s1"))
    clash = (F.col("least") != F.col("n_bytes")) | (F.col("s0") != F.col("s1"))
    first = first.select("digest", "first", F.when(clash, F.raise_error(F.lit(
        "two payloads share a SHA-256 digest"))).otherwise(F.col("copies")).cast("long").alias("copies"),
        "n_bytes").where((F.col("copies") > 1) & (F.col("n_bytes") >= min_revisit_bytes))
    typed = index.join(first.select("digest", "first"), "digest", "left").withColumnRenamed("url", "exact_url")
    revisit = F.col("first").isNotNull() & (F.col("first.no") != F.col("no"))
    typed = typed.select(
        "key", "no", "digest", "n_bytes", F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("first.key")).alias("refers_to"),
        F.when(revisit, _record_urn(F.col("first.key"), F.col("first.no"))).alias("refers_urn"),
        "exact_url", F.replace(F.replace(F.col("exact_url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("target"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _header_line("WARC-Type", F.col("type")),
        _header_line("WARC-Record-ID", _record_urn(F.col("key"), F.col("no"))),
        _header_line("WARC-Target-URI", F.col("target")), _header_line("WARC-Date", F.lit(date)),
        _header_line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), _lower_hex(F.col("digest")))),
        _header_line("WARC-Refers-To", F.col("refers_urn")),
        _header_line("WARC-Profile", F.when(F.col("type") == "revisit", REVISIT_PROFILE)),
        _header_line("Content-Type", F.lit(content_type)),
        _header_line("Content-Length", F.when(F.col("type") == "revisit", "0")
                     .otherwise(F.col("n_bytes").cast("string"))), F.lit(CRLF))
    typed.select("key", "no", "digest", "exact_url", header.alias("header")).write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    value = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: key, type, refers_to (key of the response), header, payload (full
    bytes), payload_bytes and payload_digest (of the stored bytes, hashed again), target (the exact url).

    Fields come from the header block; the payload from the payload table through its digest.
    """
    stored = spark.read.parquet(f"{path}/payloads").select(
        "digest", "payload", F.sha2("payload", 256).alias("again"),
        F.octet_length("payload").cast("long").alias("payload_bytes"))
    stored = stored.withColumn("again", F.when(F.col("again") == _lower_hex(F.col("digest")), F.col("again"))
                               .otherwise(F.raise_error(F.lit("a stored payload does not match its digest"))))
    headers = spark.read.parquet(f"{path}/headers").select(
        "digest", "key", "no", "header", _field("WARC-Type").alias("type"),
        F.col("exact_url").alias("target"), _field("WARC-Refers-To").alias("urn"))
    # a digest without its payload is a damaged archive: the left join shows it, the check ends the job
    out = headers.join(stored, "digest", "left")
    lost = F.raise_error(F.lit("a record's payload is missing from the archive"))
    return out.select(
        "key", "no", "type", F.regexp_extract("urn", r"<urn:record:(-?\d+):", 1).try_cast("long").alias("refers_to"),
        "target", "header", "payload", "payload_bytes",
        F.when(F.col("again").isNull(), lost).otherwise(F.col("again")).cast("string").alias("payload_digest"))


def original_record(archive: DataFrame) -> DataFrame:
    """``archive`` with ``record``: the record's bytes as they were before equal payloads were stored once: header
    block, full payload and the two closing line breaks. A revisit becomes the response that it was: its type,
    its length, and no reference."""
    own = F.col("header")
    for pattern, by in (("WARC-Type: revisit", "WARC-Type: response"), (r"WARC-Refers-To: [^\r]*\r\n", ""), (r"WARC-Profile: [^\r]*\r\n", "")):
        own = F.regexp_replace(own, F.lit(rf"(?<=\r\n){pattern}"), F.lit(by))
    own = F.regexp_replace(own, F.lit(r"(?<=\r\nContent-Length: )0(?=\r\n)"), F.col("payload_bytes").cast("string"))
    header = F.when(F.col("type") == "revisit", own).otherwise(F.col("header"))
    return archive.withColumn("record", F.concat(F.encode(header, "UTF-8"), F.col("payload"), F.encode(F.lit(CRLF * 2), "UTF-8")))


def payload_of(record: Column) -> Column:
    """The payload read from a rebuilt record: as many bytes behind its header block as the block says."""
    head = F.substring_index(F.decode(record, "UTF-8"), CRLF * 2, 1)
    length = F.regexp_extract(head, r"\r\nContent-Length: (\d+)$", 1).cast("int")
    return F.substring(record, F.octet_length(head) + 5, length)
