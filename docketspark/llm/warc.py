"""A content-addressed archive of WARC records: each payload once, headers as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.llm.common import stored, text_of
from docketspark.session import scratch_dir

# The alphabet of base32, and the profile of a record that repeats a payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: every five hex digits are four signs."""
    digits = F.sha1(data)
    plain = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    groups = [
        F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), plain, BASE32)


def _record_id(page_id: Column) -> Column:
    """The same name for a page whenever it is written."""
    digits = F.md5(F.concat(F.lit("record "), F.coalesce(page_id.cast("string"), F.lit("null"))))
    cut = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; breaks in a value would end it, so they are written as percent codes."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    min_payload_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Write a WARC record for each row of ``pages`` (page_id, url, html).

    ``payloads/`` holds the bytes of each different payload once, under its SHA-256 and its
    length; ``records/`` holds each record's exact headers and the digest of its payload.
    Of records with equal payloads of ``min_payload_bytes`` or more, the one with the least
    ``page_id`` is a response and the others revisit it; shorter ones are all responses.

    Payloads are pre-aggregated by digest before they are moved, so copies of one page
    gather nowhere; records are joined with digests, without payloads, and a hot digest is
    split by the adaptive skew join, as both sides are stored tables.

    Null html counts as empty, a null url as an empty one. Rows repeated with one
    ``page_id`` are of one type; null ids come after all others (all are responses if there
    are no others). An empty table gives an empty archive. Returns the folder.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    payload = text_of("html").cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), text_of("url").alias("url"), payload.alias("payload")
    )
    keyed = rows.withColumns({"sha256": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("bigint")})
    once = keyed.groupBy("sha256", "n_bytes").agg(
        F.min("page_id").alias("first_id"), F.first("payload").alias("payload")
    )
    once = once.withColumn("sha1", base32_sha1(F.col("payload")))
    once.write.parquet(f"{folder}/payloads")
    firsts = spark.read.parquet(f"{folder}/payloads").select("sha256", "n_bytes", "first_id", "sha1")
    light = stored(keyed.select("page_id", "url", "sha256", "n_bytes"), "warc-records")
    joined = light.join(firsts, ["sha256", "n_bytes"])
    revisit = (F.col("n_bytes") >= min_payload_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    typed = joined.withColumn("type", F.when(revisit, "revisit").otherwise("response"))
    is_revisit = F.col("type") == "revisit"
    http = F.concat(
        F.lit(HTTP_HEAD), F.lit("Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF * 2)
    )
    block = F.length(http) + F.when(is_revisit, 0).otherwise(F.col("n_bytes"))
    referred = F.concat(
        _line("WARC-Refers-To", _record_id(F.col("first_id"))),
        _line("WARC-Profile", F.lit(REVISIT_PROFILE)),
    )
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.col("type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Page-ID", number),
        F.when(is_revisit, referred).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    typed.select(
        F.concat(head, http).cast("binary").alias("headers"),
        F.when(~is_revisit, F.col("sha256")).alias("sha256"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("sha256").alias("payload_sha256"),
    ).write.parquet(f"{folder}/records")
    return folder


def restore(spark: SparkSession, folder: str) -> DataFrame:
    """Original records: ``record`` (the exact bytes of a WARC record), ``headers`` and
    ``payload`` (the full payload, also of revisits).

    Each stored payload is digested again and held against the digest and length it is
    filed under; one that differs, or is missing, stops the job.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    sound = (F.sha2("payload", 256) == F.col("sha256")) & (F.octet_length("payload") == F.col("n_bytes"))
    checked = payloads.select(
        F.col("sha256").alias("payload_sha256"),
        F.when(sound, F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "sha256")))
        .alias("payload"),
    )
    records = spark.read.parquet(f"{folder}/records")
    joined = records.join(checked, "payload_sha256", "left")
    found = F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("missing payload "), "payload_sha256"))
    )
    own = F.when(F.col("sha256").isNull(), F.lit(b"")).otherwise(F.col("payload"))
    return joined.withColumn("payload", found).select(
        F.concat("headers", own, F.lit(CRLF * 2).cast("binary")).alias("record"), "headers", "payload"
    )


def parse_records(records: DataFrame) -> DataFrame:
    """What the records say: ``page_id, url, record_type, payload_digest, payload_bytes,
    record_id, refers_to_record`` and whether their lengths and digests hold (``sound``)."""
    text = F.decode("headers", "utf-8")
    head = F.substring_index(text, CRLF * 2, 1)
    http = F.substring_index(F.substring_index(text, CRLF * 2, 2), CRLF * 2, -1)

    def value(part: Column, name: str) -> Column:
        found = F.regexp_extract(part, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    length = value(head, "Content-Length").cast("bigint")
    framing = F.octet_length(F.encode(head, "utf-8")) + F.lit(8)  # two blank lines
    digest = F.substring_index(value(head, "WARC-Payload-Digest"), ":", -1)
    n_bytes = F.octet_length("payload").cast("bigint")
    sound = (
        (F.octet_length("record") == framing + length)
        & (value(http, "Content-Length").cast("bigint") == n_bytes)
        & (digest == base32_sha1(F.col("payload")))
    )
    return records.select(
        value(head, "WARC-Page-ID").cast("bigint").alias("page_id"),
        value(head, "WARC-Target-URI").alias("url"),
        value(head, "WARC-Type").alias("record_type"),
        digest.alias("payload_digest"),
        n_bytes.alias("payload_bytes"),
        value(head, "WARC-Record-ID").alias("record_id"),
        value(head, "WARC-Refers-To").alias("refers_to_record"),
        sound.alias("sound"),
    )


def with_references(parsed: DataFrame) -> DataFrame:
    """``refers_to``: the ``page_id`` of the response that a revisit names, by a join on
    record ids; other records have null."""
    responses = (
        parsed.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(F.min("page_id").alias("refers_to"))
    )
    plain = parsed.where("refers_to_record is null").withColumn("refers_to", F.lit(None).cast("bigint"))
    revisits = parsed.where("refers_to_record is not null").join(
        stored(responses, "warc-responses"), "refers_to_record", "left"
    )
    return plain.unionByName(revisits.select(plain.columns))
