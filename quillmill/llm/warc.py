"""Content-addressed WARC archive: each payload is stored once, record headers are stored beside it.

An archive is two tables in one folder: records (the exact bytes of each record before its payload: WARC header, empty
line and, but for revisits, the HTTP header; and the address of its payload) and payloads (address, bytes). The address
is the SHA-256 of the bytes. On reading, each stored payload's digest is computed anew and must be its address; the
original records are reconstructed by a join on the address, and their fields are parsed from these bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmill.llm.common import staged

_END = "\r\n"


@F.pandas_udf(StringType())
def _base32(digests: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in digests:
        yield batch.map(lambda d: None if d is None else base64.b32encode(d).decode(), na_action="ignore")


def base32_sha1(payload: Column) -> Column:
    return _base32(F.unhex(F.sha1(payload)))


def _target(url: Column) -> Column:
    """The URL with controls, blanks and other signs that no URI has in percent form, each by its own bytes; other signs stay."""
    odd = r"[\x00-\x20<>\"{}|\\^`\x7f]"
    escapes = [c for c in map(chr, [*range(33), *map(ord, '<>"{}|\\^`'), 127])]
    out = url
    for sign in escapes:
        out = F.replace(out, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return F.when(url.rlike(odd), out).otherwise(url)


def _name(key: Column, row: Column) -> Column:
    """A version 8 UUID of a record: of its key and, as keys may repeat or be null, of its place among the records."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/"), row.cast("string")))
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-8"), F.substring(digest, 14, 3), F.lit("-8"), F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12))


def _written(key: Column) -> Column:
    """A key as a header can hold it, whatever its signs; an empty key is not an absent one."""
    return F.concat(F.lit("="), F.url_encode(key.cast("string")))


def _read(field: Column) -> Column:
    return F.url_decode(F.regexp_replace(field, "^=", ""))


def _field(name: str, value: Column) -> Column:
    """A line of a header; none for a null or empty value."""
    return F.when(F.length(value) > 0, F.concat(F.lit(f"{name}: "), value, F.lit(_END))).otherwise("")


def _head(date: str) -> Column:
    """A record's bytes before its payload, in the WARC 1.1 format: a response carries an HTTP header, a revisit an empty block."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("n").cast("string"), F.lit(_END * 2))
    length = F.when(revisit, F.lit(0)).otherwise(F.octet_length(F.encode(http, "UTF-8")) + F.col("n"))
    text = F.concat(
        F.lit(f"WARC/1.1{_END}"), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), "name", F.lit(">"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _target(F.col("url"))), _field("X-Key", _written(F.col("id"))), _field("X-Original-URL", F.when(_target(F.col("url")) != F.col("url"), F.translate(F.base64(F.encode("url", "UTF-8")), _END, ""))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:uuid:"), "first_name", F.lit(">")))), _field("X-Refers-To-Key", F.when(revisit, _written(F.col("first_id")))),
        _field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _field("Content-Type", F.when(~revisit, F.lit("application/http; msgtype=response"))), _field("Content-Length", length.cast("string")), F.lit(_END),
    )
    return F.encode(F.concat(text, F.when(revisit, "").otherwise(http)), "UTF-8")


def write_archive(df: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each row of df to the archive at `path`; `date` is the time of capture, as WARC writes it.

    Of the records with equal payloads of at least `least_bytes` bytes, that with the smallest key is a response
    and the others are revisits that refer to it; smaller ones are all responses. A null payload is empty. Rows with a
    repeated or null key are records of their own, with their own record ids, of which one is the response; a null
    key comes last. A URL with signs that a URI cannot have is written in percent form and beside it as it is, in
    base64. An empty table gives an empty archive. Other columns are not read.
    """
    # digests decide which record is first; payloads are shuffled once, to be stored once
    content = F.encode(F.coalesce(df[f"`{payload}`"].cast("string"), F.lit("")), "UTF-8")
    rows = df.select(df[f"`{key}`"].alias("id"), F.coalesce(df[f"`{url}`"], F.lit("")).alias("url"), content.alias("body"))
    pages = rows.select("id", "url", F.octet_length("body").cast("long").alias("n"), F.sha2("body", 256).alias("address"), base32_sha1(F.col("body")).alias("digest"))
    pages = staged(pages.withColumn("row", F.monotonically_increasing_id()), "records")
    big = pages.where(F.col("n") >= least_bytes)
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = staged(big.groupBy("address").agg(F.min(rank).alias("f")).select("address", F.col("f.id").alias("first_id"), F.col("f.row").alias("first_row")), "first")
    joined = pages.join(first, "address", "left")
    revisit = (F.col("n") >= least_bytes) & (F.col("row") != F.col("first_row"))
    names = _name(F.col("id"), F.col("row")).alias("name"), _name(F.col("first_id"), F.col("first_row")).alias("first_name")
    typed = joined.select("id", "url", "n", "address", "digest", "first_id", *names, F.when(revisit, "revisit").otherwise("response").alias("record_type"))
    typed.select("address", _head(date).alias("head")).write.option("compression", "zstd").parquet(f"{path}/records")
    name = F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("name")
    stored = rows.select(F.sha2("body", 256).alias("address"), name, "body")
    keep = first.select("address", F.coalesce(F.col("first_id").cast("string"), F.lit("none")).alias("name"))
    once = stored.where(F.octet_length("body") >= least_bytes).join(keep, ["address", "name"], "left_semi").dropDuplicates(["address", "name"])
    if least_bytes:
        small = stored.where(F.octet_length("body") < least_bytes).dropDuplicates(["address"])  # some may be stored by many responses
        once = once.unionByName(small)
    once.select("address", "body").write.option("compression", "zstd").parquet(f"{path}/payloads")


def reconstructed(spark: SparkSession, path: str) -> DataFrame:
    """(head, payload, digest): the original records: the bytes before the payload, and the payload, also of revisits.

    Each stored payload is verified by its address before it goes to its records, and digested once for all of them; a
    damaged or absent payload stops the job. A record of the archive is head, payload unless it is a revisit, and
    the end of the record (`record`).
    """
    stored = spark.read.parquet(f"{path}/payloads")
    intact = F.when(F.sha2("body", 256) == F.col("address"), F.col("body")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "address")).cast("binary"))
    payloads = stored.select(F.col("address").alias("a"), intact.alias("body"), base32_sha1(F.col("body")).alias("digest"))
    records = spark.read.parquet(f"{path}/records")
    joined = records.join(payloads.hint("merge"), F.col("address") == F.col("a"), "left")
    found = F.when(F.col("body").isNotNull(), F.col("body")).otherwise(F.raise_error(F.concat(F.lit("no payload "), "address")).cast("binary"))
    return joined.select("head", found.alias("payload"), "digest")


def record(head: Column, payload: Column) -> Column:
    """The bytes of a record as the archive format has them."""
    revisit = F.instr(F.decode(head, "UTF-8"), f"{_END}WARC-Type: revisit{_END}") > 0
    return F.concat(head, F.when(revisit, F.unhex(F.lit(""))).otherwise(payload), F.encode(F.lit(_END * 2), "UTF-8"))


def parsed(records: DataFrame) -> DataFrame:
    """The fields of reconstructed records, parsed from their bytes: id, url, record_type, refers_to, record_id, refers_to_id, payload_bytes, payload_digest.

    The payload's length and digest are those of the bytes; a record whose header says otherwise stops the job.
    """
    text = records.select("payload", "digest", F.decode("head", "UTF-8").alias("text"), F.octet_length("head").alias("head_bytes"))
    field = lambda name: F.nullif(F.regexp_extract("text", rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))
    uuid = lambda name: F.regexp_extract(field(name), "<urn:uuid:([^>]*)>", 1)
    url = F.coalesce(F.decode(F.unbase64(field("X-Original-URL")), "UTF-8"), field("WARC-Target-URI"), F.lit(""))
    http = F.octet_length(F.encode(F.regexp_extract("text", r"(?s)\r\n\r\n(.*)$", 1), "UTF-8"))
    out = text.select(
        _read(field("X-Key")).alias("id"), url.alias("url"), field("WARC-Type").alias("record_type"), _read(field("X-Refers-To-Key")).alias("refers_to"), uuid("WARC-Record-ID").alias("record_id"), uuid("WARC-Refers-To").alias("refers_to_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("said"), field("Content-Length").cast("long").alias("length"), http.alias("http"),
    )
    block = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("http") + F.col("payload_bytes"))
    whole = F.coalesce((F.col("said") == F.col("payload_digest")) & (F.col("length") == block), F.lit(False))
    sound = F.when(whole, True).otherwise(F.raise_error(F.concat(F.lit("header and payload differ in record "), "record_id")).cast("boolean"))
    return out.where(sound).drop("said", "length", "http")
