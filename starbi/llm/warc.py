"""Content-addressed web archive (DataFrame operations only).

``write_archive`` stores two tables.  ``blobs`` has every distinct payload once,
under the SHA-256 of its bytes; rows that share an address must agree in length
and SHA-1 too, else the write fails.  ``headers`` has each record's exact WARC
header text and the address of its payload.  ``read_records`` joins them: every
blob is hashed again and must give its address, and each record is put together
again from its header and its payload.  ``read_archive`` takes its columns from
these records: the header is parsed and the block measured in each.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with
the largest page id is the response and the others are revisits that refer to
it; smaller ones are all responses.

Cases: a null html is an empty payload; a null url has no target line; line
breaks in a url are percent-encoded in its header; rows that repeat the largest
id are all responses; a null id is never the largest, and is a response only if
no row with that payload has an id; empty tables give empty archives; only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import stored

REVISIT_BYTES = 1000
#: the crawl's date is a parameter: the table has none
DATE = "2024-01-01T00:00:00Z"
_EOL = "\r\n"
#: fixed value: the profile of revisits that have their response's payload
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """``name: value`` and a line end; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_EOL)), F.lit(""))


def _record_name(id_: Column, url: Column, address: Column) -> Column:
    """A record's URI, from its id, its address and its payload's: rows that differ in
    any of them have records of different names."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"),
                    F.lower(F.hex(F.xxhash64(url))), F.lit(":"), address, F.lit(">"))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  body_col: str = "html", date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """The stored tables (headers, blobs) of one record per row."""
    payload = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("address"))
    rows = rows.withColumn("named", _record_name(F.col("id"), F.col("url"), F.col("address")))
    # copies collapse in each task before the shuffle
    each = rows.select("id", "named", "address", "payload", F.sha1("payload").alias("sha1"),
                       F.octet_length("payload").cast("long").alias("bytes"))
    blobs = each.groupBy("address").agg(
        F.first("payload").alias("payload"), F.min("sha1").alias("sha1"),
        F.max("sha1").alias("sha1b"), F.min("bytes").alias("bytes"),
        F.max("bytes").alias("bytesb"), F.max("id").alias("newest"),
        F.max(F.when(F.col("id").isNotNull(), F.struct("id", "named"))).alias("response"))
    agree = (F.col("sha1") == F.col("sha1b")) & (F.col("bytes") == F.col("bytesb"))
    blobs = stored(blobs.select(
        F.when(agree, F.col("address")).otherwise(F.raise_error("two payloads share an address"))
        .alias("address"), "payload", "sha1", "bytes", "newest",
        F.col("response.named").alias("response")), "warc-blobs")
    meta = rows.select("id", "url", "named", "address").join(
        blobs.select("address", "sha1", "bytes", "newest", "response"), "address")
    revisit = (F.col("bytes") >= REVISIT_BYTES) & F.col("newest").isNotNull() \
        & ~F.col("id").eqNullSafe(F.col("newest"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{_EOL}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.col("named")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, F.col("response"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit(_EOL))
    headers = stored(meta.select("id", "address", header.alias("header")), "warc-headers")
    return headers, blobs


def _verified(blobs: DataFrame) -> DataFrame:
    ok = F.sha2("payload", 256) == F.col("address")
    return blobs.select(
        F.when(ok, F.col("address")).otherwise(F.raise_error("a payload does not match its address"))
        .alias("address"), "payload")


def _field(name: str, header: str = "header") -> Column:
    value = F.regexp_extract(header, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_records(headers: DataFrame, blobs: DataFrame) -> DataFrame:
    """(id, header, payload, record): every record as it was written; a revisit's
    record has no block, its payload is that of the record that it refers to."""
    rows = headers.join(_verified(blobs), "address")
    block = F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary")) \
        .otherwise(F.col("payload"))
    record = F.concat(F.col("header").cast("binary"), block, F.lit(_EOL * 2).cast("binary"))
    return rows.select("id", "header", "payload", record.alias("record"))


def read_archive(headers: DataFrame, blobs: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every record
    as it is put together again: its header ends at its first blank line, its block
    must be as long as that says and, like the payload that a revisit refers to,
    have the digest that it says."""
    blank = _EOL * 2
    head = F.concat(F.substring_index(F.col("record").cast("string"), blank, 1), F.lit(blank))
    rows = read_records(headers, blobs).select("id", "payload", "record", head.alias("head"))
    start, size = F.octet_length("head"), F.octet_length("record")
    rows = rows.select("id", "payload", "head", F.substring(
        "record", start + 1, size - start - len(blank)).alias("block"),
        F.substring("record", size - len(blank) + 1, F.lit(len(blank))).alias("tail"))
    whole = (_field("Content-Length", "head") == F.octet_length("block").cast("string")) \
        & (F.col("tail") == F.lit(blank).cast("binary"))
    kind = _field("WARC-Type", "head")
    rows = rows.select("id", "head", kind.alias("record_type"), F.when(whole, F.when(
        kind == "revisit", F.col("payload")).otherwise(F.col("block")))
        .otherwise(F.raise_error("a record is not as long as its header says")).alias("payload"))
    rows = rows.select("id", "head", "record_type", F.octet_length("payload").cast("long")
                       .alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    matches = _field("WARC-Payload-Digest", "head") == F.concat(F.lit("sha1:"), "payload_digest")
    refers = F.regexp_extract(_field("WARC-Refers-To", "head"), "<urn:page:(.*):[0-9a-f]*:[0-9a-f]*>", 1)
    return rows.select(
        F.col("id").alias(id_col), "payload_bytes",
        F.when(matches, F.col("payload_digest"))
        .otherwise(F.raise_error("a payload does not match its header")).alias("payload_digest"),
        "record_type",
        F.when(refers != "", refers).cast(headers.schema["id"].dataType).alias("refers_to"))
