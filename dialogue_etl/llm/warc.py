"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart, joins to rebuild.

The payload store has one row a digest (SHA-1 and SHA-256 together, so equal keys mean equal bytes; both are
computed again from the stored bytes on reading). The header store has every record's header block as written
and the digest of its payload. A record is the join of the two.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_etl.llm.common import note_scratch, scratch_dir

#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_URN = "urn:x-page:"
EOL = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base 32 of a 160-bit digest in hexadecimal: five digits are twenty bits, four characters."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _payload(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    body = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"))
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "sha256": F.sha2("payload", 256)})


def _header(kind: Column, own: Column, url: Column, date: str, digest: Column, refers: Column, length: Column) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))

    target = F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x1f\\x7f]+", " ")
    more = F.when(kind == "revisit", F.concat(line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_URN}"), refers.cast("string"), F.lit(">"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_URN}"), F.coalesce(own.cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        more,
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(kind == "revisit", F.lit(0)).otherwise(length).cast("string")),
        F.lit(EOL),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> str:
    """Writes path/payloads and path/headers.

    Of records with equal payloads of at least min_bytes the one with the largest id is the response, the
    others revisit it; records of smaller payloads are all responses. A null body is an empty payload, a null
    id is below all others; rows that repeat an id and its payload have the same type.
    """
    spark, rows = pages.sparkSession, _payload(pages, id_col, url_col, body_col)
    # One shuffle of payloads: copies are dropped before it, in every task.
    store = rows.groupBy("sha1", "sha256").agg(F.max("page_id").alias("response_id"), F.first("payload").alias("payload"))
    store.write.option("compression", "zstd").parquet(f"{path}/payloads")
    held = spark.read.schema(store.schema).parquet(f"{path}/payloads").select("sha1", "sha256", "response_id")
    narrow = rows.select("page_id", "url", "payload_bytes", "sha1", "sha256").join(held, ["sha1", "sha256"])
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    header = _header(kind, F.col("page_id"), F.col("url"), date, base32_of_hex(F.col("sha1")), F.col("response_id"), F.col("payload_bytes"))
    narrow.select("sha1", "sha256", header.alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload, record) of every record, rebuilt by a join: payload is the full one for revisits too, record
    the bytes as they stand in a WARC file, header block, block and two line ends.

    Both digests are computed again from the stored bytes; a mismatch ends the job.
    """
    payloads = spark.read.schema("sha1 string, sha256 string, response_id long, payload binary").parquet(f"{path}/payloads")
    sound = (F.sha1("payload") == F.col("sha1")) & (F.sha2("payload", 256) == F.col("sha256"))
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload doesn't match its digest "), F.col("sha1"))).cast("binary"))
    headers = spark.read.schema("sha1 string, sha256 string, header string").parquet(f"{path}/headers")
    rows = headers.join(payloads.select("sha1", "sha256", checked.alias("payload")), ["sha1", "sha256"])
    block = F.when(_named("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return rows.select("header", "payload", F.concat(F.encode("header", "UTF-8"), block, F.lit((EOL + EOL).encode())).alias("record"))


def _named(name: str, header: str = "header") -> Column:
    """A header line's value: lines end at CR LF only, whatever else a value holds."""
    lines = F.filter(F.split(header, EOL), lambda x: x.startswith(f"{name}: "))
    return F.substring(F.get(lines, F.lit(0)), len(name) + 3, 1 << 30)


def _page_of(name: str) -> Column:
    return F.regexp_extract(_named(name), f"^<{RECORD_URN}(-?\\d+)>$", 1).try_cast("long")


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of an archive, read from the record's bytes: its header block ends at the first empty line."""
    rows = read_archive(spark, path).select(F.substring_index(F.col("record").cast("string"), EOL + EOL, 1).alias("header"), "payload")
    return rows.select(
        _page_of("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_replace(_named("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _named("WARC-Type").alias("record_type"),
        _page_of("WARC-Refers-To").alias("refers_to"),
    )


def export_warc(spark: SparkSession, archive: str, path: str) -> None:
    """The archive as WARC files, written by Spark's text sink as one gzip stream a file."""
    record = F.decode("record", "UTF-8")
    read_archive(spark, archive).select(F.substring(record, F.lit(1), F.length(record) - 4).alias("value")).write.option("lineSep", EOL + EOL).option("compression", "gzip").text(path)


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import gzip

    for batch in batches:
        for content in batch["content"]:
            data, at, rows = gzip.decompress(content), 0, []
            while at < len(data):
                body = data.index(b"\r\n\r\n", at) + 4
                header = data[at:body].decode("utf-8")
                length = int(header.rpartition("Content-Length: ")[2].split(EOL)[0])
                rows.append((header, data[body : body + length]))
                at = body + length + 4
            yield pd.DataFrame(rows, columns=["header", "block"])


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of every record in WARC files that export_warc() wrote; a file is read in one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(_parsed, "header string, block binary")


def op6_warc_archive(spark, sf_dir: str) -> DataFrame:
    """All pages written to an archive and read back from its records. A null page is an empty payload, a null id
    is below all others, rows that repeat an id and its payload have the same type."""
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    note_scratch(path)
    return records(spark, write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, h, max(page_id) OVER (PARTITION BY body) AS top FROM p),
k AS (SELECT *, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', substr(h, CAST(i + 1 AS INTEGER), 1)) - 1) AS x FROM q),
b AS (SELECT *, list_transform(range(0, 32), lambda i: CAST((x[CAST(5 * i // 4 AS INTEGER) + 1] * 16 + coalesce(x[CAST(5 * i // 4 AS INTEGER) + 2], 0)) // CAST(pow(2, 3 - (5 * i) % 4) AS INTEGER) % 32 AS INTEGER)) AS v FROM k)
SELECT page_id, payload_bytes, array_to_string(list_transform(v, lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b
"""
