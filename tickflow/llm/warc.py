"""WARC archives as a chunked record table.

A record is one row of text, and Spark's text source writes and reads the rows with the separators of the format, on any file system. A
payload over the chunk size becomes a first record and continuation records (the format's own segments), numbered under one record
identifier, so no task holds it whole when it is read: chunks stream by, and a digest is carried from one to the next.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, read, shared_dir

#: Code points of a payload in one record.
CHUNK = 1 << 16
VERSION, DATE = "WARC/1.0", "1970-01-01T00:00:00Z"
_END, _NEXT = "\r\n\r\n", f"\r\n\r\n{VERSION}\r\n"


def base32_of_hex(sha1: Column) -> Column:
    """The base32 of a SHA-1 in hex: four groups of 40 bits, eight digits each."""
    groups = [F.lpad(F.conv(F.substring(sha1, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def chunks_of(payload: Column, size: int = CHUNK) -> Column:
    """The payload in order, in parts of at most `size` code points of which none contains what separates two records."""
    parts = F.split(payload, r"(?<=\r\n\r\nWARC/1.0\r)(?=\n)")
    return F.when((F.length(payload) <= size) & (F.instr(payload, _NEXT) == 0), F.array(payload)).otherwise(F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit("(?s).{1,%d}" % size), F.lit(0)))))


def write_archive(df: DataFrame, path: str, *, chunk: int = CHUNK, date: str = DATE, compression: str = "gzip", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write a record per row of df below path: of equal payloads the row with the largest id is a response, the others revisit it.

    The payload is text, in UTF-8; null is empty. Rows of a null id are responses, and so are repeated rows of the largest id. A row that
    is written as a revisit holds no payload. An empty table gives an empty archive. Ids are whole numbers; only the three columns are
    read. The digests are grouped without the payloads, which are shuffled once, by id and digest."""
    rows = df.select(column(df, id_col).cast("long").alias("id"), F.coalesce(column(df, url_col), F.lit("")).alias("url"), F.coalesce(column(df, payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_of_hex(F.sha1(F.col("payload").cast("binary"))))
    short = rows.select("id", "digest").where("id is not null")
    largest = short.groupBy("digest").agg(F.max("id").alias("response"))
    visits = short.join(largest, "digest").where("id < response").distinct()
    rows = rows.join(visits, ["id", "digest"], "left")
    revisit = F.col("response").isNotNull()
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn("chunks", F.when(revisit, F.array(F.lit(""))).otherwise(chunks_of(F.col("payload"), chunk)))
    rows = rows.select("id", "url", "digest", "response", "bytes", F.size("chunks").alias("of"), F.posexplode("chunks").alias("k", "body"))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    origin = _urn(key, F.col("url"), F.col("digest"))
    head = lambda name, value, when=F.lit(True): F.when(when, F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    first, several, last = F.col("k") == 0, F.col("of") > 1, F.col("k") + 1 == F.col("of")
    fields = [
        head("WARC-Type", F.when(~first, "continuation").when(F.col("response").isNotNull(), "revisit").otherwise("response")),
        head("WARC-Record-ID", F.when(first, origin).otherwise(_urn(key, F.col("url"), F.col("digest"), F.col("k")))),
        head("WARC-Date", F.lit(date)),
        head("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " "), first),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"), first),
        head("WARC-Segment-Number", F.col("k") + 1, several),
        head("WARC-Segment-Origin-ID", origin, ~first),
        head("WARC-Segment-Total-Length", F.col("bytes"), several & last),
        head("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.col("response").isNotNull()),
        head("X-Refers-To-Page", F.col("response"), F.col("response").isNotNull()),
        head("X-Page-Id", key, first),
        head("X-Payload-Bytes", F.col("bytes"), first),
        head("Content-Type", F.lit("text/html; charset=utf-8"), first),
        F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")),
    ]
    rows.select(F.concat(F.lit(f"{VERSION}\r\n"), *fields, F.lit(_END), "body").alias("value")).write.option("lineSep", _END).option("compression", compression).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table: a row per record of the archives below path, with origin (the record identifier), chunk (from 1) and the
    bytes of the chunk. Headers that a record lacks are null."""
    rows = spark.read.option("lineSep", _NEXT).text(path).where("trim(value) <> ''")
    rows = rows.withColumn("head", F.substring_index("value", _END, 1))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r\n]*)", 1), F.lit(""))
    rows = rows.select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"), F.coalesce(field("WARC-Segment-Number").cast("long"), F.lit(1).cast("long")).alias("chunk"), field("WARC-Segment-Number").isNotNull().alias("segmented"),
        field("WARC-Type").alias("type"), field("X-Page-Id").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        field("X-Payload-Bytes").cast("long").alias("stated_bytes"), field("X-Refers-To-Page").cast("long").alias("refers_to"), field("WARC-Segment-Total-Length").cast("long").alias("total"),
        F.substring(F.col("value").cast("binary"), F.octet_length("head") + 5, field("Content-Length").cast("int")).alias("body"), field("Content-Length").cast("long").alias("length"),
    )
    return rows


def _digested(chunks: DataFrame) -> DataFrame:
    """Of payloads in several chunks, one row each with the length and SHA-1 of all of it. Chunks stream in the order of their numbers;
    only the running digest of the record at hand is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row(origin, s):
            return batch(origin=pa.array([origin]), head=pa.array([s[0]], pa.int64()), url=pa.array([s[1]], pa.string()), stated_digest=pa.array([s[2]], pa.string()), bytes=pa.array([s[3]], pa.int64()), digest=pa.array([base64.b32encode(s[4].digest()).decode()]), whole=pa.array([s[3] == s[5]]))

        for rows in batches:
            for k in range(rows.num_rows):
                origin, chunk, page, url, stated, total, body = (rows.column(c)[k] for c in range(7))
                if (origin := origin.as_py()) != now:
                    if state:
                        yield row(now, state)
                    now, state, at = origin, [page.as_py(), url.as_py(), stated.as_py(), 0, hashlib.sha1(), None], 0
                if chunk.as_py() == at:
                    continue  # the same chunk of a repeated row
                at = chunk.as_py()
                body = body.as_buffer()
                state[3] += body.size
                state[4].update(body)
                state[5] = total.as_py() or state[5]
        if state:
            yield row(now, state)

    order = chunks.select("origin", "chunk", "page_id", "url", "stated_digest", "total", "body").repartition("origin").sortWithinPartitions("origin", "chunk")
    return order.mapInArrow(run, "origin string, head long, url string, stated_digest string, bytes long, digest string, whole boolean")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record that was written below path: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and intact: the
    digest and length of what was read are those that were stated. A revisit has those of the payload that it stands for. Of a repeated
    row with a payload of several chunks, one row comes back per record identifier."""
    rows = read_chunks(spark, path)
    one = rows.where("not segmented").withColumn("found", base32_of_hex(F.sha1("body")))
    visit = F.col("type") == "revisit"
    one = one.select("page_id", "url", F.when(visit, F.col("stated_bytes")).otherwise(F.octet_length("body")).cast("long").alias("payload_bytes"), F.when(visit, F.col("stated_digest")).otherwise(F.col("found")).alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", (visit | ((F.col("found") == F.col("stated_digest")) & (F.octet_length("body") == F.col("length")))).alias("intact"))
    many = _digested(rows.where("segmented")).select(F.col("head").alias("page_id"), "url", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), (F.col("whole") & (F.col("digest") == F.col("stated_digest"))).alias("intact"))
    return one.unionByName(many)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_archive(read(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), b AS (
  SELECT *, octet_length(encode(html))::BIGINT AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS top
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to, true AS intact FROM b
"""
