"""WARC archives and transaction assembly (operator 4).

Every page becomes three records: a request, a response (or a revisit, when an
earlier page has the same payload of at least 100 bytes) and a metadata record;
request and metadata name the response record in WARC-Concurrent-To. Archives
are gzip WARC files in shared storage, written by Spark's text writer (each
record ends with the blank lines the format asks for, which is the writer's
line separator) and read back as binary files, parsed by Content-Length.
Assembly joins the three records through the concurrent-to identifiers into one
nested row per capture; payloads stay out of every shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaspark.llm.common import scratch_path, shared_table, small_side

END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 16 << 20  # payload aimed at per archive file
BROADCAST_ROWS = 200_000


def _urn(kind: str, key) -> F.Column:
    """urn:uuid from a digest of the row's key, so that a re-run task writes the same record."""
    h = F.md5(F.concat(F.lit(f"{kind}:"), key))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _record(kind: str, rid, fields: list[tuple[str, F.Column]], body: F.Column) -> F.Column:
    """One record without its closing blank lines; fields whose value is null are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), rid),
             *[F.concat(F.lit(f"{n}: "), v) for n, v in fields],
             F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), body)


def _row_key(page, url, digest, copy) -> F.Column:
    """What tells a row from all others: page id, payload digest, url and the number among rows equal in these."""
    return F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("null")), F.hex(digest),
                       F.coalesce(F.md5(url), F.lit("null")), copy.cast("string"))


def page_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, d, large) of every row: the payload's digest, and whether it has at least 100 bytes."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.unhex(F.sha2(body, 256)).alias("d"),
                        (F.octet_length(body) >= MIN_REVISIT_BYTES).alias("large"))


def first_copies(keyed: DataFrame) -> DataFrame:
    """(id, d, first_id, first_url) of the pages that repeat an earlier page's payload of at least 100 bytes.

    Digests are computed where the pages are read; only keys are shuffled, and the minimum of a
    digest is combined map-side, so thousands of copies of one page stay cheap. A page without an
    id is neither earlier nor later than another."""
    large = keyed.where("large and id is not null")
    first = large.groupBy("d").agg(F.min(F.struct("id", "url")).alias("first"), F.max("id").alias("last")).where("last > first.id")
    return (large.join(first, "d").where("id > first.id")
            .select("id", "d", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url")).distinct())


def _numbered(own: DataFrame, keyed: DataFrame) -> DataFrame:
    """``own`` with ``copy``, the number of a row among equal rows. Equal rows are exchangeable, so they become one
    row and as many numbers; only they are shuffled."""
    again = shared_table(keyed.groupBy("id", "url", "d").agg(F.count("*").alias("n")).where("n > 1")
                         .select(F.col("id").alias("id2"), F.col("url").alias("url2"), F.col("d").alias("d2"), "n"), "equal-rows")
    if again.isEmpty():
        return own.withColumn("copy", F.lit(0).cast("long"))
    again = small_side(again, BROADCAST_ROWS)
    same = F.col("id").eqNullSafe(F.col("id2")) & F.col("url").eqNullSafe(F.col("url2")) & (F.col("d") == F.col("d2"))
    equal = (own.join(again, same).dropDuplicates(["id", "url", "d"])
             .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))))
    return (own.join(again, same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
            .unionByName(equal.drop("id2", "url2", "d2", "n")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """Write the records of ``pages`` as gzip WARC files under ``path``.

    A null payload is empty, a null url or page id is left out of the headers. Every row has its own records, rows
    of one page id and repeated rows too; line ends in a url are percent-encoded."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    keyed = shared_table(page_keys(pages, id_col, url_col, html_col), "page-digests")
    copies = shared_table(first_copies(keyed), "revisits")
    if copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"),
                       F.unhex(F.sha2(body, 256)).alias("d"))
    rows = _numbered(own, keyed).join(copies, ["id", "d"], "left")
    page = F.col("id").cast("string")
    key = _row_key(F.col("id"), F.col("url"), F.col("d"), F.col("copy"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    target = [("WARC-Target-URI", url), ("X-Page-Id", page)]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("d"))))
    main, again = _urn("response", key), F.col("first_id").isNotNull()
    response = _record("response", main, [*target, digest, ("Content-Type", F.lit("text/html; charset=utf-8"))], F.col("body"))
    revisit = _record("revisit", main, [
        *target, digest, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", _urn("response", _row_key(F.col("first_id"), F.col("first_url"), F.col("d"), F.lit(0))))], F.lit(""))
    request = _record("request", _urn("request", key), [("WARC-Concurrent-To", main), *target],
                      F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record("metadata", _urn("metadata", key), [
        ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("pageId: "), page, F.lit("\r\n")), F.lit("")))
    mean = pages.select(body.alias("body")).agg(F.avg(F.octet_length("body"))).first()[0] or 0.0
    (rows.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", max(30, int(3 * FILE_BYTES / (mean + 600)))).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; lengths come from Content-Length, never from the payload's text."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        body = stop + 4
        end = body + int(head["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut")
        yield head, data[body:end]
        at = end + 4


_PARSED = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("refers_to_id", pa.string()),
    ("target_uri", pa.string()), ("page_id", pa.int64()), ("declared_digest", pa.string()), ("block_bytes", pa.int64()),
    ("block_digest", pa.string()), ("block", pa.binary())])


def read_archives(spark: SparkSession, path: str, with_block: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``; ``block`` is null unless asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                rows = []
                for head, block in parse_records(zlib.decompress(raw.as_py(), 31)):
                    page = head.get("X-Page-Id")
                    rows.append((head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Concurrent-To"),
                                 head.get("WARC-Refers-To"), head.get("WARC-Target-URI"), int(page) if page else None,
                                 head.get("WARC-Payload-Digest"), len(block), hashlib.sha256(block).hexdigest(),
                                 block if with_block else None))
                    if with_block and len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PARSED)], schema=_PARSED)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PARSED)], schema=_PARSED)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "record_id string, record_type string, concurrent_to string, refers_to_id string, "
                                 "target_uri string, page_id bigint, declared_digest string, block_bytes bigint, "
                                 "block_digest string, block binary")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, request, response, metadata.

    ``response`` is the response or revisit record. Requests and metadata records find it through
    WARC-Concurrent-To; they may be missing (null struct). Several of one kind: the smallest record id counts."""
    mains = records.where("record_type in ('response', 'revisit')").select(
        F.col("record_id").alias("rid"), "page_id",
        F.struct("record_id", "record_type", "target_uri", "refers_to_id", "declared_digest", "block_bytes",
                 "block_digest", "block").alias("response"))
    sides = (records.where("concurrent_to is not null")
             .groupBy(F.col("concurrent_to").alias("rid"))
             .agg(*[F.min(F.when(F.col("record_type") == k, F.struct("record_id", "target_uri", "block_bytes", "block_digest")))
                    .alias(k) for k in ("request", "metadata")]))
    return mains.join(sides, "rid", "left").select("page_id", "request", "response", "metadata")


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives of ``pages``, read them back and assemble the captures.

    Adds to each capture payload_bytes, payload_digest (of the full payload: a revisit takes them from the
    response it refers to) and refers_to (that response's page id, null for responses). One row per row of ``pages``,
    repeated ones and those without a page id too (these are always responses);
    an empty table gives an empty result; other columns of ``pages`` are not read."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    got = shared_table(assemble(shared_table(read_archives(spark, path), "warc-records")), "captures")
    again = got.where("response.record_type = 'revisit'")
    wanted = again.select(F.col("response.refers_to_id").alias("rid")).distinct()
    first = got.select(F.col("response.record_id").alias("rid"), F.col("page_id").alias("first_page"),
                       F.col("response.block_bytes").alias("first_bytes"), F.col("response.block_digest").alias("first_digest"))
    first = first.join(wanted, "rid", "left_semi").dropDuplicates(["rid"])
    return got.join(first, F.col("response.refers_to_id") == F.col("rid"), "left").select(
        F.col("page_id"), F.coalesce("first_bytes", "response.block_bytes").alias("payload_bytes"),
        F.coalesce("first_digest", "response.block_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"), F.col("first_page").alias("refers_to"),
        "request", "response", "metadata")
