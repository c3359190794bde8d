"""Web archives: legacy ARC files converted to WARC files, and both read back.

Method: an ARC file states its version in its first record. A version-1 record line has 5 fields, a
version-2 line 10, the declared length being the last; records are found by those lengths alone. Each
record becomes a WARC record with a record id, timestamp, type and digests made from what the line and
the block say. Of equal payloads of `MIN_REVISIT` bytes or more only one is stored; the others revisit it.

Archives are written and read by Spark's own `text` and `binaryFile` sources, gzip-compressed, a bounded
number of records each, so every file system that Spark knows will do.

Rows: one record per page row. A null html has an empty payload. A null url is written as `urn:page`,
white space and control characters in urls as %20. Rows without a page_id are archived with an empty id;
they may revisit, and are never what others refer to unless no copy has an id: then all are responses.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.llm.common import arrow_batches, batch_rows
from lendframe.session import materialise, work_path

MIN_REVISIT = 1000
RECORDS_PER_FILE = 10_000
CRAWLED = "20240101000000"
ADDRESS = "0.0.0.0"
# The field lines of the two ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_RECORD = "page_id long, url string, ip string, date string, mime string, head binary, payload binary, payload_digest string"


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def _first_of_file(records: int) -> Column:
    """True for the row that starts a file when each file takes `records` rows of a partition."""
    return F.expr(f"(monotonically_increasing_id() & {(1 << 33) - 1}) % {records} = 0")


def write_arc(pages: DataFrame, records: int = RECORDS_PER_FILE) -> str:
    """Write `pages` (page_id, url, html) as ARC files, versions 1 and 2 by turns; returns their folder."""
    path = work_path(pages.sparkSession, "arc")
    size = F.octet_length(_payload(pages.html))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit("\r\nX-Page-Id: "),
        F.coalesce(pages.page_id.cast("string"), F.lit("")),
        F.lit("\r\n\r\n"),
    )
    url = F.coalesce(F.nullif(F.regexp_replace(pages.url, r"[\x00-\x20\x7f]", "%20"), F.lit("")), F.lit("urn:page"))
    length = (F.octet_length(head) + size).cast("string")
    common = F.concat(url, F.lit(f" {ADDRESS} {CRAWLED} text/html "))
    second = F.spark_partition_id() % 2 == 1
    line = F.when(second, F.concat(common, F.lit("200 - - 0 pages.arc "), length)).otherwise(F.concat(common, length))
    openings = []
    for version in (1, 2):
        block = f"{version} 0 archive\n{FIELDS[version]}\n"
        fields = f"{len(block)}" if version == 1 else f"200 - - 0 pages.arc {len(block)}"
        openings.append(f"filedesc://pages.arc {ADDRESS} {CRAWLED} text/plain {fields}\n{block}\n")
    opening = F.when(~_first_of_file(records), "").when(second, openings[1]).otherwise(openings[0])
    # The sink ends each row with the line feed that ends an ARC record.
    value = F.concat(opening, line, F.lit("\n"), head, F.coalesce(pages.html, F.lit("")))
    pages.select(value.alias("value")).write.option("maxRecordsPerFile", records).option("compression", "gzip").text(path)
    return path


def inflate(raw: bytes) -> bytes:
    """Contents of a gzip file of one or more members; other bytes as they are."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw))
        raw = member.unused_data
    return b"".join(out)


def arc_records(raw: bytes) -> Iterator[tuple[list[str], bytes]]:
    """(fields of the record line, block) of every record after the one that describes the file."""
    at, width = 0, 5
    while at < len(raw):
        if raw[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.index(b"\n", at)
        line = raw[at:end].decode("utf-8", "replace").rstrip("\r")
        opening = line.startswith("filedesc://")
        if opening:
            version = raw[end + 1 : raw.index(b"\n", end + 1)].split()[0]
            width = {b"1": 5, b"2": 10}[version]
        fields = line.rsplit(" ", width - 1)
        size = int(fields[-1])
        block = raw[end + 1 : end + 1 + size]
        if len(fields) != width or len(block) != size:
            raise ValueError(f"broken ARC record: {line[:200]}")
        at = end + 1 + size
        if not opening:
            yield fields, block


def _head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if v}


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files below `path`."""
    files = _files(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in _RECORD.split(", ")]
        for batch in batches:
            for raw in batch["content"]:
                rows = []
                for fields, block in arc_records(inflate(raw)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    known = _head_fields(head)
                    page = known.get("x-page-id")
                    digest = hashlib.sha1(payload).hexdigest()
                    rows.append((int(page) if page else None, *fields[:4], head, payload, digest))
                    if len(rows) == 500:
                        yield _frame(rows, names, "page_id")
                        rows = []
                yield _frame(rows, names, "page_id")

    return files.mapInPandas(run, _RECORD)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _frame(rows: list[tuple], names: list[str], *integers: str) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for c in integers:
        frame[c] = pd.array(frame[c].tolist(), dtype="Int64")
    return frame


def copies(pages: DataFrame) -> DataFrame:
    """_digest, response_id of every payload of `MIN_REVISIT` bytes or more that several rows share."""
    return (
        pages.select("page_id", _payload(F.col("html")).alias("_payload"))
        .where(F.octet_length("_payload") >= MIN_REVISIT)
        .groupBy(F.sha1("_payload").alias("_digest"))
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "response_id")
    )


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", page, digest).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-8"), part(18, 3),
        F.lit("-"), part(21, 12), F.lit(">"),
    )


def write_warc(records: DataFrame, shared: DataFrame, per_file: int = RECORDS_PER_FILE) -> str:
    """Write converted ARC `records` as WARC files; `shared` (see `copies`) says which ones revisit."""
    path = work_path(records.sparkSession, "warc")
    rows = records.join(shared, records.payload_digest == shared["_digest"], "left")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    target = F.col("response_id").cast("string")
    revisit = F.coalesce(F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")), F.lit(False))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    head = F.concat(F.col("head"), F.lit("\r\n\r\n").cast("binary"))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    when = F.concat_ws("", *(x for a, n, s in ((1, 4, "-"), (5, 2, "-"), (7, 2, "T"), (9, 2, ":"), (11, 2, ":"), (13, 2, "Z")) for x in (F.substring("date", a, n), F.lit(s))))
    named = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    header = F.concat(
        F.lit("WARC/1.1"),
        named("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        named("WARC-Record-ID", _record_id(page, F.col("payload_digest"))),
        named("WARC-Date", when),
        named("WARC-Target-URI", F.col("url")),
        named("WARC-IP-Address", F.col("ip")),
        named("WARC-Payload-Digest", digest),
        named("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block))),
        F.when(
            revisit,
            F.concat(
                named("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                named("WARC-Refers-To", _record_id(target, F.col("payload_digest"))),
                named("X-Refers-To-Page-Id", target),
            ),
        ).otherwise(""),
        named("Content-Type", F.lit("application/http; msgtype=response")),
        named("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n\r\n"),
    )
    info = "software: lendframe\r\nformat: WARC File Format 1.1\r\n"
    opening = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:00000000-0000-3000-8000-000000000000>\r\n"
        f"WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n{info}\r\n\r\n"
    )
    # Bytes cast to string stay the same bytes; the sink adds the last line feed of the record.
    value = F.concat(F.when(_first_of_file(per_file), opening).otherwise(""), header, block.cast("string"), F.lit("\r\n\r"))
    rows.select(value.alias("value")).write.option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)
    return path


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        if not raw.startswith(b"WARC/", at):
            raise ValueError(f"broken WARC record at byte {at}")
        fields = _head_fields(raw[at:end])
        size = int(fields["content-length"])
        block = raw[end + 4 : end + 4 + size]
        if len(block) != size or raw[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"broken WARC record at byte {at}")
        yield fields, block
        at = end + 8 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per response or revisit record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Stored payloads are hashed again; a record whose digest does not fit fails the read.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [f.split()[0] for f in schema.split(", ")]
    files = _files(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                rows = []
                for fields, block in warc_records(inflate(raw)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    http = _head_fields(head)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload digest does not fit: {fields['warc-record-id']}")
                    page, target = http.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append(
                        (
                            int(page) if page else None,
                            fields.get("warc-target-uri"),
                            len(payload) if kind == "response" else int(http["content-length"]),
                            digest,
                            kind,
                            int(target) if target else None,
                        )
                    )
                yield _frame(rows, names, "page_id", "payload_bytes", "refers_to")

    return files.mapInPandas(run, schema)


def archive(pages: DataFrame) -> DataFrame:
    """Write `pages` as ARC, convert to WARC, read the WARC files back."""
    spark = arrow_batches(pages.sparkSession)
    with batch_rows(spark, 1):  # an archive at a time
        legacy = read_arc(spark, write_arc(pages.select("page_id", "url", "html")))
        return materialise(read_warc(spark, write_warc(legacy, copies(pages))), "archived")
