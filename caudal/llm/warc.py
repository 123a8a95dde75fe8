"""WARC archives from legacy ARC archives, and back to rows.

`write_arc` stores pages as ARC archives of version 1 or 2. `read_arc` parses them: the version block names the
fields of each header line, the last field is the declared length of the block after it. `convert`
synthesises WARC records: an identifier (UUID of version 5, from the record's number), an ISO timestamp
from the 14 digits, the type, and SHA-1 digests of block and payload. Of equal payloads one record is the
response and the others are revisits of it. `read_warc` parses WARC archives by declared lengths.

One archive is one row of a text frame, written to one gzip file by Spark (the last line feed of an
archive is the line end of the writer). An archive closes after ARCHIVE_BYTES, so that a file read
whole fits a task; only a page larger than that makes a larger file. Spark's committer makes the
files safe against lost executors, on any file system it knows.

Payloads are compared by length and SHA-256. The revisits are a narrow staged table; if it is
small, Spark broadcasts it by its measured size, otherwise both sides are shuffled by record number.

Defined cases: a null html is an empty payload; a null url becomes `unknown:`; a null page_id is kept and
sorts below all others; of rows with equal page_id and payload one is the response; columns beside page_id, url
and html are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches, keyed_join, scratch, staged

ARCHIVE_BYTES = 8 << 20
CRAWLED = "20240101000000"
# Field names of the two ARC versions and the revisit profile, fixed by the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = ("record long, page_id long, url string, ip string, date string, mime string, "
           "head binary, payload binary, payload_bytes long, payload_digest string, same binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'caudal:record:{record}')}>"


def _one_file_each(archives: DataFrame, path: str) -> None:
    archives.write.options(maxRecordsPerFile=1, compression="gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _archives(frame: DataFrame, opening, entry, at_most: int) -> DataFrame:
    """Rows of whole archives: an opening and entries until `at_most` bytes are reached.

    Both get the archive's number within its task.
    """
    numbers = [0]

    def each(columns):
        rows = [dict(zip(columns, row, strict=True)) for row in zip(*columns.values(), strict=True)]
        done, parts, size = [], [], 0
        for row in rows:
            if not parts:
                parts, size = [opening(numbers[0])], 0
                numbers[0] += 1
            parts.append(entry(numbers[0] - 1, row))
            size += len(parts[-1])
            if size >= at_most:
                done.append(b"".join(parts))
                parts = []
        if parts:
            done.append(b"".join(parts))
        for archive in done:
            yield {"value": [archive[:-1].decode()]}

    return in_batches(frame, each, "value string")


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = (1, 2),
              archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives, of the versions in turn, of (record, page_id, url, html) as HTTP responses."""
    extras = {1: "", 2: "200 - - 0 caudal.arc "}

    def opening(number: int) -> bytes:
        version = versions[number % len(versions)]
        extra = extras[version]
        block = f"{version} 0 caudal\n{ARC_FIELDS[version]}\n".encode()
        return f"filedesc://caudal.arc 0.0.0.0 {CRAWLED} text/plain {extra}{len(block)}\n".encode() + block + b"\n"

    def entry(number: int, row: dict) -> bytes:
        extra = extras[versions[number % len(versions)]]
        payload = (row["html"] or "").encode()
        page = "-" if row["page_id"] is None else row["page_id"]
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                 f"X-Page-Id: {page}\r\nX-Record: {row['record']}\r\n\r\n").encode() + payload
        url = "unknown:" if row["url"] is None else quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~")
        return f"{url} 0.0.0.0 {CRAWLED} text/html {extra}{len(block)}\n".encode() + block + b"\n"

    _one_file_each(_archives(pages.select("record", "page_id", "url", "html"), opening, entry, archive_bytes), path)


def arc_entries(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each entry of one archive, the version block left out."""
    names: list[str] = []
    place = 0
    while place < len(data):
        end = data.index(b"\n", place)
        header = data[place:end].decode().split(" ")
        length = int(header[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise ValueError(f"archive ends within the block of {header[0]}")
        if names:
            yield dict(zip(names, header, strict=True)), block
        else:  # the version block: its own header has as many fields as it names
            names = block.split(b"\n")[1].decode().split(" ")
        place = end + 1 + length + 1


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, header fields and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return head + b"\r\n\r\n", fields, payload


def _number(text: str) -> int | None:
    return None if text == "-" else int(text)


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per entry of the archives below `path`; without payloads only their digests."""
    def each(columns):
        for content in columns["content"]:
            out = {name.split()[0]: [] for name in _RECORD.split(", ")}
            for fields, block in arc_entries(gzip.decompress(content)):
                head, http, payload = http_parts(block)
                out["record"].append(int(http["X-Record"]))
                out["page_id"].append(_number(http["X-Page-Id"]))
                out["url"].append(fields["URL"])
                out["ip"].append(fields["IP-address"])
                out["date"].append(fields["Archive-date"])
                out["mime"].append(fields["Content-type"])
                out["head"].append(head)
                out["payload"].append(payload if payloads else None)
                out["payload_bytes"].append(len(payload))
                out["payload_digest"].append(base32_sha1(payload))
                out["same"].append(hashlib.sha256(payload).digest())
            yield out

    return in_batches(_files(spark, path), each, _RECORD)


def revisits(records: DataFrame, at_least: int = 0) -> DataFrame:
    """(record, refers_record, refers_page) of records whose payload a response already holds."""
    rows = records.filter(F.col("payload_bytes") >= at_least).select("record", "page_id", "payload_bytes", "same")
    kept = rows.groupBy("payload_bytes", "same").agg(F.max(F.struct("page_id", "record")).alias("kept"))
    return (keyed_join(rows, kept, ["payload_bytes", "same"])
            .filter(F.col("record") != F.col("kept.record"))
            .select("record", F.col("kept.record").alias("refers_record"),
                    F.col("kept.page_id").alias("refers_page")))


def warc_record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items()),
             f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def iso_date(digits: str) -> str:
    """14 digits, or fewer of an older archive, as an ISO timestamp."""
    d = (digits + "00000101000000"[len(digits):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of records with refers_record and refers_page (null for responses)."""
    def opening(_: int) -> bytes:
        block = b"software: caudal\r\nformat: WARC File Format 1.1\r\n"
        return warc_record("warcinfo", {
            "WARC-Record-ID": record_id(-1), "WARC-Date": iso_date(CRAWLED),
            "Content-Type": "application/warc-fields"}, block)

    def entry(_: int, row: dict) -> bytes:
        fields = {"WARC-Record-ID": record_id(row["record"]), "WARC-Target-URI": row["url"],
                  "WARC-Date": iso_date(row["date"]), "WARC-IP-Address": row["ip"],
                  "WARC-Payload-Digest": f"sha1:{row['payload_digest']}"}
        if row["refers_record"] is None:
            fields["Content-Type"] = "application/http; msgtype=response"
            return warc_record("response", fields, row["head"] + row["payload"])
        page = "-" if row["refers_page"] is None else row["refers_page"]
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": record_id(row["refers_record"]),
                   "X-Refers-To-Page-Id": page, "Content-Type": "application/http; msgtype=response"}
        return warc_record("revisit", fields, row["head"])

    _one_file_each(_archives(records.select(
        "record", "url", "ip", "date", "head", "payload", "payload_digest", "refers_record", "refers_page"),
        opening, entry, archive_bytes), path)


def warc_entries(data: bytes) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """Type, header fields and block of each record of one archive."""
    place = 0
    while place < len(data):
        end = data.index(b"\r\n\r\n", place)
        version, *lines = data[place:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if not version.startswith("WARC/") or len(block) < length:
            raise ValueError("not a whole WARC record")
        yield fields["WARC-Type"], fields, block
        place = end + 4 + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id."""
    def each(columns):
        for content in columns["content"]:
            out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                   "record_id")}
            for kind, fields, block in warc_entries(gzip.decompress(content)):
                if kind not in ("response", "revisit"):
                    continue
                _, http, payload = http_parts(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                out["page_id"].append(_number(http["X-Page-Id"]))
                out["payload_bytes"].append(int(http["Content-Length"]))
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(_number(fields.get("X-Refers-To-Page-Id", "-")))
                out["record_id"].append(fields["WARC-Record-ID"])
            yield out

    return in_batches(_files(spark, path), each,
                      "page_id long, payload_bytes long, payload_digest string, record_type string, "
                      "refers_to long, record_id string")


def convert(spark: SparkSession, arc: str, warc: str, revisit_from: int = 0) -> None:
    """WARC archives at `warc` from all ARC archives below `arc`."""
    digests = staged(read_arc(spark, arc, payloads=False)
                     .select("record", "page_id", "payload_bytes", "same"))
    again = staged(revisits(digests, revisit_from))
    write_warc(read_arc(spark, arc).join(again, "record", "left"), warc)


def archived_pages(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Pages to ARC archives of both versions, to WARC archives, and back to one row per page."""
    spark = pages.sparkSession
    at = scratch(spark)
    numbered = (pages.select(F.col("page_id").cast("long"), "url", "html")
                .withColumn("record", F.monotonically_increasing_id()))
    write_arc(numbered, f"{at}/arc")
    convert(spark, f"{at}/arc", f"{at}/warc", revisit_from)
    return read_warc(spark, f"{at}/warc").drop("record_id")
