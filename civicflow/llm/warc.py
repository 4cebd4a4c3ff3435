"""WARC archives: written with revisit records, read back by a reader that salvages.

Archives are written by Spark's own text writer, so they reach any store Spark writes to: each
record is one gzip member, and the line separator of the writer is the NUL byte that a member's
length field ends with. They are read as binary files.

The reader checks every member (gzip checksum, version line, content length, block digest). After
a failed check it looks for the next place where a member begins and passes the checks, or in plain
archives for the next version line, goes on there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 1000
# A reader holds one archive at a time.
ARCHIVE_RECORDS = 20_000
# Stored bytes of pages below which partitions share an archive.
ARCHIVE_BYTES = 4 << 20
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
# Longer numbers are no lengths of anything.
LENGTH = re.compile("[0-9]{1,18}")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

_FOUND = "file string, start long, end long, problem string, headers map<string,string>, block binary"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """A gzip member that ends with a NUL byte, without that byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    if member[-1]:
        # Over 16 MB the length field ends otherwise; an empty member follows and ends it.
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member += packer.flush()
    return member[:-1]


def _name(key: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {url}')}>"


def _line(value: str | None) -> str:
    """A value that fits into one header line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value or "").strip()


def _write_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            members = []
            for row in batch.slice(at, 64).to_pylist():
                payload, url = (row["html"] or "").encode(), _line(row["url"])
                headers = [
                    ("WARC-Record-ID", _name(row["page_id"], row["url"])),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", url),
                    ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("X-Page-Id", "" if row["page_id"] is None else str(row["page_id"])),
                ]
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                if row["refers_to"] is None:
                    record = _record("response", headers, block.encode() + payload)
                else:
                    headers.append(("WARC-Profile", REVISIT_PROFILE))
                    headers.append(("WARC-Refers-To", _name(row["refers_to"], row["refers_url"])))
                    headers.append(("X-Refers-To-Page-Id", str(row["refers_to"])))
                    record = _record("revisit", headers, block.encode())
                members.append(_member(record))
            yield pa.record_batch([pa.array(members, pa.binary())], names=["member"])


def _most_archives(pages: DataFrame) -> int | None:
    """How many tasks ``pages`` are worth: two for each core, or more by their stored size; None if
    that is unknown."""
    spark = pages.sparkSession
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    leaves = pages._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if not sizes or max(sizes) >= unknown:
        return None
    return max(2 * spark.sparkContext.defaultParallelism, sum(sizes) // ARCHIVE_BYTES + 1)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html; other columns are ignored) as archives to ``path``.

    A null html is an empty payload. Of pages with the same payload of at least 1000 bytes the one
    with the largest page_id holds it, the others refer to that one; payloads are equal when their
    SHA-1 and SHA-256 digests and lengths are. Rows with the same page_id all hold their payload if
    one does; a row without page_id always holds its own. An empty table gives an empty folder.
    There are no more archives than the pages' stored size calls for, however many partitions the
    session makes.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html).alias("digest"))
    keys = pages.where((F.octet_length("html") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull()).select(
        "page_id", F.struct("digest", F.sha2("html", 256).alias("second"), F.octet_length("html").alias("n")).alias("payload"), "url"
    )
    holders = keys.groupBy("payload").agg(
        F.max(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("holder"),
        F.min("page_id").alias("least"),
    )
    holders = holders.where("least < holder.page_id").drop("least")
    revisits = keys.select("page_id", "payload").join(holders, "payload").where("page_id < holder.page_id")
    # Pages that hold something else under the same id are told apart by their digest.
    revisits = revisits.select(
        "page_id", F.col("payload.digest").alias("digest"), F.col("holder.page_id").alias("refers_to"), F.col("holder.url").alias("refers_url")
    ).distinct()
    rows = pages.join(revisits, ["page_id", "digest"], "left")
    rows = rows.select("page_id", "url", "html", "digest", "refers_to", "refers_url")
    # A file costs its folder, its checksum and, on local disks, a process for the mode of each; a
    # process that is just being started counts as another copy of its executor.
    most = _most_archives(pages)
    rows = rows.coalesce(most) if most else rows
    members = rows.mapInArrow(_write_members, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)


def _parse(record: bytes) -> tuple[dict[str, str], bytes] | str:
    """Headers and block of one record, or what is wrong with it."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version = VERSION.match(head + b"\r\n")
    if not version or not blank:
        return "no version line"
    headers = {}
    for line in head[version.end() :].split(b"\r\n"):
        name, _, value = (part.strip().decode("utf-8", "replace") for part in line.partition(b":"))
        # Headers that come several times keep all their values.
        headers[name.lower()] = f"{headers[name.lower()]}, {value}" if name.lower() in headers else value
    if not LENGTH.fullmatch(headers.get("content-length", "")):
        return "no content length"
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        return "content length does not fit"
    algorithm, _, digest = headers.get("warc-block-digest", "").partition(":")
    if algorithm.lower() == "sha1" and digest.upper() != base64.b32encode(hashlib.sha1(block).digest()).decode():
        return "block digest differs"
    return headers, block


def _inflate(data: memoryview, at: int) -> tuple[bytes, int] | str:
    """The content of the member that begins at ``at`` and where it ends, or what is wrong."""
    if data[at : at + 3] != MEMBER:
        return "no member"
    unpacker, out = zlib.decompressobj(31), []
    try:
        while at < len(data) and not unpacker.eof:
            part = data[at : at + 65536]
            out.append(unpacker.decompress(part))
            at += len(part)
    except zlib.error:
        return "member is damaged"
    return (b"".join(out), at - len(unpacker.unused_data)) if unpacker.eof else "member is cut off"


def _gzip_records(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes | None, str | None]]:
    """(start, end, headers, block, problem) of what a compressed archive holds, in order."""
    view, at, gap, problem = memoryview(data), 0, None, None
    while 0 <= at < len(data):
        found = _inflate(view, at)
        end, record = at, None
        if not isinstance(found, str):
            content, end = found
            record = found = _parse(content) if content else ({}, b"")
            if isinstance(record, str) and (several := [r for r in _plain_records(content) if r[2]]):
                # Several records in one member: they all lie where the member does.
                if gap is not None:
                    yield gap, at, None, None, problem
                    gap = None
                yield from ((at, end, *r[2:]) for r in several)
                missing = len(content) - sum(r[1] - r[0] for r in several)
                if missing:
                    yield at, end, None, None, f"{missing} bytes of the member's content: {record}"
                at = end
                continue
        if isinstance(found, str):
            if gap is None:
                gap, problem = at, found
            # The next member may begin inside what looked like this one.
            at = data.find(MEMBER, at + 1)
            continue
        if gap is not None:
            yield gap, at, None, None, problem
            gap = None
        if record[0]:
            yield at, end, *record, None
        at = end
    if gap is not None:
        yield gap, len(data), None, None, problem


def _plain_records(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes | None, str | None]]:
    """The same of an archive that is not compressed."""
    at, gap, problem = 0, None, None
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        length = re.search(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", data[at : head + 2], re.I) if head >= 0 else None
        found: tuple | str = "no version line"
        end = at
        if VERSION.match(data, at):
            found = "no content length"
            if VERSION.search(data, at + 1, max(head, at)):
                found = "headers are cut off"  # those of the next record follow
            elif length:
                end = head + 4 + int(length[1]) + 4
                found = _parse(data[at:end])
        if isinstance(found, tuple):
            if gap is not None:
                yield gap, at, None, None, problem
                gap = None
            yield at, end, *found, None
            at = end
            continue
        if gap is None:
            gap, problem = at, found
        following = VERSION.search(data, at + 1)
        if not following:
            break
        at = following.start()
    if gap is not None:
        yield gap, len(data), None, None, problem


def records_in(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes | None, str | None]]:
    """Records and gaps of one archive. It counts as compressed where a member comes before the
    first version line."""
    member, version = data.find(MEMBER), VERSION.search(data)
    plain = version is not None and (member < 0 or version.start() < member)
    return _plain_records(data) if plain else _gzip_records(data)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = ["file", "start", "end", "problem", "headers", "block"]

    def batch_of(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            file, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            rows, size = [], 0
            for start, end, headers, block, problem in records_in(data):
                rows.append((file, start, end, problem, list(headers.items()) if headers else None, block))
                size += len(block or b"")
                if size > 1 << 22:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives in ``path``: file, start, end, problem, headers (names in
    lower case; values of repeated ones are joined by commas), block. A gap has a problem and no headers;
    a record has headers and no problem. Records of a member that holds several have its place; what
    is damaged inside it is a gap of the same place. Empty files have neither."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read_files, _FOUND)


def pages_of(found: DataFrame) -> DataFrame:
    """Pages that records describe: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null where another record holds it)."""
    kind = F.col("headers")["warc-type"]
    blank = "instr(decode({}, 'ISO-8859-1'), '\\r\\n\\r\\n')"
    short = F.expr(blank.format("substring(block, 1, 4096)"))
    head = F.when(short > 0, short).otherwise(F.expr(blank.format("block")))
    payload = F.when(kind == "response", F.expr("substring(block, head + 4)")).alias("payload")
    told = F.regexp_extract(F.expr("decode(substring(block, 1, head + 3), 'ISO-8859-1')"), r"(?i)\r\ncontent-length:[ \t]*(\d+)", 1)
    told_digest = F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "")
    records = found.where(kind.isin("response", "revisit")).withColumn("head", head)
    return records.withColumn("payload", payload).select(
        F.expr("try_cast(headers['x-page-id'] as bigint)").alias("page_id"),
        F.col("headers")["warc-target-uri"].alias("url"),
        F.when(kind == "response", F.octet_length("payload")).otherwise(told).cast("long").alias("payload_bytes"),
        F.when(kind == "response", F.sha1("payload")).otherwise(told_digest).alias("payload_digest"),
        kind.alias("record_type"),
        F.expr("try_cast(headers['x-refers-to-page-id'] as bigint)").alias("refers_to"),
        "payload",
    )
