"""WARC archives: writing, and reading record by record.

Each record is a gzip member of its own. A reader goes through an archive in small steps: it decompresses one
member, frames the record's block by its content length, verifies the digests and goes on behind the member.
Archives are written by Spark's text writer: a member's last byte is the highest byte of its length, which is
zero below 16 MiB, so members without that byte, ended by a zero byte as line separator, make up the archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import HOT_SHARE, SMALL, col, spread_lookup
from hourgrid.session import materialise, scratch

#: Payloads of fewer bytes are stored again rather than referred to.
SHORTEST = 1000
#: Records and payload bytes of one archive; an archive is read as a whole row, so this keeps it small.
RECORDS = 1000
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {url}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def write_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                 refers_url: str | None = None, revisit: bool = False) -> bytes:
    """One gzip member: the response with its payload, or a revisit with the HTTP head only."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(key, url)), ("WARC-Date", DATE),
            ("WARC-Target-URI", None if url is None else _clean(url)), ("X-Page-ID", key),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _sha1(payload)),
            ("WARC-Block-Digest", _sha1(block))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, refers_url)), ("X-Refers-To-Page-ID", refers_to)]
    head.append(("Content-Length", len(block)))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head if value is not None)
    return _member(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n")


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


def _parse(data: bytes, end_of_member: bool) -> Record:
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record where one should begin")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n" or not end_of_member:
        raise ValueError(f"{headers.get('WARC-Record-ID')}: the block does not have its content length")
    record = Record(headers, rest[:length])
    if headers["WARC-Block-Digest"] != _sha1(record.block):
        raise ValueError(f"{headers['WARC-Record-ID']}: block digest")
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != _sha1(record.payload()):
        raise ValueError(f"{headers['WARC-Record-ID']}: payload digest")
    return record


def read_records(archive: bytes) -> Iterator[Record]:
    """The records of an archive in order; raises on anything that is cut off or altered. Empty members are skipped."""
    view, at = memoryview(archive), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            parts.append(unpacker.decompress(view[at:at + STEP]))
            at += min(STEP, len(view) - at)
        at -= len(unpacker.unused_data)
        if data := b"".join(parts):
            yield _parse(data, unpacker.eof)


def _lines():
    """Records as lines: members without their last byte, which the separator gives back."""
    empty = _member(b"")

    def run(key: pd.Series, url: pd.Series, html: pd.Series, kind: pd.Series, to: pd.Series, to_url: pd.Series) -> pd.Series:
        lines = []
        for k, u, text, revisit, t, tu in zip(key.astype(object), url, html, kind, to.astype(object), to_url):
            member = write_record(None if pd.isna(k) else int(k), u, (text or "").encode(), None if pd.isna(t) else int(t), tu, bool(revisit))
            if member[-1]:
                member += empty  # 16 MiB and more
            lines.append(member[:-1])
        return pd.Series(lines, dtype=object)
    return F.pandas_udf(run, "binary")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", shortest: int = SHORTEST,
          archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row of ``pages`` into archives under ``path``.

    An archive has at most ``RECORDS`` records and about ``archive_bytes`` of payload: larger payloads go to archives of their
    own size class with fewer records each. A single payload must stay below the 2 GB that a row may hold. An
    empty table gives no record; further columns are not used.

    Of equal payloads of at least ``shortest`` bytes the row with the largest key is the response and the others
    revisit it (rows that share that key are all responses); smaller ones are all responses. Null html is an
    empty payload, a null URL is left out of the record, a null key never is the largest. Payloads are compared by
    SHA-1 and length and are not shuffled unless there are more than ``SMALL`` groups of equal ones.
    """
    body = F.coalesce(col(pages, html), F.lit(""))
    rows = pages.select(col(pages, key).alias("key"), col(pages, url).alias("url"), body.alias("html"))
    size = F.octet_length("html")
    rows = rows.withColumn("digest", F.when(size >= shortest, F.concat(F.sha1("html"), F.lit(":"), size.cast("string"))))
    groups = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.max(F.struct("key", "url")).alias("first"), F.count("*").alias("times")).where("times > 1")
    groups = materialise(groups, "payloads")
    # size classes: payloads up to 1, 16, 256 shares of an archive, and the rest one by one
    share = max(archive_bytes // RECORDS, 1)
    kind = F.when(size <= share, 0).when(size <= 16 * share, 1).when(size <= 256 * share, 2).otherwise(3)
    kinds = [r[0] for r in rows.select(kind.alias("kind")).distinct().orderBy("kind").collect()]
    firsts = groups.select("digest", F.col("first.key").alias("first"), F.col("first.url").alias("first_url"))
    if groups.count() <= SMALL:
        joined = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        hot = groups.where(F.col("times") * HOT_SHARE > pages.count()).select("digest")
        # only rows with a digest can have a twin; the others stay where they are
        twins = spread_lookup(rows.where(F.col("digest").isNotNull()), firsts, "digest", hot, F.col("key"))
        joined = twins.unionByName(rows.where(F.col("digest").isNull()), allowMissingColumns=True)
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key"))
    line = _lines()("key", "url", "html", revisit, F.col("first").cast("long"), F.col("first_url"))
    for k in kinds or [0]:
        records = (RECORDS, max(RECORDS // 16, 1), max(RECORDS // 256, 1), 1)[k]
        joined.where(kind == k).select(line.cast("string").alias("value")).write.mode("append").option("lineSep", "\0").option(
            "maxRecordsPerFile", records).text(path)


READ = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def read(spark, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path`` (columns ``READ``); digests are verified, damage raises.

    A revisit has the digest and length of the payload it refers to and a null ``payload``. ``payloads=False`` leaves
    the column null for all.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for record in read_records(content):
                    h = record.headers
                    response = h["WARC-Type"] == "response"
                    http = dict(line.split(": ", 1) for line in record.block.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:])
                    rows.append((_int(h.get("X-Page-ID")), h.get("WARC-Target-URI"), h["WARC-Type"], _int(h.get("X-Refers-To-Page-ID")),
                                 base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
                                 len(record.payload()) if response else int(http["Content-Length"]),
                                 record.payload() if response and payloads else None))
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(run, READ)


def _int(value: str | None) -> int | None:
    return None if value is None else int(value)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back."""
    path = scratch(pages.sparkSession, "warc")
    write(pages, path, **how)
    return read(pages.sparkSession, path, payloads=False)
