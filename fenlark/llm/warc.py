"""WARC archives: one gzip member a record, read back in order with incremental decompression."""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, scratch, table

SEGMENT = 2 << 20  # payload bytes in one record; longer payloads continue in further records
ROW, ROWS = 1 << 20, 32  # compressed bytes from which records are handed on, and how often for one file
LEAST = 100  # bytes from which equal payloads are stored once


class WarcError(ValueError):
    pass


def _clean(x: str) -> str:
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in x)


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member. Its last byte is 0, as records are under 16 MB."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))])
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def records_of(page_id, url, payload: bytes, digest: str, refers_to) -> Iterator[bytes]:
    """A revisit without payload, or a response in one record or several segments."""
    uri = f"<urn:page:{'none' if page_id is None else page_id}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url) if url else "urn:none")]
    kind = [("Content-Type", "application/http; msgtype=response")]
    digest = ("WARC-Payload-Digest", f"sha256:{digest}")
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", uri), *common, digest, ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", profile), *kind], http)
        return
    block = http + payload
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    for n, part in enumerate(parts, 1):
        number = [("WARC-Segment-Number", str(n))] if len(parts) > 1 else []
        if n == 1:
            yield record([("WARC-Type", "response"), ("WARC-Record-ID", uri), *common, digest, *number, *kind], part)
        else:
            last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
            yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{uri[:-1]}:{n}>"), ("WARC-Segment-Origin-ID", uri), *common, *number, *last], part)


class _Stream:
    """Decompressed bytes of one gzip member after another, as they are asked for."""

    def __init__(self, file, size: int = 1 << 16):
        self.file, self.size, self.raw, self.out = file, size, b"", b""
        self.z = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.z.eof:
            return False
        self.raw = self.raw or self.file.read(self.size)
        if not self.raw:
            raise WarcError("the archive ends within a record")
        self.out += self.z.decompress(self.raw, self.size)
        self.raw = self.z.unconsumed_tail if not self.z.eof else self.z.unused_data
        return True

    def read(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if not self.out and not self._more():
                raise WarcError("a record is shorter than its content length")
            parts.append(self.out[: n - have])
            self.out = self.out[len(parts[-1]) :]
            have += len(parts[-1])
        return b"".join(parts)

    def until(self, mark: bytes) -> bytes:
        while mark not in self.out:
            if not self._more():
                raise WarcError("a record's head doesn't end")
        head, _, self.out = self.out.partition(mark)
        return head

    def next_member(self) -> bool:
        if self.z.eof:
            if self.out:
                raise WarcError("a member holds more than one record")
            self.z = zlib.decompressobj(31)
        self.raw = self.raw or self.file.read(self.size)
        return bool(self.raw)

    def end(self) -> None:
        """Reads on to the member's end, whose checksum zlib verifies."""
        while not self.z.eof:
            self._more()


def read_warc(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, in order; digests and lengths are verified."""
    s = _Stream(file)
    while s.next_member():
        version, *lines = s.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise WarcError(f"not a record: {version[:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = s.read(int(head["content-length"]))
        if s.read(4) != b"\r\n\r\n":
            raise WarcError("a record doesn't end where its content length says")
        s.end()
        if (digest := head.get("warc-block-digest", "").rpartition(":")[2]) and hashlib.sha256(block).hexdigest() != digest:
            raise WarcError(f"block digest of {head.get('warc-record-id')}")
        yield head, block


def pages_of(file) -> Iterator[dict]:
    """Pages of an archive: segments are joined, payload digests verified, revisits described by their headers."""
    origin, parts = None, []

    def page():
        http, _, payload = b"".join(parts).partition(b"\r\n\r\n")
        length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
        revisit = origin["warc-type"] == "revisit"
        digest = origin["warc-payload-digest"].rpartition(":")[2]
        if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise WarcError(f"payload digest of {origin['warc-record-id']}")
        ids = [None if (x := origin.get(k, "").strip("<>").rpartition(":")[2]) in ("", "none") else int(x) for k in ("warc-record-id", "warc-refers-to")]
        return {"page_id": ids[0], "payload_bytes": length, "payload_digest": digest, "record_type": origin["warc-type"], "refers_to": ids[1], "payload": None if revisit else payload}

    for head, block in read_warc(file):
        if head["warc-type"] in ("response", "revisit"):
            if origin is not None:
                yield page()
            origin, parts = head, [block]
        elif head["warc-type"] == "continuation" and origin is not None and head.get("warc-segment-origin-id") == origin["warc-record-id"]:
            parts.append(block)
    if origin is not None:
        yield page()


def _write(batches):
    """Records as they stand in the files, in rows of ROW bytes and more; all segments of a page are in one."""
    held, size = [], 0
    for batch in chunks(batches, "html", 4 << 20):
        out = []
        for r in batch.to_pylist():
            payload = (r["html"] or "").encode("utf-8", "surrogatepass")
            for m in records_of(r["page_id"], r["url"], payload, r["digest"], r["refers_to"]):
                if m[-1]:
                    raise WarcError("a record of 16 MB or more")
                held.append(m)
                size += len(m)
            if size >= ROW:
                out.append(b"".join(held)[:-1])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["member"])


def write_archives(pages: DataFrame, folder: str, most_rows: int = ROWS) -> None:
    """Writes pages(page_id, url, html) into WARC files of whole gzip members under folder.

    Payloads are html in UTF-8 (null: empty). Of those equal and at least 100 bytes long, the one with
    the smallest page_id is stored; the others become revisits. Rows that repeat that id and payload
    are all stored. Rows without page_id follow the same rule and never come first unless all lack one.
    Shorter payloads are stored as they come and are not shuffled. An empty table gives no records.

    Files go through Spark's text writer, whose committer copes with lost and repeated tasks. It ends
    each row with a separator; that separator is the zero byte which ends each gzip member (the highest
    byte of a length below 16 MB), so the files hold the members and nothing else. A file ends after
    most_rows rows, some 32 to 64 MB unless single pages are larger than a row.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    large, small = pages.where(size >= LEAST), pages.where(size < LEAST).withColumn("refers_to", F.lit(None).cast("long"))
    first = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("digest", "first_id")
    # the right side has a row a digest; a digest with many pages is split by skew handling
    told = large.join(first, "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    columns = ["page_id", "url", "html", "digest", "refers_to"]
    members = told.select(columns).unionByName(small.select(columns)).mapInArrow(_write, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", most_rows).text(folder)


_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches):
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for page in pages_of(io.BytesIO(content.as_py())):
                rows.append({k: v for k, v in page.items() if k != "payload"})
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row a page in the archives under folder; a damaged record fails the job. A folder without
    records gives an empty result. Each file is one task's, and the writer bounds its bytes."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select("content").mapInArrow(_read, _PAGE)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, q.payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM q LEFT JOIN f ON q.payload_digest = f.payload_digest AND payload_bytes >= 100
"""
