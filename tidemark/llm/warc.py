"""WARC archives: one gzip member per record, written and read in sequence.

The reader decompresses a member as its bytes arrive, frames the block by
Content-Length, and verifies the block's and the payload's digests; it holds a block
only if asked for the payload. Of equal payloads the archive keeps one, as a
response; the others are revisit records that refer to it and hold the HTTP
head alone, whose Content-Length is the payload's.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import SharedFile, one_file_a_task, open_input, shared_dir, written

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 16


class CorruptArchive(ValueError):
    """An archive whose framing or digests don't hold."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:tidemark:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    own = record_id.removeprefix("<urn:tidemark:page:").removesuffix(">")
    return None if own == "null" else int(own)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> bytes:
    """One record as a gzip member: a response, or with refers_to a revisit."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response"
    more = []
    if refers_to is not None:
        kind = "revisit"
        more = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    else:
        block += payload
    if url is not None:
        more.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    head = "\r\n".join([
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}", *more,
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ])
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join((c.compress(head.encode()), c.compress(block), c.compress(b"\r\n\r\n"), c.flush()))


@dataclass
class Record:
    headers: dict[str, str]
    payload_bytes: int
    payload: bytes | None


class _Member:
    """The decompressed bytes of one gzip member, as they are asked for."""

    def __init__(self, stream, before: bytes, uri: str):
        self.stream, self.uri, self.raw = stream, uri, before
        self.z, self.ready = zlib.decompressobj(31), b""

    def fill(self) -> bool:
        """More bytes, if the member has any."""
        while not self.z.eof:
            raw = self.z.unconsumed_tail or self.raw or self.stream.read(READ)
            self.raw = b""
            if not raw:
                raise CorruptArchive(f"{self.uri}: cut off within a record")
            try:
                got = self.z.decompress(raw, READ * 4)
            except zlib.error as e:
                raise CorruptArchive(f"{self.uri}: {e}") from e
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        start = 0
        while (i := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark))
            if len(self.ready) > most or not self.fill():
                raise CorruptArchive(f"{self.uri}: a record's head doesn't end")
        out, self.ready = self.ready[:i], self.ready[i + len(mark) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.fill():
                raise CorruptArchive(f"{self.uri}: a block is shorter than its Content-Length")
            part, self.ready = self.ready[:n], self.ready[n:]
            n -= len(part)
            yield part

    def end(self) -> bytes:
        """What follows the member in the file."""
        while self.fill():
            pass
        if self.ready != b"\r\n\r\n":
            raise CorruptArchive(f"{self.uri}: a record doesn't end where its Content-Length says")
        return self.z.unused_data


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in text.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_archive(uri: str, keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive in order, digests verified."""
    with open_input(uri) as stream:
        rest = stream.read(READ)
        while rest:
            m = _Member(stream, rest, uri)
            head = m.until(b"\r\n\r\n")
            if not head.startswith(b"WARC/1."):
                raise CorruptArchive(f"{uri}: not a WARC record")
            headers = _headers(head)
            whole, payload, kept, http, size = hashlib.sha1(), hashlib.sha1(), [], b"", 0
            inside = False
            for part in m.take(int(headers["content-length"])):
                whole.update(part)
                if not inside:
                    http += part
                    if (i := http.find(b"\r\n\r\n")) < 0:
                        continue
                    http, part, inside = http[:i], http[i + 4 :], True
                payload.update(part)
                size += len(part)
                if keep_payload:
                    kept.append(part)
            response = headers["warc-type"] == "response"
            told = int(_headers(http)["content-length"])
            for name, is_so in (("warc-block-digest", whole), ("warc-payload-digest", payload if response else None)):
                if is_so and headers[name] != "sha1:" + base64.b32encode(is_so.digest()).decode():
                    raise CorruptArchive(f"{uri}: {headers['warc-record-id']}: wrong {name}")
            if response and size != told:
                raise CorruptArchive(f"{uri}: {headers['warc-record-id']}: a payload of {size} bytes, not {told}")
            yield Record(headers, told, b"".join(kept) if keep_payload and response else None)
            rest = m.end() or stream.read(READ)


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, archive_bytes: int = 128 << 20, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives; returns the manifest, a table (uri, records, bytes).

    Payload digests are grouped before any page moves: only the digests that
    occur more than once, each with its largest page id, meet the pages again.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("__id"), F.col(url_col).cast("string").alias("__url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"))
    rows = rows.withColumn("__sha", F.sha1(F.col("__html").cast("binary")))
    several = rows.where(F.octet_length("__html") >= min_revisit_bytes).groupBy("__sha").agg(F.max("__id").alias("__keeps"), F.count("*").alias("__n"))
    several = written(several.where("__n > 1 and __keeps is not null").select("__sha", "__keeps"), "several")
    refers = F.when(F.col("__id").eqNullSafe(F.col("__keeps")), None).otherwise(F.col("__keeps"))
    dealt = rows.join(several, "__sha", "left").select("__id", "__url", "__html", refers.alias("__refers"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        schema = pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        out, count = None, 0
        for b in batches:
            for page, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out, count = SharedFile(folder, f"part-{part:06d}.warc.gz"), 0
                out.write(record(page, url, html.encode("utf-8", "surrogatepass"), refers_to))
                count += 1
                if out.size >= archive_bytes:
                    yield pa.RecordBatch.from_pylist([{"uri": out.commit(), "records": count, "bytes": out.size}], schema=schema)
                    out = None
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"uri": out.commit(), "records": count, "bytes": out.size}], schema=schema)

    return written(dealt.mapInArrow(run, "uri string, records bigint, bytes bigint"), "manifest")


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of the manifest's records."""

    def run(batches):
        import pyarrow as pa

        columns = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        schema = pa.schema(columns + [("payload", pa.binary())] * keep_payload)
        for b in batches:
            for uri, records in zip(*(c.to_pylist() for c in b.columns)):
                rows, held, read = [], 0, 0
                for r in read_archive(uri, keep_payload):
                    h = r.headers
                    refers = h.get("warc-refers-to")
                    rows.append((_page_id(h["warc-record-id"]), h.get("warc-target-uri"), r.payload_bytes, h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"], refers and _page_id(refers), *[r.payload] * keep_payload))
                    held, read = held + len(r.payload or b""), read + 1
                    if len(rows) == 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if read != records:
                    raise CorruptArchive(f"{uri}: {read} records, not {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return one_file_a_task(manifest.select("uri", "records"), "uri").mapInArrow(run, kinds + ", payload binary" * keep_payload)


def checked_revisits(records: DataFrame) -> DataFrame:
    """records (as read, a table), of which every revisit is held against the response that it refers to: one of that page, digest and size must be there."""
    there = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct().withColumn("__there", F.lit(True))
    rows = records.join(there, ["refers_to", "payload_digest", "payload_bytes"], "left")
    lost = F.raise_error(F.concat(F.lit("CorruptArchive: no response for the revisit of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    kind = F.when((F.col("record_type") == "revisit") & F.col("__there").isNull(), lost.cast("string")).otherwise(F.col("record_type"))
    return rows.withColumn("record_type", kind).select(*records.columns)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row of pages, read from archives written below the shared folder.

    A null html is an empty payload, a null url leaves the record without a
    target. Rows with a null page id never hold a payload for others; rows
    that repeat the largest page id of equal payloads are all responses. An
    empty table writes nothing and gives an empty result. Other columns are
    ignored. A revisit whose response isn't in the archives is an error.
    """
    manifest = write_archives(pages, f"{shared_dir(pages.sparkSession)}/archives", min_revisit_bytes)
    return checked_revisits(written(read_archives(manifest).drop("url"), "records"))
