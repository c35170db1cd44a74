"""Token ids as length-delimited binary records, with an offset index beside each file.

A file begins with MAGIC and the width of an id in bytes. A record is the
payload's length (8 bytes), that field's masked checksum (4), the payload and its
masked checksum (4); all little-endian. A payload is a byte that tells whether the
document has an id, that id (8 bytes, signed), and the token ids. The
index holds each record's offset (8 bytes), in order, so readers can go through
the records in any order.

The checksum is zlib's CRC-32, masked by a rotation by 15 bits and a constant so
that a checksum of data that holds checksums keeps its strength.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import SharedFile, filesystem, one_file_a_task, open_input, shared_dir, tokenizer_file, written
from .tokens import encoder

MAGIC = b"TMREC001"
MASK = 0xA282EAD8
FLUSH = 1 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


class CorruptRecord(ValueError):
    """A record whose checksum or framing doesn't hold."""


def _read(stream, n: int, uri: str, at: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise CorruptRecord(f"{uri}: cut off at {at}")
    return data


def _one(stream, uri: str, at: int) -> bytes | None:
    """The payload of the record at the stream's place; None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) != 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise CorruptRecord(f"{uri}: bad length at {at}")
    n = struct.unpack("<Q", head[:8])[0]
    payload = _read(stream, n, uri, at)
    if struct.unpack("<I", _read(stream, 4, uri, at))[0] != masked(payload):
        raise CorruptRecord(f"{uri}: bad payload at {at}")
    return payload


def _start(stream, uri: str) -> np.dtype:
    head = _read(stream, len(MAGIC) + 1, uri, 0)
    if head[:-1] != MAGIC or head[-1] not in (2, 4):
        raise CorruptRecord(f"{uri}: not a record file")
    return np.dtype(f"<u{head[-1]}")


def _parsed(payload: bytes, dtype: np.dtype) -> tuple[int | None, np.ndarray]:
    there, doc = struct.unpack_from("<Bq", payload)
    return doc if there else None, np.frombuffer(payload, dtype, offset=9)


def read_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, token ids) of each record, in order, checksums verified."""
    with open_input(uri) as stream:
        dtype, at = _start(stream, uri), len(MAGIC) + 1
        while (payload := _one(stream, uri, at)) is not None:
            yield _parsed(payload, dtype)
            at += 16 + len(payload)


def read_shuffled(uri: str, index_uri: str, seed: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """The same records in an order that the seed decides, found by the index."""
    with open_input(index_uri) as stream:
        offsets = np.frombuffer(stream.read(), "<u8").tolist()
    random.Random(seed).shuffle(offsets)
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as stream:
        dtype = _start(stream, uri)
        for at in offsets:
            stream.seek(at)
            payload = _one(stream, uri, at)
            if payload is None:
                raise CorruptRecord(f"{uri}: no record at {at}")
            yield _parsed(payload, dtype)


def _bounds(rows: DataFrame, file_bytes: int) -> tuple[np.ndarray, int]:
    """(the last id of each file but the last, files of null ids before them), for files of about so many bytes of text.

    Ids of equal shares of the rows; an id that holds more than a share is there as often as it needs files.
    """
    null = F.col("__id").isNull()
    size = F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long") + 16
    total = rows.agg(F.coalesce(F.sum(F.when(null, size)), F.lit(0)).alias("none"), F.coalesce(F.sum(F.when(~null, size)), F.lit(0)).alias("some")).first()
    files = -(-total["some"] // file_bytes)
    share = [i / files for i in range(1, files)]
    bounds = rows.where(~null).select("__id").approxQuantile("__id", share, max(1 / (4 * files), 1e-4)) if share else []
    return np.array(bounds, np.int64), -(-total["none"] // file_bytes)


def _places(ids, tokens, bounds: np.ndarray, none: int) -> np.ndarray:
    """The file of each row (Arrow columns of ids and tokens); what one id or no id leaves open its tokens' checksum decides."""
    there = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy()
    low, high = np.searchsorted(bounds, values, "left"), np.searchsorted(bounds, values, "right")
    ways = np.where(there, np.maximum(high - low, 1), max(none, 1))
    mixed = np.array([zlib.crc32(t) for t in tokens], np.int64)
    return np.where(there, none + low, 0) + mixed % ways


def write_records(docs: DataFrame, folder: str, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 1 << 25) -> DataFrame:
    """Writes the files; returns the manifest, a table (part, uri, index_uri, docs, ids, bytes).

    Files, and records within them, ascend by document id (null ids first; of
    rows with one id those with less tokens' bytes first, within a file). Texts are
    encoded where they are read; token ids, not texts, are shuffled to the files. Only
    files of tasks that ended well are named by the manifest. file_bytes is the size of a file's texts.
    """
    with open(tokenizer or tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    bounds, none = _bounds(rows, file_bytes)

    def encoded(batches):
        import pyarrow as pa

        enc = encoder(shared.value)
        for b in batches:
            tokens = list(enc.encode(b.column(1).to_pylist()))
            part = _places(b.column(0), tokens, bounds, none)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens, pa.binary()), pa.array(part, pa.int32())], names=["id", "tokens", "part"])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, dtype = TaskContext.get().partitionId(), encoder(shared.value).dtype
        out, index, count, total, buffer = None, [], 0, 0, []
        end, width = np.array([end_id], dtype).tobytes(), dtype.itemsize
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if out is None:
                    out = SharedFile(folder, f"part-{part:06d}.records")
                    buffer, pending = [MAGIC, bytes([width])], len(MAGIC) + 1
                index.append(out.size + pending)
                buffer.append(framed(struct.pack("<Bq", doc is not None, doc or 0) + ids + end))
                pending += len(buffer[-1])
                count, total = count + 1, total + len(ids) // width + 1
                if pending >= FLUSH:
                    out.write(b"".join(buffer))
                    buffer, pending = [], 0
        if out is None:
            return
        out.write(b"".join(buffer))
        offsets = SharedFile(folder, f"part-{part:06d}.index")
        offsets.write(np.array(index, "<u8").tobytes())
        row = {"part": part, "uri": out.commit(), "index_uri": offsets.commit(), "docs": count, "ids": total, "bytes": out.size}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("uri", pa.string()), ("index_uri", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]))

    tokens = rows.mapInArrow(encoded, "id bigint, tokens binary, part int")
    ordered = tokens.repartitionById(len(bounds) + 1 + none, F.col("part")).sortWithinPartitions("id", "tokens").select("id", "tokens")
    return written(ordered.mapInArrow(run, "part int, uri string, index_uri string, docs bigint, ids bigint, bytes bigint"), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the records of the manifest's files; start is the count of all ids before."""
    return _read_with(manifest, "ids array<int>", lambda ids: ids.tolist())


def _read_with(manifest: DataFrame, column: str, value) -> DataFrame:
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("uri", "docs", F.coalesce(before, F.lit(0)).alias("first"))
    name = column.split()[0]

    def run(batches):
        import pyarrow as pa

        kind = pa.int64() if name == "ids_crc32" else pa.list_(pa.int32())
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])
        for b in batches:
            for uri, docs, start in zip(*(c.to_pylist() for c in b.columns)):
                rows, read = [], 0
                for doc, ids in read_file(uri):
                    rows.append((doc, start, len(ids), value(ids)))
                    start, read = start + len(ids), read + 1
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if read != docs:
                    raise CorruptRecord(f"{uri}: {read} records, not {docs}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return one_file_a_task(files, "uri").mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {column}")


def record_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: the CRC-32 is of the ids as little-endian unsigned 32-bit integers."""
    return _read_with(manifest, "ids_crc32 bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def round_trip(docs: DataFrame, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """record_digests of docs' rows, written below the shared folder and read back.

    A null text counts as empty: the end id alone. Null ids come first;
    repeated rows are records of their own. An empty table writes no file and
    gives an empty result. Other columns are ignored.
    """
    return record_digests(write_records(docs, f"{shared_dir(docs.sparkSession)}/records", end_id, tokenizer, id_col, text_col))
