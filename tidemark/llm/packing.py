"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Pieces of one length are alike, so the plan is made on the histogram of lengths
(no longer than the capacity, whatever the corpus): lengths above a third of
the capacity are matched greedily, at most two in a bin, each with the longest
partner that fits; shorter ones then best-fit the remaining gaps in decreasing
order. The plan lists, for each length, runs of pieces and the bins that they
go to. A piece finds its run by its rank among the pieces of its length, which
is a count before its partition plus one within it. Nothing but the histogram
and the plan, both bounded by the capacity, passes the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._shared import filesystem, shared_dir, tokenizer_file, written
from .tokens import encoder


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first bin, offset, pieces a bin) that place every piece.

    The pieces of ranks first..first+pieces-1 of this length go to the bins from
    the first on, so many in each, at the offset and behind one another.
    """
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("every length must lie between 1 and the capacity")
    # A group: copies of a bin, as [(length, pieces a bin), ...]. Bins differ by group only.
    groups: dict[int, list[tuple[tuple, int]]] = defaultdict(list)
    gaps: list[int] = []
    done: list[tuple[tuple, int]] = []

    def put(content: tuple, copies: int, gap: int) -> None:
        if copies <= 0:
            return
        if gap == 0:
            done.append((content, copies))
            return
        if not groups[gap]:
            insort(gaps, gap)
        groups[gap].append((content, copies))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        # The longest partner that fits and is left; one piece can't be its own partner.
        i = bisect_left(large, min(capacity - n, n) + 1) - 1
        while i >= 0 and not (left[large[i]] - (large[i] == n)) > 0:
            i -= 1
        if i < 0:
            put(((n, 1),), left[n], capacity - n)
            left[n] = 0
        elif large[i] == n:
            pairs = left[n] // 2
            put(((n, 2),), pairs, capacity - 2 * n)
            left[n] -= 2 * pairs
        else:
            m = large[i]
            pairs = min(left[n], left[m])
            put(((n, 1), (m, 1)), pairs, capacity - n - m)
            left[n] -= pairs
            left[m] -= pairs
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            i = bisect_left(gaps, n)
            if i == len(gaps):
                each = capacity // n
                put(((n, each),), count // each, capacity - each * n)
                rest = count % each
                put(((n, rest),), int(rest > 0), capacity - rest * n)
                count = 0
                break
            gap = gaps[i]
            content, copies = groups[gap].pop()
            if not groups[gap]:
                gaps.pop(i)
            each = gap // n
            full = min(copies, count // each)
            put((*content, (n, each)), full, gap - each * n)
            count -= full * each
            copies -= full
            if copies and count:
                put((*content, (n, count)), 1, gap - count * n)
                copies, count = copies - 1, 0
            put(content, copies, gap)
    runs, ranks, bins = [], Counter(), 0
    for content, copies in done + [x for gap in sorted(groups) for x in groups[gap]]:
        offset = 0
        for n, each in content:
            runs.append((n, ranks[n], copies * each, bins, offset, each))
            ranks[n] += copies * each
            offset += n * each
        bins += copies
    return runs


def tokenized_pieces(docs: DataFrame, definition: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], part, place): the pieces of each document's ids and end id.

    Only documents longer than the capacity are cut; the first piece may be
    shorter, the others are full. part and place are the partition, and the
    count of earlier pieces of that length in it.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), Counter()
        enc = encoder(shared.value)
        end = np.array([end_id], "<u4")
        for b in batches:
            ids_of, rows = b.column(0).to_pylist(), []
            for doc, packed in zip(ids_of, enc.encode(b.column(1).to_pylist())):
                ids = np.concatenate([np.frombuffer(packed, enc.dtype).astype("<u4"), end])
                start, size = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while start < len(ids):
                    own = ids[start : start + size].tobytes()
                    rows.append((doc, piece, start, size, zlib.crc32(own), *([ids[start : start + size].astype(enc.dtype).tobytes()] if keep_ids else []), part, seen[size]))
                    seen[size] += 1
                    start, size, piece = start + size, capacity, piece + 1
            if rows:
                cols = list(zip(*rows))
                types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if keep_ids else []), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "part", "place"]
    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, {'ids binary, ' if keep_ids else ''}part int, place bigint"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _bases(folder: str, part: int, capacity: int) -> np.ndarray:
    """By length, how many pieces of it lie in the parts before this one."""
    fs, path = filesystem(f"{folder}/part={part}")
    own = ds.dataset(path, filesystem=fs, format="parquet").to_table(columns=["length", "base"])
    out = np.zeros(capacity + 1, np.int64)
    out[own.column("length").to_numpy()] = own.column("base").to_numpy()
    return out


def placed(pieces: DataFrame, capacity: int) -> DataFrame:
    """pieces (a table with length, part, place) with sequence_id and offset instead of part and place.

    Pieces stay where they are: the counts before each part, a row a length,
    lie in a folder of its own, which the tasks that hold its pieces read.
    """
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 6)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    folder = f"{shared_dir(pieces.sparkSession)}/bases"
    counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("base")).repartition("part").write.partitionBy("part").parquet(folder)
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    kept = [f for f in pieces.schema.fields if f.name not in ("part", "place")]
    at = [f.name for f in kept].index("ids") if "ids" in pieces.columns else None

    def run(batches):
        t, known = shared.value, {}
        for b in batches:
            if not b.num_rows:
                continue
            n, part = b.column("length").to_numpy(), b.column("part").to_numpy()
            rank = b.column("place").to_numpy().copy()
            for p in np.unique(part).tolist():
                if p not in known:
                    if len(known) == 64:
                        known.clear()
                    known[p] = _bases(folder, p, capacity)
                rank[part == p] += known[p][n[part == p]]
            # Runs are sorted by length and first rank; both fit one key.
            wide = int(t[:, 1].max()) + int(rank.max()) + 2
            i = np.searchsorted(t[:, 0] * wide + t[:, 1], n * wide + rank, side="right") - 1
            beyond = rank - t[i, 1]
            columns = [b.column(f.name) for f in kept]
            if at is not None:
                columns[at] = pa.array((_wide(x.as_py(), m) for x, m in zip(columns[at], n.tolist())), pa.binary())
            columns += [pa.array(t[i, 3] + beyond // t[i, 5]), pa.array(t[i, 4] + beyond % t[i, 5] * n)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "sequence_id", "offset"])

    return pieces.mapInArrow(run, StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def _wide(ids: bytes, count: int) -> bytes:
    """Token ids of any width as unsigned 32-bit integers."""
    return np.frombuffer(ids, f"<u{len(ids) // count}").astype("<u4").tobytes()


def packed(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset): one row per piece of each row of docs.

    A null text is empty: its only id is the end id. Repeated rows and null
    ids are documents of their own. An empty table gives an empty result.
    Other columns are ignored. tokenizer is the path of a tokenizer's file.
    """
    with open(tokenizer or tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    return placed(written(tokenized_pieces(docs, definition, capacity, end_id, id_col, text_col, keep_ids), "pieces"), capacity)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from pieces with ids; a sequence has no more than its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
