"""Compact shuffles of hashed keys: what many documents emit for a partition travels as a few byte strings.

A mapper turns a chunk of documents into (key, document) rows; the rows of each target partition become one Spark row:
the low bytes of the keys, a small value for each, and per document a count and a fixed-width record. Spark deals these
rows by partition number, so all rows of a key meet in one task, as flat numpy arrays. A partition's size is the total
over the number of partitions, which `number_of_parts` sets by the data.

Replies to documents travel in the same form, dealt by document, their values in place of the keys and without flags:
a row for each pair of partitions, not for each document. Those that a mapper can give by itself go with its keys and
pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.shared import arrow_schema
from docloom.llm.wordflow import mixed

BLOCKS = "part int, keys binary, flags binary, counts binary, records binary"
#: Keys of a partition, about. Fewer and fuller partitions than the session's: a document's record goes to each of them.
PART_KEYS, LEAST_PARTS = 3_000_000, 8
KEY_BYTES = 5


def fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a byte matrix as binary values."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def packed(keys: np.ndarray, flags: np.ndarray | None, docs: np.ndarray, records: np.ndarray, parts: int, key_bytes: int = KEY_BYTES, part: np.ndarray | None = None) -> dict[str, list]:
    """Columns of BLOCKS for key rows; `docs` gives each row's line of `records`, whose rows come in order. `part`: where to, if the key doesn't say; keys can then be a byte matrix."""
    part = (keys >> np.uint64(40)) % np.uint64(parts) if part is None else part
    order = np.argsort(part.astype(np.uint16 if parts < 1 << 16 else np.uint32), kind="stable")
    part, docs = part[order].astype(np.int64), docs[order]
    low = (keys[order] if keys.ndim == 2 else np.ascontiguousarray(keys[order].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :key_bytes]).tobytes()
    small, wide = (flags[order].tobytes(), flags.itemsize) if flags is not None else (b"", 0)
    run = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (docs[1:] != docs[:-1])]) if len(part) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[run, len(part)]).astype("<u4").tobytes()
    own, width = records[docs[run]].tobytes(), records.shape[1]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    ends, runs = np.r_[first, len(part)].tolist(), np.searchsorted(run, np.r_[first, len(part)]).tolist()
    spans = list(zip(ends, ends[1:], runs, runs[1:]))
    return {
        "part": part[first].tolist(),
        "keys": [low[key_bytes * a : key_bytes * b] for a, b, _, _ in spans],
        "flags": [small[wide * a : wide * b] for a, b, _, _ in spans],
        "counts": [counts[4 * a : 4 * b] for _, _, a, b in spans],
        "records": [own[width * a : width * b] for _, _, a, b in spans],
    }


def replies(values: np.ndarray, docs: np.ndarray, records: np.ndarray, parts: int, width: int) -> dict[str, list]:
    """Columns of BLOCKS that tell documents values of `width` bytes (integers, or rows of a byte matrix)."""
    order = np.argsort(docs, kind="stable")
    lead = np.ascontiguousarray(records[:, :8]).view("<u8").ravel()
    to = mixed(lead) % np.uint64(parts)
    return packed(values[order] if values.ndim == 2 else values[order].astype(np.uint64), None, docs[order], records, parts, width, to[docs[order]])


def both(a: dict[str, list], b: dict[str, list]) -> dict[str, list]:
    return {c: a[c] + b[c] for c in a}


def unpacked(got: dict[str, list[bytes]], width: int, kind: str, key_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, flags, docs, records) of a task's rows; keys of over 8 bytes stay a byte matrix."""
    low = np.frombuffer(b"".join(got["keys"]), np.uint8).reshape(-1, key_bytes)
    if key_bytes <= 8:
        eight = np.zeros((len(low), 8), np.uint8)
        eight[:, :key_bytes] = low
        low = eight.view("<u8").ravel()
    counts = np.frombuffer(b"".join(got["counts"]), "<u4")
    records = np.frombuffer(b"".join(got["records"]), np.uint8).reshape(-1, width)
    return low, np.frombuffer(b"".join(got["flags"]), kind), np.repeat(np.arange(len(counts)), counts), records


def number_of_parts(keys: int) -> int:
    return max(LEAST_PARTS, -(-keys // PART_KEYS))


def meet(blocks: DataFrame, parts: int, width: int, fn: Callable[..., dict | None], schema: str, kind: str = "u1", key_bytes: int = KEY_BYTES, forward: bool = False) -> DataFrame:
    """`fn(keys, flags, docs, records)` in each partition; it returns the columns of its result. With `forward`, replies among the blocks pass through."""
    struct = T.StructType.fromDDL(schema)
    target = arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[bytes]] = {c: [] for c in ("keys", "flags", "counts", "records")}
        for rows in batches:
            if forward:
                own = pc.greater(pc.binary_length(rows.column("flags")), 0)
                yield rows.filter(pc.invert(own))
                rows = rows.filter(own)
            for c, into in got.items():
                into += rows.column(c).to_pylist()
        out = fn(*unpacked(got, width, kind, key_bytes)) if got["keys"] else None
        if out is not None:
            whole = pa.RecordBatch.from_arrays([x if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in target], schema=target)
            for a in range(0, whole.num_rows, 100_000):
                yield whole.slice(a, 100_000)

    return blocks.repartitionById(parts, F.col("part")).mapInArrow(run, struct)


def node_numbers(records: np.ndarray, width: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(number of each record's leading 16 bytes among the distinct ones, in their order; a record that has each)."""
    two = np.ascontiguousarray(records[:, :width]).view(">u8").reshape(len(records), -1)
    order = np.lexsort((two[:, 1], two[:, 0]))
    new = np.r_[True, (two[order[1:]] != two[order[:-1]]).any(axis=1)] if len(order) else np.zeros(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]
