"""Small helpers that several operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = rb"[\x20\x09-\x0D]"


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text): other columns, whatever their names, never meet an operator's own."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def lean(spark: SparkSession) -> SparkSession:
    """The session, with batches to Python workers cut to 1,000 rows: texts are long, and ten thousand of
    them at once are held three times over (JVM, Arrow, worker)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def drop_shuffles(spark: SparkSession) -> None:
    """Ask the driver for a garbage collection: only then are the shuffle files of finished steps deleted, which
    a job of many steps would otherwise keep on disk to its end."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def raw(column: pa.Array) -> list[bytes]:
    """A string column's values as UTF-8; null reads as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def to_batches(schema: pa.Schema, parts: Iterable[list]) -> Iterator[pa.RecordBatch]:
    """One record batch for each list of columns."""
    for cols in parts:
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)


def bucket_of(key: Column, n: int) -> Column:
    """A bucket in [0, n) by hash."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 values, repeats allowed, as first value and differences of the fewest bytes that fit
    all but one in a hundred; the differences that don't fit follow with their places."""
    if not len(values):
        return b""
    diff = np.diff(values)
    width = 1
    while width < 8 and np.count_nonzero(diff >> np.uint64(8 * width)) * 100 > len(diff):
        width += 1
    large = np.flatnonzero(diff >> np.uint64(8 * width)) if width < 8 else np.empty(0, np.int64)
    low = diff.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    head = np.array([len(values), width, len(large)], "<u4").tobytes()
    return head + values[:1].astype("<u8").tobytes() + large.astype("<u4").tobytes() + diff[large].astype("<u8").tobytes() + low.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    n, width, many = (int(x) for x in np.frombuffer(blob, "<u4", 3))
    first = np.frombuffer(blob, "<u8", 1, 12)
    at = 20
    large = np.frombuffer(blob, "<u4", many, at)
    fixed = np.frombuffer(blob, "<u8", many, at + 4 * many)
    low = np.frombuffer(blob, np.uint8, (n - 1) * width, at + 12 * many).reshape(-1, width)
    out = np.zeros((n, 8), np.uint8)
    out[1:, :width] = low
    out = out.view("<u8").ravel()
    out[0] = first[0]
    out[large.astype(np.int64) + 1] = fixed
    return np.cumsum(out, dtype=np.uint64)


def smallest_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node of the links a-b that isn't itself the smallest."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib, root = at[: len(a)], at[len(a):], np.arange(len(names))
    while True:
        before = root.copy()
        low = np.minimum(root[ia], root[ib])
        np.minimum.at(root, before[ia], low)
        np.minimum.at(root, before[ib], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            moved = root != np.arange(len(names))
            return names[moved], names[root[moved]]
