"""Helpers shared by the training-data operators: stage tables, Arrow text buffers and word spans.

Text is scanned as UTF-8 bytes.  All word alphabets of the operators are
described by a 256-entry byte table: the separators are ASCII, so every byte of
a multi-byte character belongs to a word and byte spans never cut a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Bytes of text that a task scans at once (one document may be longer).
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for bytes that belong to words; ``separators`` are inclusive byte ranges."""
    table = np.ones(256, dtype=bool)
    for lo, hi in separators:
        table[lo:hi + 1] = False
    return table


#: Words of `[^\x20\x09-\x0D]+`.
SPACED_WORDS = byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (the text is lower-cased first).
ALNUM_WORDS = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def executors_import_this(spark: SparkSession) -> None:
    """Python workers get this checkout on their path (harmless where the package is installed)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: it is computed once, and a lost
    executor costs the stages after the table only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Delete the files of a :func:`staged` table that nothing reads any more (an iteration's last state)."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bound(value: Column, use) -> Column:
    """``use(x)`` with ``x`` bound to ``value``, which is evaluated once."""
    return F.transform(F.array(value), use)[0]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (null: empty) and the byte offset of each row, the end last."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"").cast(column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``rows`` rows and ``limit`` bytes of text each, or one row."""
    _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, min(at + rows, int(np.searchsorted(off, off[at] + limit, "right")) - 1))
        yield batch.slice(at, end - at)
        at = end


def word_spans(data: np.ndarray, off: np.ndarray, table: np.ndarray,
               cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each row's first word (their number last).
    A row's end ends a word, and so does each position of ``cuts`` within a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = off[(off > 0) & (off < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    if cuts is not None:
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def packed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> pa.Array:
    """The words as one Arrow binary column, without a Python object for each."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[table[data]])])
