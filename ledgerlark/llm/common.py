"""Parts that several operators share: table sizes, flat text buffers and word boundaries."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import shared_folder

#: The bytes that separate words, 0x20 and 0x09 to 0x0D.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder of spark.checkpoint.dir, which all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release() -> None:
    """Give freed memory back to the system. Python workers outlive their tasks, and what the largest
    task of one stage has freed would stay theirs in all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in glibc
    if trim is not None:
        trim(0)


def text_size(docs: DataFrame) -> tuple[int, int]:
    """Rows and bytes of text; one aggregate over the table, nothing else reaches the driver."""
    n, b = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return int(n), int(b)


def held_out(doc_id) -> "F.Column":
    """Rows kept from learning: crc32 of the id as text is a multiple of 5. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary Arrow column, one after the other, and each row's bounds. A null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return buf, at - at[0]


def sorted_set(*parts: np.ndarray) -> np.ndarray:
    """The distinct numbers of all parts, in order. The parts are nearly in order, where sorting beats hashing."""
    x = np.sort(np.concatenate(parts), kind="stable")
    return x[np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]])]


def word_bounds(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each row. No word crosses rows."""
    inside = IS_WORD[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(buf)]] = False
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, at)
