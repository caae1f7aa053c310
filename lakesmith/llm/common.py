"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, scratch_root

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(col, *LOWER)


def ascii_lowered(col: Column) -> Column:
    """The same as ``lower_ascii``; texts of ASCII alone take the quick way."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(lower_ascii(col))


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet below the shared scratch folder, and read back.

    It cuts the lineage: a lost executor replays one stage, several readers do not compute it
    twice, and joins that follow plan with real sizes and exchanges of their own.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared scratch root, for files that executors write themselves."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def filesystem(uri: str):
    """(file system, path) of a folder or file by its URI: file, hdfs, s3, gs or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def columns_of(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def utf8_bytes(array: pa.Array) -> list[bytes | None]:
    """The rows of a text column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return array.cast(kind).to_pylist()


#: Cached makers of encoders whose memory lasts over the tasks of one operator.
LASTING: list = []


def lasting(make: Callable) -> Callable:
    """``make`` with its results kept in a worker process, until a task of another operator begins there."""
    kept = lru_cache(maxsize=2)(make)
    LASTING.append(kept)
    return kept


def give_back(keep: Callable | None = None) -> None:
    """Memory of earlier tasks of this reused Python worker goes back to the system, and what other operators than that of
    ``keep`` remember in it."""
    for kept in LASTING:
        if kept is not keep:
            kept.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only there with glibc
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int, keep: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that no piece holds over ``most_bytes`` of text (or one row). ``keep``: see ``give_back``."""
    give_back(keep)
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0).to_pylist()
        first, total = 0, 0
        for i, n in enumerate(lengths):
            if i > first and total + n > most_bytes:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < batch.num_rows:
            yield batch.slice(first)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_fold(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32(doc_id as text) mod ``folds`` is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def logistic(x):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


QueryFn = Callable[[SparkSession, str], DataFrame]
