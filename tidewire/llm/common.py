"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.session import small_batches  # noqa: F401

DIGITS, UPPER, LOWER = range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B)
# Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space. UTF-8 keeps
# characters above ASCII in bytes from 0x80 on, which stay as they are.
WORD_BYTES = bytes(
    b + 32 if b in UPPER else b if b in DIGITS or b in LOWER or b >= 0x80 else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-case words of a text in UTF-8: runs of ASCII letters, digits and characters above ASCII."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column) -> Column:
    """A key of the whole text; null texts have a null key."""
    return F.sha2(text if isinstance(text, Column) else F.col(text), 256)


def columns_of(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    return (batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names)


# The parameter M_MMAP_THRESHOLD of mallopt: larger stretches go back as soon as they are freed. By itself it grows to 32 MB.
_MMAP_THRESHOLD, MAPPED_BYTES = -3, 4 << 20


def release_memory() -> None:
    """Give back what earlier tasks of this worker freed: Spark keeps workers, and allocators keep pages."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(_MMAP_THRESHOLD, MAPPED_BYTES)
        pa.set_memory_pool(pa.system_memory_pool())
    pa.default_memory_pool().release_unused()
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut into stretches of about ``max_bytes`` of one text column, so that what is built of them stays small."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // max_bytes
        start = 0
        for end in [*(np.nonzero(np.diff(part))[0] + 1).tolist(), batch.num_rows]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end


def short_slices(batches: Iterator[pa.RecordBatch], name: str = "text", max_bytes: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Shorter stretches for what takes many times their bytes; memory is given back before and after them."""
    release_memory()
    yield from slices(batches, name, max_bytes)
    release_memory()


def carried(docs: DataFrame, keep: Sequence[str], text: str) -> list[Column]:
    """Columns that an operator passes through, under names of its own; the text goes with its input."""
    return [F.col(c).alias(f"__keep{k}") for k, c in enumerate(keep) if c != text]


def carried_row(keep: Sequence[str], text: str) -> list[Column]:
    """The columns of ``keep`` as one column ``row``, or nothing."""
    fields = [F.col("text" if c == text else f"__keep{k}").alias(c) for k, c in enumerate(keep)]
    return [F.struct(*fields).alias("row")] if fields else []


def passed(batch: pa.RecordBatch, keep: Sequence[str]) -> tuple[list[pa.Array], list[str]]:
    """The text, if it is kept, and the other columns passed through."""
    names = (["text"] if keep else []) + [n for n in batch.schema.names if n.startswith("__keep")]
    return [batch.column(batch.schema.get_field_index(n)) for n in names], names


def passed_schema(rows: DataFrame, keep: Sequence[str]) -> list[T.StructField]:
    return ([T.StructField("text", T.StringType())] if keep else []) + [
        f for f in rows.schema.fields if f.name.startswith("__keep")]
