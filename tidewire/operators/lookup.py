"""Joins from an uneven fact table to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD = 64
_SLOT = "__slot"


def payload_bytes(df: DataFrame) -> int:
    """Data size of a table: 16 bytes per field, plus the length of texts and of nested values as JSON."""
    size = F.lit(0)
    for field in df.schema.fields:
        size = size + 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.octet_length(F.to_json(F.struct(field.name)))
    return df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0


def lookup(facts: DataFrame, dim: DataFrame, key: str, spread_by: str | Sequence[str], how: str = "left",
           max_bytes: int = MAX_BROADCAST_BYTES, spread: int = SPREAD) -> DataFrame:
    """Join ``facts`` to ``dim`` (unique ``key``).

    The size of ``dim`` is measured. Up to ``max_bytes`` it is broadcast, and the facts are not
    shuffled. Beyond that each key is split into ``spread`` slots: a fact picks its slot by
    ``spread_by`` (one column or several), the dimension row is repeated once per slot, so a hot key is spread evenly.
    ``dim`` should be stored or settled, because measuring it reads it once more.
    """
    if payload_bytes(dim) <= max_bytes:
        return facts.join(F.broadcast(dim), key, how)
    slots = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    slotted_dim = dim.withColumn(_SLOT, slots)
    slotted_facts = facts.withColumn(_SLOT, F.pmod(F.xxhash64(*([spread_by] if isinstance(spread_by, str) else spread_by)), F.lit(spread)).cast("int"))
    joined = slotted_facts.hint("merge").join(slotted_dim, [key, _SLOT], how)
    return joined.drop(_SLOT)


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi",
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of a wide table whose unique ``key`` is (or, with ``left_anti``, is not) among ``keys``.

    Few keys are broadcast, so that the wide rows stay where they are. Many keys take a shuffle
    join; the key is unique, so it cannot be skewed.
    """
    wanted = keys.select(key)
    return df.join(F.broadcast(wanted) if payload_bytes(wanted) <= max_bytes else wanted, key, how)
