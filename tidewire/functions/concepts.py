"""Concept lists: uris out of arrays or stored JSON, and membership flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_to_null(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def uris_from_json(text: Column) -> Column:
    """Uris of a stored JSON list. Not a list gives NULL; elements without a uri give NULL elements."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.transform(items, lambda item: F.try_variant_get(item, "$.uri", "string"))


def concept_uris(df: DataFrame, column: str = "concepts") -> Column:
    """Array of uris for a concept column that is text, an array of objects or an array of uris."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return uris_from_json(F.col(column))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.col(column).getField("uri")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.col(column)
    raise TypeError(f"{column} must be JSON text, array<struct<uri,...>> or array<string>, not {kind}")


LONG_LIST = 50


def uri_set(uris: Column) -> Column:
    """Distinct uris without NULLs; NULL input gives an empty array."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.coalesce(F.filter(uris, lambda u: u.isNotNull()), none))


def mentions_any(uris: Column, listed: Sequence[str]) -> Column:
    """True if the array holds one of the listed uris. ``arrays_overlap`` says NULL on NULL elements."""
    if not listed:
        return F.lit(False)
    if len(listed) > LONG_LIST:
        # A long list becomes one hash set, which every uri is looked up in.
        return F.coalesce(F.exists(uris, lambda u: u.isin(list(listed))), F.lit(False))
    return F.coalesce(F.arrays_overlap(uris, F.array(*[F.lit(u) for u in listed])), F.lit(False))
