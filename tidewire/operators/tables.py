"""Incremental tables on immutable files: insert-ignore, upsert, queues, deletes and added columns.

Articles are written once, scores are appended, and every other change is a new table version at a
new path. Nothing here overwrites a path that it reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.lookup import rows_with_keys
from tidewire.operators.ranking import first_per_group, top_rows
from tidewire.schemas import FLAG_DEFAULTS
from tidewire.session import settle


def split_rejects(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(storable rows, rows without an id or with a negative event size)."""
    bad = F.col("id").isNull() | F.coalesce(F.col("total_articles_in_event") < 0, F.lit(False))
    return batch.filter(~bad), batch.filter(bad)


def insert_new(batch: DataFrame, target: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows of the batch to append: stored keys win, then the first of the batch by ``order``.

    The stored keys are cut down to those of the batch where they are read, so that the target is
    not shuffled as long as the keys of the batch can be broadcast.
    """
    arriving = settle(batch.select(key).distinct())
    known = rows_with_keys(target.select(key), arriving, key)
    return first_per_group(batch, [key], order).join(known, key, "left_anti")


def batch_order(batch: DataFrame) -> list[Column]:
    """The order in which rows arrived. For batches without ``arrival`` newest first, then by a digest
    of the whole row, so that a task that runs again picks the same row."""
    if "arrival" in batch.columns:
        return [F.col("arrival")]
    return [F.desc("published_at"), F.md5(F.to_json(F.struct(*batch.columns)))]


def one_per_key(batch: DataFrame, key: str = "id") -> DataFrame:
    """The first row of each key. The choice is made on narrow rows where the order allows it."""
    return first_per_group(batch, [key], batch_order(batch))


def upsert_latest(current: DataFrame, updates: DataFrame, key: str = "uri", stamp: str = "updated_at") -> DataFrame:
    """The next version of a keyed table: updated keys take the new values, other keys stay.

    A key that occurs more than once in the updates takes the greatest (stamp, other columns).
    """
    values = [c for c in current.columns if c not in (key, stamp)]
    def rows(df: DataFrame, is_update: int) -> DataFrame:
        return df.select(key, F.struct(F.lit(is_update).alias("is_update"), stamp, *values).alias("row"))

    both = rows(current, 0).unionByName(rows(updates, 1))
    picked = both.groupBy(key).agg(F.max("row").alias("row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"row.{c}") for c in current.columns])


def unscored(articles: DataFrame, scores: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Articles that still wait for a score: neither scored nor rejected."""
    done = scores.select("id")
    return rows_without(articles, done if rejects is None else done.unionByName(rejects.select("id")), "id")


def rows_without(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``done``. Only keys are shuffled; the rows are fetched by key."""
    return rows_with_keys(df, settle(df.select(key).join(done, key, "left_anti")), key)


def without_summary(rows: DataFrame, summaries: DataFrame) -> DataFrame:
    """Raw rows that no summary points to. An empty summary table queues all of them."""
    return rows_without(rows, summaries.select(F.col("raw_id").alias("id")), "id")


def scored_view(articles: DataFrame, scores: DataFrame, how: str = "left") -> DataFrame:
    """Articles with their scores; the shared columns are taken from the articles."""
    extra = [c for c in scores.columns if c not in articles.columns]
    return articles.join(scores.select("id", *extra), "id", how)


def collected_on(df: DataFrame, day: date | str, column: str = "collected_at") -> DataFrame:
    """Preview of the rows that ``without_collected_on`` removes."""
    return df.filter(F.to_date(column) == F.lit(str(day)).cast("date"))


def without_collected_on(df: DataFrame, day: date | str, column: str = "collected_at") -> DataFrame:
    """All rows but those of one collection date. Rows without a date stay."""
    return df.filter(~F.coalesce(F.to_date(column) == F.lit(str(day)).cast("date"), F.lit(False)))


def emptied(df: DataFrame) -> DataFrame:
    return df.limit(0)


def with_flag_defaults(df: DataFrame) -> DataFrame:
    """Flag columns that older files lack, or hold as NULL, read as their default."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        for name, default in FLAG_DEFAULTS.items()
    })


def unify(tables: Sequence[DataFrame]) -> DataFrame:
    """Several sources in one schema; a column that a source lacks is NULL."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged


def latest_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return top_rows(df, order, n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))
