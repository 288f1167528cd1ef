"""Stored keys in buckets, so that new rows are told from known ones without moving the history."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.lookup import rows_with_keys
from tidewire.operators.tables import one_per_key
from tidewire.session import settle
from tidewire.sources.tablefiles import matching

BUCKETS = 64


class KeyTable:
    """The keys of a table and the batch that brought each, bucketed and sorted by key.

    Arriving keys are dealt out to the same buckets and joined bucket to bucket: only they are shuffled, and of the
    stored table only the narrow key files are read. The number of buckets belongs to the folder's name; a folder
    with another number is refused, as Spark would not find its keys. ``rebuild`` fills a new one.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str = "id", buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.path = f"{folder}-{buckets}"
        others = [p for p in matching(spark, f"{folder}-*") if not p.endswith(f"-{buckets}")]
        if others:
            raise ValueError(f"keys are in {others[0].rsplit('-', 1)[1]} buckets, not in {buckets}")
        self.is_new = not matching(spark, self.path)
        # The catalog may not outlast the session; the files do, and are declared again.
        self.name = f"keys_{hashlib.md5(self.path.encode()).hexdigest()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (`{key}` STRING, batch STRING) USING parquet "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def stored(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unknown(self, rows: DataFrame, batch: str) -> DataFrame:
        """The keys of ``rows`` that no other batch has brought, once each; null keys are left out."""
        known = self.stored().filter(F.col("batch") != batch).select(self.key)
        arriving = rows.select(self.key).filter(F.col(self.key).isNotNull()).repartition(self.buckets, self.key)
        return arriving.dropDuplicates([self.key]).join(known, self.key, "left_anti")

    def add(self, keys: DataFrame) -> None:
        """Append ``key, batch``; repeated ones do no harm."""
        dealt = keys.select(F.col(self.key).cast("string").alias(self.key), "batch").repartition(self.buckets, self.key)
        dealt.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).mode("append").saveAsTable(self.name)

    def rebuild(self, rows: DataFrame) -> None:
        """Fill a new folder from the table itself, ``key, batch``."""
        if self.is_new:
            self.add(rows)
            self.is_new = False


def insert_new_keys(batch: DataFrame, keys: KeyTable, name: str) -> DataFrame:
    """Rows of the batch to append: stored keys win, then the first of the batch to arrive.

    The choice is made on keys; rows are fetched by key.
    """
    return rows_with_keys(one_per_key(batch, keys.key), settle(keys.unknown(batch, name)), keys.key)
