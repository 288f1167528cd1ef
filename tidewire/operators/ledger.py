"""What has been done to which batch, as an append-only table of small rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.timecols import instant
from tidewire.sources.tablefiles import read_table

INGESTED, SCORING, SCORED = "ingested", "scoring", "scored"
ENTRIES = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("step", T.StringType()), T.StructField("run", T.StringType()),
    T.StructField("at", T.TimestampType())])


def batch_name(*parts: object) -> str:
    """A name that can stand in a path; without parts one that no other batch has."""
    return re.sub("[^A-Za-z0-9._-]+", "-", "-".join(map(str, parts))) if parts else uuid.uuid4().hex


class Ledger:
    """Steps of batches. A step is noted after its tables are written, so a batch whose step is missing was
    interrupted and is done again; what it left is found by its name and removed first.

    ``scoring`` is noted before a scoring run writes and ``scored`` behind it. Only names of open batches and of
    interrupted runs come to the driver, however long the history is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        return read_table(self.spark, self.path, ENTRIES)

    def has(self, batch: str, step: str = INGESTED) -> bool:
        return not self.entries().filter((F.col("batch") == batch) & (F.col("step") == step)).isEmpty()

    def open_batches(self) -> list[str]:
        """Ingested batches that no finished run has scored, in the order of their ingestion."""
        state = self.entries().filter(F.col("step") != SCORING).groupBy("batch").agg(
            F.bool_or(F.col("step") == INGESTED).alias("ingested"), F.bool_or(F.col("step") == SCORED).alias("scored"),
            F.min("at").alias("at"))
        rows = state.filter("ingested and not scored").select("batch", "at").collect()
        return [r["batch"] for r in sorted(rows, key=lambda r: (str(r["at"]), r["batch"]))]

    def interrupted_runs(self) -> list[str]:
        """Scoring runs that began and did not end."""
        runs = self.entries().filter(F.col("step") != INGESTED).groupBy("run").agg(F.bool_or(F.col("step") == SCORED).alias("ended"))
        return [r["run"] for r in runs.filter("not ended").collect()]

    def note(self, batches: Sequence[str], step: str, at: datetime | str, run: str = "") -> None:
        rows = self.spark.range(1).select(
            F.explode(F.array(*[F.lit(b) for b in batches])).alias("batch"), F.lit(step).alias("step"), F.lit(run).alias("run"),
            instant(at).alias("at"))
        rows.coalesce(1).write.mode("append").parquet(self.path)
