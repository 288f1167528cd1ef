"""Stored tables as folders: reading what may not exist yet, and removing partitions by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty if nothing was written yet. Columns that older files lack are NULL."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern; none if its folder does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return [] if found is None else [f.getPath().toString() for f in found]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Remove the partitions of some values of the last partition column, under all values of the columns before it."""
    for value in values:
        for folder in matching(spark, f"{path}/{column}={value}") + matching(spark, f"{path}/*/{column}={value}"):
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
