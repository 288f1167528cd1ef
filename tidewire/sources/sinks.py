"""Write reports, briefings, tables and digests. Every write is distributed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.timecols import briefing_file_name, report_file_name
from tidewire.session import settle, small_batches

# Documents of any size are folders ``file_name=<name>`` of part files, which in name order are the text.
NAME = "file_name"


# What a folder name cannot hold is escaped as Spark does it; a name that is NULL has a folder of its own.
_ESCAPED = {c: f"%{c:02X}" for c in (*range(0x20), 0x7F, *b"\"#%'*/:=?\\{[]^")}
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Documents that one task moves into their folders, or reads back.
DOCUMENTS_PER_TASK = 2_000

# What sinks record of each document they have written.
MANIFEST = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("path", T.StringType()), T.StructField("modified_at", T.TimestampType()),
    T.StructField("n_rows", T.LongType())])


def manifest_path(folder: str) -> str:
    """The manifest stands beside the folder, so that whoever lists or reads the folder does not meet it."""
    return f"{folder.rstrip('/')}.manifest"


def _write_documents(named: DataFrame, path: str, rows: DataFrame | None = None) -> None:
    """One folder per document, recorded behind it, for a few documents of any length: the driver commits each folder.

    A run that writes the same names again replaces their content.

    ``rows`` has the names of all lines, if ``named`` is dear to compute again for its names.
    """
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(NAME).text(path)
    counts = (named if rows is None else rows).groupBy(NAME).agg(F.count("*").alias("n_rows"))
    # Spark escapes in folder names what a path cannot hold; names of runs have none of it.
    told = counts.select(F.col(NAME).alias("name"), F.concat(F.lit(f"{path.rstrip('/')}/{NAME}="), NAME).alias("path"),
                         F.current_timestamp().alias("modified_at"), "n_rows")
    told.coalesce(1).write.mode("append").parquet(manifest_path(path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as tasks need it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def tasks_for(documents: DataFrame) -> int:
    """Tasks for work on each of so many documents."""
    return max(documents.sparkSession.sparkContext.defaultParallelism, -(-documents.count() // DOCUMENTS_PER_TASK))


def _write_many_documents(named: DataFrame, path: str) -> None:
    """``file_name, text`` as one folder per document, however many there are; the same folders as ``_write_documents``.

    Tasks write the files, and tasks move them into their folders, so that no step of a document falls to the driver.
    What is written first lies in a hidden folder; of it only files that finished tasks have named are moved. A name has
    one part file per task that met it; parts of earlier runs go when those of this run come. Either step may run again.
    """
    spark, run = small_batches(named.sparkSession), uuid.uuid4().hex
    home = qualified(spark, path)
    hidden = f"/.staged-{run}"
    rows = named.select(NAME, F.col("text").cast("string")).hint("rebalance", NAME).sortWithinPartitions(NAME)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(home)
        folder, part = f"{base}{hidden}/{uuid.uuid4().hex}", TaskContext.get().partitionId()
        out, name, file, n_rows, n_files = None, None, None, 0, 0

        def told(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()),
                pa.array([d[2] for d in done], pa.int64())], names=[NAME, "file", "n_rows"])

        for batch in batches:
            done = []
            names, texts = batch.column(0), batch.column(1)
            for k in range(batch.num_rows):
                here, text = names[k].as_py(), texts[k].as_buffer()
                if out is None or here != name:
                    if out is None:
                        files.create_dir(folder)
                    else:
                        out.close()
                        done.append((name, file, n_rows))
                    name, file, n_rows = here, f"{folder}/part-{part:05d}-{n_files:07d}-{run}.txt", 0
                    n_files += 1
                    out = files.open_output_stream(file, compression=None)
                out.write(b"\n" if text is None else bytes(text) + b"\n")
                n_rows += 1
            yield told(done)
        if out is not None:
            out.close()
            yield told([(name, file, n_rows)])

    written = settle(rows.mapInArrow(write, f"{NAME} string, file string, n_rows long"))
    parts = written.repartition(tasks_for(written), NAME).groupBy(NAME).agg(
        F.collect_list("file").alias("files"), F.sum("n_rows").alias("n_rows"))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(home)
        for batch in batches:
            names = batch.column(0).to_pylist()
            folders = [f"{NAME}={_NO_NAME if not name else name.translate(_ESCAPED)}" for name in names]
            for folder, staged in zip(folders, batch.column(1).to_pylist()):
                target = f"{base}/{folder}"
                files.create_dir(target)
                for old in files.get_file_info(fs.FileSelector(target)):
                    if run not in old.base_name:
                        files.delete_file(old.path)
                for file in staged:
                    place = f"{target}/{file.rsplit('/', 1)[1]}"
                    try:
                        files.move(file, place)
                    except OSError:  # an earlier attempt has moved it
                        if files.get_file_info(place).type != fs.FileType.File:
                            raise
            known = pa.array([None if name is None else folder for name, folder in zip(names, folders)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), known, batch.column(2)], names=["name", "folder", "n_rows"])

    moved = settle(parts.mapInArrow(move, "name string, folder string, n_rows long"))
    files, base = opened(home)
    if files.get_file_info(f"{base}{hidden}").type == fs.FileType.Directory:
        files.delete_dir(f"{base}{hidden}")
    moved.select("name", F.concat(F.lit(f"{path.rstrip('/')}/"), "folder").alias("path"), F.current_timestamp().alias("modified_at"),
                 "n_rows").write.mode("append").parquet(manifest_path(path))


def write_report(lines: DataFrame, path: str, run_type: str, run_at: Column) -> None:
    """Report lines as documents, each under the file name of its date and run.

    Another run has another name. A report without articles has no lines, so that no folder appears.
    """
    named = lines.select(report_file_name(F.col("logical_date"), F.lit(run_type), run_at).alias(NAME), "line_no", "line")
    ordered = named.repartitionByRange(NAME, "line_no").sortWithinPartitions(NAME, "line_no")
    _write_documents(ordered.select(NAME, "line"), path, named.select(NAME))


def write_digest(blocks: DataFrame, path: str) -> None:
    """Digest blocks as text, one folder per digest; the part files in name order are the digest.

    A digest that is written again is replaced.
    """
    ordered = blocks.repartitionByRange("digest", "position").sortWithinPartitions("digest", "position")
    # The text sink ends each row with a line break, so the last one of the block is left out.
    text = F.left("block", F.length("block") - 1).alias("block")
    ordered.select("digest", text).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "digest").text(path)


def write_reports_digest(blocks: DataFrame, order: Sequence[Column], path: str) -> None:
    """Blocks without positions as text, one folder per digest: the texts move once, into their place in their output file.

    ``order`` ends in a unique column. A digest that is written again is replaced.
    """
    ordered = blocks.repartitionByRange("digest", *order).sortWithinPartitions("digest", *order)
    text = F.left("block", F.length("block") - 1).alias("block")
    ordered.select("digest", text).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "digest").text(path)


def write_briefings(briefings: DataFrame, path: str, run_at: Column) -> None:
    """Briefing texts as documents under the file name of their run, any number of them."""
    _write_many_documents(briefings.select(briefing_file_name(run_at).alias(NAME), "text"), path)


def write_stage(df: DataFrame, path: str, day: str, stage: str) -> str:
    """A named intermediate of a day (prefiltered, cards, metrics) as JSON lines; returns its folder."""
    folder = f"{path}/{stage}_{day.replace('-', '')}"
    df.write.mode("overwrite").json(folder)
    return folder


def append_daily(texts: DataFrame, path: str) -> None:
    """Texts appended to the folder of their ``date``."""
    texts.select("date", "text").hint("rebalance", "date").write.mode("append").partitionBy("date").text(path)


def append_table(df: DataFrame, path: str, by: str | Sequence[str] | None = None) -> None:
    """Append rows to a table. Rows of one partition value are brought together, and a value with
    many rows is split over several tasks (rebalance), so that files are few but never huge."""
    names = [by] if isinstance(by, str) else list(by or ())
    if names:
        df.hint("rebalance", *names).write.mode("append").partitionBy(*names).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; it must not read from ``path``."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def replace_dates(df: DataFrame, path: str, by: str = "logical_date") -> None:
    replace_partitions(df, path, [by])


def write_version(df: DataFrame, path: str, version: int) -> str:
    """A new version of a table under its own path, which must not exist."""
    folder = f"{path}/v={version:08d}"
    df.write.mode("error").parquet(folder)
    return folder
