"""Choose report and briefing files by name and modification time."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.timecols import since
from tidewire.operators.lookup import lookup
from tidewire.operators.ranking import numbered, running_totals
from tidewire.session import settle
from tidewire.sources.sinks import MANIFEST, NAME, manifest_path, opened, qualified, tasks_for
from tidewire.sources.tablefiles import read_table

# Lines and characters of a batch of lines that a task reads.
BATCH_LINES, BATCH_CHARACTERS = 5_000, 4 << 20
REPORT_STRATEGIES = ("by_ds", "latest_any", "by_ds_then_latest")
BRIEFING_STRATEGIES = ("latest_any", "by_date", "latest_daily_single")


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, name and modification time of the files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                        F.col("modificationTime").alias("modified_at"))


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """path, name and modification time of the documents that the sinks write: folders of part files."""
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_extract("path", f"^(.*/{NAME}=[^/]+)/[^/]+$", 1)
    return parts.select(path.alias("path"), F.col("modificationTime").alias("modified_at")).filter("path <> ''").groupBy(
        "path").agg(F.max("modified_at").alias("modified_at")).select(
            "path", F.element_at(F.split("path", f"/{NAME}="), -1).alias("name"), "modified_at")


def recorded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """path, name and modification time of the documents in a folder, as their sinks recorded them.

    One small table is read and no folder is listed; a document that was written again counts with its last time.
    """
    rows = read_table(spark, manifest_path(folder), MANIFEST)
    return rows.groupBy("path", "name").agg(F.max("modified_at").alias("modified_at"), F.max_by("n_rows", "modified_at").alias("n_rows"))


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The lines of documents: ``path, place, value``. In the order of ``place`` they are the text of one."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths if isinstance(paths, str) else list(paths))
    file = F.col("_metadata.file_path")
    place = F.struct(F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("line"))
    return lines.select(F.regexp_extract(file, "^(.*)/[^/]+$", 1).alias("path"), place.alias("place"), "value")


def read_recorded(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all recorded documents, as ``read_documents`` gives them, however many there are.

    Tasks open the documents that the manifest names, so that the driver neither lists nor plans their files.
    """
    home = qualified(spark, folder)
    recorded = recorded_documents(spark, folder).filter("path is not null").select(
        F.concat(F.lit(f"{home}/"), F.element_at(F.split("path", "/"), -1)).alias("path"))

    def told(found: list[tuple]) -> pa.RecordBatch:
        paths, parts, lines, values = zip(*found)
        place = pa.StructArray.from_arrays(
            [pa.array(parts, pa.string()), pa.array([0] * len(parts), pa.int64()), pa.array(lines, pa.int64())],
            names=["part", "start", "line"])
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), place, pa.array(values, pa.string())],
                                          names=["path", "place", "value"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            files, base = opened(path)
            parts = [f for f in files.get_file_info(fs.FileSelector(base)) if f.is_file and f.base_name[0] not in "._"]
            for part in sorted(parts, key=lambda f: f.base_name):
                with io.TextIOWrapper(files.open_input_file(part.path), "utf-8", "replace") as text:
                    for number, line in enumerate(text):
                        found.append((path, part.base_name, number, line.removesuffix("\n")))
                        held += len(line)
                        if len(found) >= BATCH_LINES or held >= BATCH_CHARACTERS:
                            yield told(found)
                            found, held = [], 0
        if found:
            yield told(found)

    return recorded.repartition(tasks_for(recorded), "path").mapInArrow(
        read, "path string, place struct<part: string, start: long, line: long>, value string")


def read_texts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Whole texts with path and name."""
    rows = spark.read.text(list(paths), wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
                       F.col("value").alias("text"))


def _newest(condition: Column | None = None) -> Column:
    stamp = F.struct("modified_at", "name")
    return F.max_by("path", stamp if condition is None else F.when(condition, stamp))


def is_report(name: Column, date: Column | str | None = None) -> Column:
    """``summary_*.json``, of one date if it is given."""
    prefix = F.lit("summary_")
    if date is not None:
        prefix = F.concat(prefix, date if isinstance(date, Column) else F.lit(date), F.lit("_"))
    return F.startswith(name, prefix) & F.endswith(name, F.lit(".json"))


def newest_report(files: DataFrame, strategy: str, date: str | None = None) -> DataFrame:
    """One row with the path of the chosen report, NULL if none fits. One pass over the names."""
    if strategy not in REPORT_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    name = F.col("name")
    latest, dated = _newest(), _newest(is_report(name, date) if date else F.lit(False))
    choice = {"latest_any": latest, "by_ds": dated, "by_ds_then_latest": F.coalesce(dated, latest)}[strategy]
    return files.filter(is_report(name)).agg(choice.alias("path"))


def newest_within(files: DataFrame, as_of: Column | datetime | str, hours: float = 48) -> DataFrame:
    """The newest report of the last hours, for a date without one of its own."""
    recent = files.filter(is_report(F.col("name")) & since(files, "modified_at", as_of, hours))
    return recent.agg(_newest().alias("path"))


def report_path(files: DataFrame, strategy: str, date: str | None = None, explicit: str | None = None,
                date_override: str | None = None, any_date: bool = False) -> str:
    """The input report of a run: a named file, then the override, then the strategy. None is an error."""
    if explicit:
        found = files.filter((F.col("name") == explicit) | (F.col("path") == explicit)).agg(_newest().alias("path"))
    else:
        found = newest_report(files, "latest_any" if any_date else strategy, date_override or date)
    path = found.first()["path"]
    if path is None:
        raise FileNotFoundError(f"no report for {explicit or date_override or date} by {strategy}")
    return path


def briefing_files(files: DataFrame, strategy: str, date: str | None = None) -> DataFrame:
    """The briefings to send, in the order of their modification time.

    ``latest_daily_single`` takes the newest daily briefing of the date, else its newest text.
    """
    if strategy not in BRIEFING_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    name = F.col("name")
    texts = files.filter(F.endswith(name, F.lit(".md")))
    if strategy == "latest_any":
        return texts.agg(_newest().alias("path")).filter(F.col("path").isNotNull())
    of_day = texts.filter(F.startswith(name, F.lit(f"{date}_")))
    if strategy == "by_date":
        return of_day.select("path", "modified_at", "name").orderBy("modified_at", "name")
    daily = _newest(F.endswith(name, F.lit("_daily_briefing.md")))
    return of_day.agg(F.coalesce(daily, _newest()).alias("path")).filter(F.col("path").isNotNull())


def briefing_paths(files: DataFrame, strategy: str = "latest_daily_single", date: str | None = None,
                   explicit: Sequence[str] | str | None = None, any_date: bool = False) -> list[str]:
    """The paths to send; a named file that is absent, or no file at all, is an error."""
    if explicit:
        wanted = [explicit] if isinstance(explicit, str) else list(explicit)
        rows = files.filter(F.col("name").isin(wanted) | F.col("path").isin(wanted)).select("name", "path").collect()
        by_name = {key: r["path"] for r in rows for key in (r["name"], r["path"])}
        absent = [w for w in wanted if w not in by_name]
        if absent:
            raise FileNotFoundError(f"no such briefings: {absent}")
        return [by_name[w] for w in wanted]
    chosen = briefing_files(files, "latest_any" if any_date else strategy, date)
    paths = [r["path"] for r in chosen.select("path").toLocalIterator()]
    if not paths:
        raise FileNotFoundError(f"no briefing for {date} by {strategy}")
    return paths


def digest_blocks(reports: DataFrame, digest: Column | str = "all") -> DataFrame:
    """The reports with a text, their ``digest`` and their ``block`` of it."""
    named = reports.withColumn("digest", digest if isinstance(digest, Column) else F.lit(digest))
    block = F.concat(F.lit("# Report: "), F.col("name"), F.lit("\n\n"), F.col("text"), F.lit("\n\n---\n\n"))
    return named.filter(F.col("text").isNotNull()).withColumn("block", block)


def digest_index(reports: DataFrame, order: Sequence[Column], digest: Column | str = "all", carry: Sequence[str] = ()) -> DataFrame:
    """Where each block stands: ``digest, position, name, offset, size``, in bytes of the digest's text.

    Sizes are taken where the texts are read; only they and the order move. ``order`` ends in a unique column.
    """
    blocks = digest_blocks(reports, digest)
    names = [f"__o{k}" for k in range(len(order))]
    narrow = blocks.select("digest", "name", *carry, F.octet_length("block").cast("long").alias("size"),
                           *[o.alias(n) for o, n in zip(order, names)])
    return running_totals(narrow, [F.col(n) for n in names], "size", "digest").drop(*names)


def build_digest(reports: DataFrame, order: Sequence[Column], digest: Column | str = "all", key: str | None = None) -> DataFrame:
    """Briefings as the blocks of a digest, one row each.

    The blocks of a digest in ``position`` order are its text. They stay separate rows, because a
    digest has no size limit. Briefings without text give no block. With a unique ``key`` positions are found on
    narrow rows and looked up by it, so that the texts are not stored and, up to the broadcast bound, not moved.
    """
    blocks = digest_blocks(reports, digest)
    if key is None:
        ranked = numbered(blocks.drop("block"), order, within="digest", name="position")
        return digest_blocks(ranked, F.col("digest")).select("digest", "position", "name", "block")
    carry = [] if key == "name" else [key]
    places = settle(digest_index(reports, order, digest, carry).select(key, "position"))
    return lookup(blocks, places, key, key, "inner").select("digest", "position", "name", "block")
