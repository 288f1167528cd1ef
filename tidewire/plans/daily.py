"""The daily batch: refresh concepts, ingest, score, report. Tables are Parquet under one root."""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.timecols import instant, logical_date_bj
from tidewire.operators import daily_state, report, scoring, select, tables
from tidewire.operators.keys import BUCKETS, KeyTable, insert_new_keys
from tidewire.operators.ledger import INGESTED, SCORED, SCORING, Ledger, batch_name
from tidewire.operators.lookup import rows_with_keys
from tidewire.params import ReportParams, ScoringParams, SelectionParams
from tidewire.schemas import ARTICLE_SCORES, ARTICLES, TRENDING
from tidewire.session import build_session, released, settle, use_utc
from tidewire.sources import landing, sinks
from tidewire.sources.tablefiles import drop_partitions, matching, read_table

# Rows that cannot be stored, and unreadable lines with their text.
REJECTS = T.StructType([*ARTICLES.fields, *[T.StructField(n, T.StringType()) for n in ("line", "batch", "kind")]])
STORED_ARTICLES = T.StructType([*ARTICLES.fields, T.StructField("batch", T.StringType())])
STORED_SCORES = T.StructType([
    *ARTICLE_SCORES.fields, T.StructField("logical_date", T.DateType()), T.StructField("run", T.StringType())])
STATE = T.StructType([*daily_state.STATE.fields, T.StructField("run", T.StringType())])
SET_ASIDE = T.StructType([*ARTICLE_SCORES.fields, T.StructField("run", T.StringType())])


@dataclass(frozen=True)
class Store:
    """Where the tables of a pipeline live.

    ``articles`` are partitioned by logical date and batch, ``scores`` by logical date and scoring run; ``ledger`` tells
    which batches are stored and scored.
    """

    root: str
    key_buckets: int = BUCKETS

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def keys(self) -> str:
        return f"{self.root}/article_keys"

    @property
    def articles(self) -> str:
        return f"{self.root}/articles"

    @property
    def scores(self) -> str:
        return f"{self.root}/article_scores"

    @property
    def state(self) -> str:
        return f"{self.root}/daily_state"

    @property
    def unscorable(self) -> str:
        return f"{self.root}/unscorable"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def trending(self) -> str:
        return f"{self.root}/trending_concepts"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


def read_trending(spark: SparkSession, store: Store) -> tuple[DataFrame, int]:
    """The newest version of the concept table and its number (0: none yet)."""
    versions = read_table(spark, store.trending, T.StructType([*TRENDING.fields, T.StructField("v", T.IntegerType())]))
    newest = versions.agg(F.max("v")).first()[0] or 0
    return versions.filter(F.col("v") == newest).drop("v"), newest


def refresh_trending(spark: SparkSession, store: Store, path: str, now: datetime | str, p: SelectionParams) -> None:
    """Upsert the landed concepts into a new version of the table."""
    note_unreadable(spark, store, landing.landed_trending(spark, path), "trending line", batch_name("trending", now))
    current, version = read_trending(spark, store)
    updates = select.top_trending(landing.read_trending(spark, path, now), p).select(current.columns)
    sinks.write_version(tables.upsert_latest(current, updates), store.trending, version + 1)


def note_rejects(spark: SparkSession, store: Store, rows: DataFrame, kind: str, batch: str) -> None:
    """Keep what cannot be stored. Batch and kind name its partition, so a batch that is read again replaces its own."""
    empty = spark.createDataFrame([], REJECTS)
    marked = empty.unionByName(rows.withColumns({"kind": F.lit(kind), "batch": F.lit(batch)}), allowMissingColumns=True)
    sinks.replace_partitions(marked, store.rejects, ["batch", "kind"])


def note_unreadable(spark: SparkSession, store: Store, landed: DataFrame, kind: str, batch: str) -> None:
    """Keep the text of unreadable lines among the rejects."""
    note_rejects(spark, store, landing.unreadable(landed, kind).select("line"), kind, batch)


def store_articles(spark: SparkSession, store: Store, flat: DataFrame, batch: str | None = None,
                   now: datetime | str = "1970-01-01T00:00:00Z") -> None:
    """Append the new rows of a batch, of each id the first to arrive, and its rejects.

    A batch that the ledger holds as ingested changes nothing. One that was interrupted is stored anew: its own
    partitions go first, and keys that it brought itself are not known ones.
    """
    name, ledger = batch or batch_name(), Ledger(spark, store.ledger)
    if ledger.has(name):
        return
    keys = KeyTable(spark, store.keys, "id", store.key_buckets)
    drop_partitions(spark, store.articles, "batch", [name])
    if keys.is_new and matching(spark, f"{store.articles}/*"):
        keys.rebuild(read_table(spark, store.articles, STORED_ARTICLES).select("id", "batch"))
    kept, bad = tables.split_rejects(settle(flat))
    fresh = insert_new_keys(kept, keys, name).select(ARTICLES.fieldNames()).withColumn("batch", F.lit(name))
    sinks.append_table(fresh, store.articles, by=["logical_date", "batch"])
    keys.add(read_table(spark, store.articles, STORED_ARTICLES).filter(F.col("batch") == name).select("id", "batch"))
    note_rejects(spark, store, bad.select(*[c for c in ARTICLES.fieldNames() if c in bad.columns]), "article", name)
    ledger.note([name], INGESTED, now)


def ingest(spark: SparkSession, store: Store, articles_path: str, events_path: str, now: datetime | str,
           p: SelectionParams, trusted: DataFrame | None = None, cutoff_hour: int = 6) -> None:
    """Store the newest articles of the selected events, as one batch under the time of the run."""
    name = batch_name("ingest", now)
    if Ledger(spark, store.ledger).has(name):
        return
    note_unreadable(spark, store, landing.landed_events(spark, events_path), "event line", name)
    events = settle(select.select_events(landing.read_events(spark, events_path), p, now, trusted))
    landed = landing.read_articles(spark, articles_path)
    note_unreadable(spark, store, landed, "article line", name)
    flat = landing.flatten_articles(landed.filter(F.col(landing.CORRUPT).isNull()), now, cutoff_hour)
    sized = settle(select.attach_event_size(flat, events))
    without_id = sized.filter(F.col("id").isNull())
    # Of each id the first to arrive, then the newest of each event: both on narrow rows, bodies are fetched once.
    narrow = sized.filter(F.col("id").isNotNull()).select("id", "event_uri", "published_at", "arrival")
    newest = select.latest_per_event(tables.one_per_key(narrow), p.articles_per_event).select("id", "arrival")
    chosen = rows_with_keys(sized, settle(newest), "arrival")
    store_articles(spark, store, chosen.unionByName(without_id), name, now)


def scoring_queue(spark: SparkSession, store: Store, batches: list[str]) -> DataFrame:
    """The articles of batches that wait for scores: only their partitions are read, and no history is joined."""
    return read_table(spark, store.articles, STORED_ARTICLES).filter(F.col("batch").isin(batches))


def score_new(spark: SparkSession, store: Store, now: datetime | str, p: ScoringParams, cutoff_hour: int = 6) -> None:
    """Score the articles of all open batches, as one scope; rows that cannot be scored are set aside.

    What an interrupted run wrote is removed first, and its batches are open still.
    """
    ledger = Ledger(spark, store.ledger)
    interrupted = ledger.interrupted_runs()
    for path in (store.scores, store.unscorable, store.state):
        drop_partitions(spark, path, "run", interrupted)
    batches = ledger.open_batches()
    if not batches:
        return
    run = batch_name(now, batch_name()[:8])
    queue = scoring_queue(spark, store, batches)
    ledger.note(batches, SCORING, now, run)
    if not queue.isEmpty():
        trending, _ = read_trending(spark, store)
        scored, unscorable = scoring.split_unscorable(scoring.score_articles(queue, trending, p, now))
        dated = scored.withColumn("logical_date", logical_date_bj(F.col("published_at"), cutoff_hour))
        sinks.append_table(unscorable.withColumn("run", F.lit(run)), store.unscorable, by="run")
        sinks.append_table(dated.withColumn("run", F.lit(run)), store.scores, by=["logical_date", "run"])
        stored = read_table(spark, store.scores, STORED_SCORES).filter(F.col("run") == run)
        sinks.append_table(daily_state.partials(stored, cutoff_hour).withColumn("run", F.lit(run)), store.state, by="run")
    ledger.note(batches, SCORED, now, run)
    # Noted so far as begun, an interrupted run is forgotten once its batches are scored.
    if interrupted:
        for old in interrupted:
            ledger.note([""], SCORED, now, old)


def delete_scores(spark: SparkSession, store: Store, day: date | str, now: datetime | str, cutoff_hour: int = 6) -> None:
    """Take the scores of one logical date back: out of the state by a correction, then out of the table."""
    scores = read_table(spark, store.scores, STORED_SCORES).filter(F.col("logical_date") == F.lit(str(day)).cast("date"))
    back = settle(daily_state.partials(scores, cutoff_hour, sign=-1))
    # Under the name of this deletion, so that one that is done again does not count twice.
    sinks.replace_partitions(back.withColumn("run", F.lit(batch_name("delete", day, now))), store.state, ["run"])
    drop_partitions(spark, store.scores, "logical_date", [str(day)])


def write_day_report(spark: SparkSession, store: Store, day: date | str, now: datetime | str, p: ReportParams,
                     run_type: str = "scheduled") -> None:
    """Write the report of one date under the name of its run; a date without scored articles leaves none."""
    scored = tables.with_flag_defaults(read_table(spark, store.scores, STORED_SCORES))
    rows = report.daily_report(scored, read_table(spark, store.articles, STORED_ARTICLES), day, p)
    if not rows.select("rank").isEmpty():
        sinks.write_report(report.report_lines(rows, now, p), store.reports, run_type, instant(now))


def run_day(spark: SparkSession, store: Store, landed: str, day: date | str, now: datetime | str,
            scoring_params: ScoringParams | None = None, selection: SelectionParams | None = None,
            report_params: ReportParams | None = None, trusted: DataFrame | None = None) -> None:
    """One daily run over ``landed/{trending,events,articles}``. Its intermediate tables go with it."""
    use_utc(spark)
    chosen, wanted = selection or SelectionParams(), report_params or ReportParams()
    with released(spark):
        refresh_trending(spark, store, f"{landed}/trending", now, chosen)
        ingest(spark, store, f"{landed}/articles", f"{landed}/events", now, chosen, trusted, wanted.cutoff_hour)
        score_new(spark, store, now, scoring_params or ScoringParams(), wanted.cutoff_hour)
        write_day_report(spark, store, day, now, wanted)


def main(arguments: list[str] | None = None) -> None:
    """Command line of the daily run; parameters that differ from the defaults are JSON objects."""
    parser = argparse.ArgumentParser(description=run_day.__doc__)
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--landed", required=True, help="folder with trending, events and articles")
    parser.add_argument("--day", required=True, help="logical date of the report, YYYY-MM-DD")
    parser.add_argument("--now", required=True, help="time of the run, ISO, UTC if without offset")
    for name in ("scoring", "selection", "report"):
        parser.add_argument(f"--{name}", type=json.loads, default={}, help="parameters as JSON")
    given = parser.parse_args(arguments)
    run_day(build_session("daily"), Store(given.root), given.landed, given.day, given.now, ScoringParams(**given.scoring),
            SelectionParams(**given.selection), ReportParams(**given.report))


if __name__ == "__main__":
    main()
