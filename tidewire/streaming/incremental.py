"""Ingest landed article files as they arrive, with the rules of the daily batch.

Each run takes every file that is new since the last one (``availableNow``) as one batch. Late
articles need no watermark: they are simply rows without a score. The batch of a run is also the
normalisation scope of its scores, so the number of files per batch is deliberately not limited.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators.ledger import Ledger, batch_name
from tidewire.params import ScoringParams
from tidewire.plans.daily import Store, note_unreadable, score_new, store_articles
from tidewire.schemas import LANDED_ARTICLE
from tidewire.session import settle, use_utc
from tidewire.sources import landing


def ingest_batch(store: Store, batch: DataFrame, name: str, now: datetime | str, cutoff_hour: int = 6) -> None:
    """Store the articles and rejects of one batch of landed lines, once however often it is replayed."""
    spark = batch.sparkSession
    if Ledger(spark, store.ledger).has(name):
        return
    landed_rows = settle(landing.parsed_lines(landing.arrived_lines(batch), LANDED_ARTICLE))
    note_unreadable(spark, store, landed_rows, "article line", name)
    good = landed_rows.filter(F.col(landing.CORRUPT).isNull())
    store_articles(spark, store, landing.flatten_articles(good, now, cutoff_hour), name, now)


def ingest_available(spark: SparkSession, store: Store, landed: str, checkpoint: str, now: datetime | str,
                     cutoff_hour: int = 6) -> StreamingQuery:
    """Append the articles of all new files.

    A batch is named by the stream, whose id stays with its checkpoint, and its number, so a replayed batch is found
    in the ledger and changes neither articles nor rejects; one that was interrupted is stored anew.
    """
    def append(batch: DataFrame, number: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_batch(store, batch, batch_name("stream", stream_id, number), now, cutoff_hour)

    stream = use_utc(spark).readStream.text(landed).select("value", "_metadata")
    return (stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_incremental(spark: SparkSession, store: Store, landed: str, checkpoint: str, now: datetime | str,
                    params: ScoringParams | None = None, cutoff_hour: int = 6) -> None:
    """Ingest what has arrived, then score what waits."""
    ingest_available(spark, store, landed, checkpoint, now, cutoff_hour).awaitTermination()
    score_new(spark, store, now, params or ScoringParams(), cutoff_hour)
