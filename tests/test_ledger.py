"""Batches that are stored and scored once: interrupted, replayed, and told from history by name and by key."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.operators.keys import KeyTable, insert_new_keys
from tidewire.operators.ledger import SCORING, Ledger, batch_name
from tidewire.params import ScoringParams
from tidewire.plans import daily, queries
from tidewire.session import settle
from tidewire.sources import landing, sinks
from tidewire.streaming import incremental

SF = "/root/testdata/sf0.001"
NOW = datetime(2025, 9, 2, 12, tzinfo=timezone.utc)


def _flat(spark, ids, hours=1):
    lines = [(f'{{"uri": "{i}", "title": "t {i}", "dateTimePub": "2025-09-02T0{hours}:00:00Z", "eventUri": "e"}}',) for i in ids]
    return landing.flatten_articles(landing.parse_articles(spark.createDataFrame(lines, "value string")), NOW)


def _store(tmp_path):
    return daily.Store(str(tmp_path / "store"), key_buckets=4)


def _ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).select("id").collect())


def test_queue_reads_open_batches_only(spark, tmp_path):
    store = _store(tmp_path)
    daily.store_articles(spark, store, _flat(spark, "abc"), "one", NOW)
    daily.score_new(spark, store, NOW, ScoringParams())
    daily.store_articles(spark, store, _flat(spark, "bcd"), "two", NOW)
    ledger = Ledger(spark, store.ledger)
    assert ledger.open_batches() == ["two"] and ledger.has("one") and not ledger.has("three")
    queue = daily.scoring_queue(spark, store, ledger.open_batches())
    assert [r["id"] for r in queue.collect()] == ["d"]
    read = [r["p"] for r in queue.select(F.col("_metadata.file_path").alias("p")).distinct().collect()]
    assert read and all("batch=two" in path for path in read)
    plan = queue._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "Join" not in plan and "Exchange" not in plan
    daily.score_new(spark, store, NOW, ScoringParams())
    assert ledger.open_batches() == [] and _ids(spark, store.scores) == ["a", "b", "c", "d"]
    assert spark.read.parquet(store.scores).select("run").distinct().count() == 2


def test_interrupted_scoring_resumes(spark, tmp_path, monkeypatch):
    store, write = _store(tmp_path), sinks.append_table
    daily.store_articles(spark, store, _flat(spark, "ab"), "one", NOW)

    def stops(df, path, by=None):
        write(df, path, by)
        if path == store.scores:
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "append_table", stops)
    with pytest.raises(RuntimeError):
        daily.score_new(spark, store, NOW, ScoringParams())
    ledger = Ledger(spark, store.ledger)
    assert _ids(spark, store.scores) == ["a", "b"] and ledger.open_batches() == ["one"] and len(ledger.interrupted_runs()) == 1
    monkeypatch.setattr(sinks, "append_table", write)
    daily.store_articles(spark, store, _flat(spark, "abc"), "two", NOW)
    daily.score_new(spark, store, NOW, ScoringParams())
    assert _ids(spark, store.scores) == ["a", "b", "c"]
    assert ledger.open_batches() == [] and ledger.interrupted_runs() == []


@pytest.mark.parametrize("at", ["keys", "rejects", "ledger"])
def test_interrupted_ingest_is_stored_anew(spark, tmp_path, monkeypatch, at):
    """The second attempt runs at another time, so that its rows fall on another date."""
    store, batch = _store(tmp_path), _flat(spark, "ab").unionByName(_flat(spark, [""]).withColumn("id", F.lit(None).cast("string")))
    daily.store_articles(spark, store, _flat(spark, "a"), "zero", NOW)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(*{"keys": (KeyTable, "add"), "rejects": (daily, "note_rejects"), "ledger": (Ledger, "note")}[at], lost)
        with pytest.raises(RuntimeError):
            daily.store_articles(spark, store, batch, "one", NOW)
    assert not Ledger(spark, store.ledger).has("one")
    later = batch.withColumn("logical_date", F.date_add("logical_date", 1))
    for _ in range(2):
        daily.store_articles(spark, store, later, "one", NOW)
        assert _ids(spark, store.articles) == ["a", "b"]
        assert spark.read.parquet(store.rejects).count() == 1
    assert sorted(r["logical_date"].day for r in spark.read.parquet(store.articles).collect()) == [2, 3]


def test_replayed_stream_batch(spark, tmp_path):
    folder, store = tmp_path / "in", _store(tmp_path)
    folder.mkdir()
    (folder / "a.json").write_text('{"uri": "a"}\n{"uri": "b"\n{"uri": "c"}\n')
    lines = spark.read.text(str(folder)).select("value", "_metadata")
    for _ in range(2):
        incremental.ingest_batch(store, lines, "stream-1-0", NOW)
        assert _ids(spark, store.articles) == ["a", "c"] and spark.read.parquet(store.rejects).count() == 1
    for check in ("first", "second"):
        incremental.ingest_available(spark, store, str(folder), str(tmp_path / check), NOW).awaitTermination()
    names = [r["batch"] for r in Ledger(spark, store.ledger).entries().filter("batch <> 'stream-1-0'").collect()]
    # A stream of its own id each, so that a new checkpoint does not pass for a replay.
    assert len(set(names)) == 2 and all(len(n) == len("stream--0") + 36 and n.endswith("-0") for n in names)


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    keys = KeyTable(spark, str(tmp_path / "keys"), buckets=4)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("arrival"))
    keys.rebuild(rows.filter("id < 700").withColumn("batch", F.lit("one")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keys.unknown(rows.unionByName(rows), "two")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
        assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert sorted(int(r["id"]) for r in found.collect()) == list(range(700, 1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # What the batch itself brought in an earlier attempt is not known.
    assert keys.unknown(rows, "one").count() == 1000
    assert insert_new_keys(rows.unionByName(rows.withColumn("arrival", F.lit(1))), keys, "two").filter("arrival = 0").count() == 300
    with pytest.raises(ValueError):
        KeyTable(spark, str(tmp_path / "keys"), buckets=8)


def test_keys_of_an_older_store_are_rebuilt(spark, tmp_path):
    store = _store(tmp_path)
    old = _flat(spark, "ab").withColumn("batch", F.lit("old")).select(*daily.ARTICLES.fieldNames(), "batch")
    sinks.append_table(old, store.articles, by=["logical_date", "batch"])
    daily.store_articles(spark, store, _flat(spark, "bc"), "new", NOW)
    assert _ids(spark, store.articles) == ["a", "b", "c"]


def test_ledger_of_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.open_batches() == [] and ledger.interrupted_runs() == [] and not ledger.has("x")
    ledger.note(["x"], SCORING, NOW, "r")
    assert ledger.interrupted_runs() == ["r"] and ledger.open_batches() == []
    assert batch_name("a/b", NOW) == "a-b-2025-09-02-12-00-00-00-00" and batch_name() != batch_name()


def test_two_batches_keep_the_queue_apart(spark):
    store = queries.two_batches(spark, SF)
    early = settle(queries.stored_rows(spark, SF)).filter("published_at < timestamp'2024-01-15 00:00:00'").count()
    assert spark.read.parquet(store.scores).count() == early
