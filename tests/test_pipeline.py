import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.params import ReportParams, ScoringParams, SelectionParams
from tidewire.plans import daily, driver_views, queries
from tidewire.session import released, settle
from tidewire.streaming.incremental import run_incremental

NOW = datetime(2025, 9, 2, 12, tzinfo=timezone.utc)
SELECTION = SelectionParams(articles_per_event=2)


def iso(hours):
    return (NOW - timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ")


def article(uri, event, hours, **more):
    return {"uri": uri, "title": f"title {uri}", "body": f"body {uri}", "url": f"https://x.com/{uri}", "dateTimePub": iso(hours),
            "sentiment": -0.2, "source": {"uri": "s1", "ranking": {"importanceRank": 10}}, "eventUri": event,
            "concepts": [{"uri": "c/a", "type": "org"}], **more}


def event(uri, n, hours, lang="eng", sources=("s1",)):
    return {"uri": uri, "lang": lang, "eventDate": iso(hours), "totalArticleCount": n, "sourceUris": list(sources)}


def land(folder, name, objects, file="part-0.json"):
    (folder / name).mkdir(parents=True, exist_ok=True)
    (folder / name / file).write_text("\n".join(json.dumps(o) for o in objects))


@pytest.fixture()
def landed(tmp_path):
    folder = tmp_path / "landed"
    land(folder, "events", [event("e1", 10, 2), event("e2", 5, 1), event("e3", 2, 1), event("e4", 9, 1, lang="deu"), event("e5", 9, 50)])
    land(folder, "articles", [
        article("a1", "e1", 1), article("a2", "e1", 2), article("a3", "e1", 3), article("a1", "e1", 1), article("a4", "e2", 1),
        article("a5", "e3", 1), article("a6", "e4", 1), article(None, "e2", 2), article("a7", "e2", 4, concepts=[])])
    land(folder, "trending", [{"trendingConcepts": [
        {"uri": "c/a", "type": "org", "trendingScore": {"news": {"score": 50}}},
        {"uri": "c/w", "type": "wiki", "trendingScore": {"news": {"score": 90}}}]}])
    return folder


def stored_ids(spark, store):
    return sorted(r["id"] for r in spark.read.parquet(store.articles).select("id").collect())


def test_daily_run_and_rerun(spark, tmp_path, landed):
    store = daily.Store(str(tmp_path / "store"))
    run = dict(scoring_params=ScoringParams(), selection=SELECTION, report_params=ReportParams())
    daily.run_day(spark, store, str(landed), "2025-09-02", NOW, **run)
    assert stored_ids(spark, store) == ["a1", "a2", "a4", "a7"]
    assert spark.read.parquet(store.rejects).count() == 1
    scores = {r["id"]: r for r in spark.read.parquet(store.scores).collect()}
    assert set(scores) == {"a1", "a2", "a4", "a7"}
    assert scores["a1"]["total_articles_in_event"] == 10 and scores["a1"]["entity_hot_score"] == 50 and scores["a7"]["entity_hot_score"] == 0
    trending, version = daily.read_trending(spark, store)
    assert [r["uri"] for r in trending.collect()] == ["c/a"] and version == 1

    parts = sorted((tmp_path / "store" / "reports").glob("file_name=summary_2025-09-02_scheduled_*/part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert document["reportMetadata"]["articleCount"] == 4
    assert [a["rank"] for a in document["articles"]] == [1, 2, 3, 4] and document["articles"][0]["body"] == "body a1"

    later = NOW + timedelta(hours=1)
    daily.ingest(spark, store, f"{landed}/articles", f"{landed}/events", later, SELECTION)
    daily.score_new(spark, store, later, ScoringParams())
    assert stored_ids(spark, store) == ["a1", "a2", "a4", "a7"]
    assert spark.read.parquet(store.scores).count() == 4

    land(landed, "trending", [{"uri": "c/b", "type": "loc", "trendingScore": {"news": {"score": 7}}}])
    daily.refresh_trending(spark, store, f"{landed}/trending", later, SELECTION)
    trending, version = daily.read_trending(spark, store)
    assert {r["uri"]: r["score"] for r in trending.collect()} == {"c/a": 50.0, "c/b": 7.0} and version == 2


def test_command_line(spark, tmp_path, landed):
    daily.main(["--root", str(tmp_path / "store"), "--landed", str(landed), "--day", "2025-09-02", "--now", NOW.isoformat(),
                "--selection", '{"articles_per_event": 1}', "--scoring", '{"routine_uris": ["c/a"]}'])
    rows = spark.read.parquet(str(tmp_path / "store" / "article_scores")).select("id", "is_routine_topic").collect()
    assert sorted(tuple(r) for r in rows) == [("a1", True), ("a4", True)]


def test_whitelist_and_empty_report(spark, tmp_path, landed):
    store = daily.Store(str(tmp_path / "store"))
    nobody = spark.createDataFrame([("other",)], "uri string")
    daily.run_day(spark, store, str(landed), "2025-09-02", NOW, selection=SELECTION, trusted=nobody)
    assert daily.read_table(spark, store.articles, daily.ARTICLES).count() == 0
    assert not (tmp_path / "store" / "reports").exists()


def test_incremental_runs(spark, tmp_path):
    folder, store = tmp_path / "in", daily.Store(str(tmp_path / "store"))
    land(tmp_path, "in", [article("a1", "e1", 1), article("a2", "e1", 2, dateTimePub="bad")])
    args = (store, str(folder), str(tmp_path / "check"))
    run_incremental(spark, *args, NOW)
    assert stored_ids(spark, store) == ["a1", "a2"]
    land(tmp_path, "in", [article("a2", "e1", 2), article("a3", "e1", 3)], "part-1.json")
    run_incremental(spark, *args, NOW + timedelta(hours=6))
    assert stored_ids(spark, store) == ["a1", "a2", "a3"]
    scores = spark.read.parquet(store.scores)
    assert scores.count() == 3 and scores.agg(F.count_distinct("scored_as_of")).first()[0] == 2
    run_incremental(spark, *args, NOW + timedelta(hours=7))
    assert spark.read.parquet(store.scores).count() == 3


def test_run_leaves_no_intermediate_tables(spark, tmp_path):
    with released(spark):
        inside = settle(spark.range(5))
        path = inside.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")
        assert inside.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_views_follow_their_input(spark, tmp_path):
    root = str(tmp_path)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(100).write.parquet(f"{root}/events.parquet")
    assert driver_views.scores(spark, root).count() == 100
    events.limit(300).write.mode("overwrite").parquet(f"{root}/events.parquet")
    assert driver_views.scores(spark, root).count() == 300


def test_first_of_batch_by_folder(spark, tmp_path, monkeypatch):
    """Both folders are written by many tasks, and the first folder wins for every article."""
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("t"), "id").alias("title"),
                                   F.lit("2024-01-01 00:00:00").cast("timestamp").alias("published_at")).repartition(4)
    monkeypatch.setattr(driver_views, "plain_articles", lambda spark, sf: rows)
    monkeypatch.setattr(queries, "scratch", lambda spark, name: str(tmp_path / name))
    found = {r["id"]: r["title"] for r in queries.first_of_batch(spark, "").collect()}
    assert found == {str(i): f"t{i}" for i in range(200)}
    for name in "ab":
        assert len(list((tmp_path / "landed" / name).glob("part-*"))) == 4
