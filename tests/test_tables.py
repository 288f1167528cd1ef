from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.operators import tables
from tidewire.schemas import ARTICLE_SCORES, column_check, schema_differences
from tidewire.sources import landing, sinks


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_insert_is_idempotent_and_first_wins(spark):
    batch = rows(spark, [("1", "a", 0), ("1", "b", 1), ("2", "c", 2)], "id string, title string, pos int")
    empty = batch.limit(0)
    first = tables.insert_new(batch, empty, "id", [F.col("pos")])
    assert {(r["id"], r["title"]) for r in first.collect()} == {("1", "a"), ("2", "c")}
    assert tables.insert_new(batch, first, "id", [F.col("pos")]).count() == 0


def test_rejects(spark):
    batch = rows(spark, [("1", 0), (None, 1), ("2", -1), ("3", None)], "id string, total_articles_in_event int")
    kept, bad = tables.split_rejects(batch)
    assert {r["id"] for r in kept.collect()} == {"1", "3"} and bad.count() == 2


def test_upsert(spark):
    schema = "uri string, score double, updated_at timestamp"
    t = [datetime(2025, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    current = rows(spark, [("a", 1.0, t[1]), ("b", 2.0, t[0])], schema)
    updates = rows(spark, [("a", 5.0, t[0]), ("a", 4.0, t[0]), ("c", 3.0, t[2]), ("c", 9.0, t[1])], schema)
    got = {r["uri"]: r["score"] for r in tables.upsert_latest(current, updates).collect()}
    assert got == {"a": 5.0, "b": 2.0, "c": 3.0}
    again = tables.upsert_latest(tables.upsert_latest(current, updates), updates)
    assert {r["uri"]: r["score"] for r in again.collect()} == got


def test_queue_and_truncate(spark):
    articles = rows(spark, [("1",), ("2",), ("3",)], "id string")
    done, aside = rows(spark, [("1",)], "id string"), rows(spark, [("2",)], "id string")
    assert [r["id"] for r in tables.unscored(articles, done, aside).collect()] == ["3"]
    raw_ids = done.select(F.col("id").alias("raw_id"))
    assert tables.without_summary(articles, raw_ids).count() == 2
    assert tables.without_summary(articles, tables.emptied(raw_ids)).count() == 3


def test_delete_by_date_keeps_rows_without_date(spark):
    data = rows(spark, [("1", "2025-08-05 10:00:00"), ("2", "2025-08-06 10:00:00"), ("3", None)], "id string, t string")
    data = data.select("id", F.col("t").cast("timestamp").alias("collected_at"))
    assert [r["id"] for r in tables.collected_on(data, "2025-08-05").collect()] == ["1"]
    assert sorted(r["id"] for r in tables.without_collected_on(data, "2025-08-05").collect()) == ["2", "3"]


def test_added_flags_and_schema_check(spark):
    old = rows(spark, [("1", None), ("2", True)], "id string, is_suppressed boolean")
    new = tables.with_flag_defaults(old)
    assert [(r["is_suppressed"], r["is_routine_topic"]) for r in new.orderBy("id").collect()] == [(False, False), (True, False)]
    check = {r["column_name"]: (r["data_type"], r["n_values"], r["n_null"]) for r in column_check(old).collect()}
    assert check["is_suppressed"] == ("boolean", 1, 1) and check["is_routine_topic"] == (None, 0, 2)
    lines = schema_differences(old.withColumn("final_score_v2", F.lit("x")), ARTICLE_SCORES)
    assert "final_score_v2: string instead of double" in lines and "hot_norm: missing" in lines


def test_replace_dates_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, logical_date string"
    sinks.append_table(rows(spark, [(1, "2025-01-01"), (2, "2025-01-02")], schema), path, by="logical_date")
    sinks.replace_dates(rows(spark, [(3, "2025-01-02")], schema), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3]
    first = sinks.write_version(rows(spark, [(1, "x")], schema), str(tmp_path / "v"), 1)
    assert first.endswith("v=00000001")


@pytest.mark.parametrize("line,uris", [
    ('[{"uri":"a","trendingScore":{"news":{"score":1}}},{"uri":"b","trendingScore":{"news":{"score":2}}}]', {"a": 1.0, "b": 2.0}),
    ('{"trendingConcepts":[{"uri":"a","trendingScore":{"news":{"score":1}}}],"results":[{"uri":"z"}]}', {"a": 1.0}),
    ('{"trendingConcepts":[],"results":[{"uri":"b","trendingScore":{"news":{"score":2}}}]}', {"b": 2.0}),
])
def test_trending_shapes(spark, tmp_path, line, uris):
    (tmp_path / "t.json").write_text(line)
    got = landing.read_trending(spark, str(tmp_path / "t.json"), "2025-01-01T00:00:00Z")
    assert {r["uri"]: r["score"] for r in got.collect()} == uris


@pytest.mark.parametrize("line", ['{"other":1}', '{"trendingConcepts":[],"results":[]}', "[]"])
def test_trending_without_items_fails(spark, tmp_path, line):
    (tmp_path / "t.json").write_text(line)
    with pytest.raises(ValueError):
        landing.read_trending(spark, str(tmp_path / "t.json"), "2025-01-01T00:00:00Z")


def test_landed_articles(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([
        '{"uri":"1","title":"t","dateTimePub":"2025-09-01T21:59:00Z","source":{"uri":"s","ranking":{"importanceRank":7}},'
        '"eventUri":"e","concepts":[{"uri":"c","label":{"eng":"C"}}]}',
        '{"uri":"2","source":{"uri":"s"},"concepts":[],"totalArticleCountInEvent":4}',
        "{broken",
    ]))
    read = landing.read_articles(spark, str(tmp_path / "a.json"))
    assert [r[landing.CORRUPT] for r in read.collect()] == [None, None, "{broken"]
    flat = {r["id"]: r for r in landing.flatten_articles(read, "2025-09-02T00:00:00Z").collect()}
    assert flat["1"]["source_importance"] == 7 and flat["1"]["source_name"] == "s" and flat["1"]["total_articles_in_event"] == 0
    assert str(flat["1"]["logical_date"]) == "2025-09-01" and not flat["1"]["published_at_imputed"]
    assert flat["2"]["concepts"] is None and flat["2"]["source_importance"] is None
    assert flat["2"]["published_at_imputed"] and flat["2"]["published_at"] == flat["2"]["collected_at"]
