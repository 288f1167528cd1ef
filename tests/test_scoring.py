from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.functions.concepts import concept_uris, uri_set
from tidewire.operators import monitor
from tidewire.operators.scoring import score_articles, split_unscorable, total
from tidewire.params import ScoringParams

NOW = datetime(2025, 9, 2, tzinfo=timezone.utc)
PARAMS = ScoringParams(routine_uris=["r/1"], category_uris=["k/1"])
SCHEMA = ("id string, event_uri string, source_name string, published_at timestamp, collected_at timestamp, "
          "sentiment double, source_importance int, total_articles_in_event int, concepts array<struct<uri: string>>")

# id, articles in event, rank, sentiment, concepts, hours before now
ROWS = [
    ("a1", 10, 1, -0.4, ["c/a", "c/b"], 0),
    ("a2", None, None, 0.4, ["r/1"], 1),
    ("a3", 10, 500001, None, ["r/1", "k/1"], 6),
    ("a4", 5, 2000000, 0.0, ["k/1", "c/neg"], 12),
    ("a5", 0, 0, -0.8, None, -1),
    ("a6", 3, 1000, 0.2, ["c/b", "r/1", "k/1"], 0.5),
]
COLUMNS = ["entity_hot_score", "hot_score_v2", "hot_norm_raw", "hot_norm", "rep_norm", "sent_score_v2", "sent_norm",
           "concept_hot_norm", "freshness_score", "final_score_v2"]
EXPECTED = {
    "a1": [100, 3.782431, 1, 1, 1, 0.5, 0.5, 1, 1, 0.975],
    "a2": [0, 0.693147, 0.183254, 0.183254, 0, 0.4, 0.4, 0, 0.846482, 0.211111],
    "a3": [0, 2.397895, 0.633956, 0.190187, 0.5, 0, 0, 0, 0.367879, 0.246747],
    "a4": [0, 1.791759, 0.473706, 0.236853, 0, 0, 0, 0, 0.135335, 0.103199],
    "a5": [0, 0, 0, 0, 1, 1, 1, 0, 1.18136, 0.477204],
    "a6": [10, 2.105663, 0.556696, 0.556696, 0.999001, 0.2, 0.2, 0.1, 0.920044, 0.6126],
}
FLAGS = {"a1": "B", "a2": "RB", "a3": "RCS", "a4": "CD", "a5": "B", "a6": "RCB"}


def article(row):
    key, n, rank, sentiment, concepts, hours = row
    published = None if hours is None else NOW - timedelta(hours=hours)
    listed = None if concepts is None else [(c,) for c in concepts]
    return key, "e", "s", published, NOW, sentiment, rank, n, listed


def batch(spark, rows=ROWS):
    return spark.createDataFrame([article(r) for r in rows], SCHEMA)


def hot(spark):
    return spark.createDataFrame([("c/a", 100.0), ("c/b", 10.0), ("c/neg", -5.0)], "uri string, score double")


def test_fixture(spark):
    for row in score_articles(batch(spark), hot(spark), PARAMS, NOW).collect():
        assert [row[c] for c in COLUMNS] == pytest.approx(EXPECTED[row["id"]], abs=1e-6), row["id"]
        flags = "".join(letter for letter, name in zip("RCBSD", (
            "is_routine_topic", "is_category_topic", "is_breaking_news", "is_suppressed", "is_downweighted")) if row[name])
        assert flags == FLAGS[row["id"]]
        assert row["rep_score_v2"] == row["rep_norm"]


def test_single_row_and_empty_batch(spark):
    row = score_articles(batch(spark, ROWS[:1]), hot(spark), PARAMS, NOW).first()
    assert [row["hot_norm_raw"], row["sent_norm"], row["concept_hot_norm"]] == [0.5, 0.5, 0.5]
    assert score_articles(batch(spark, []), hot(spark), PARAMS, NOW).count() == 0


def test_invariants(spark):
    rows = score_articles(batch(spark), hot(spark), PARAMS, NOW).collect()
    for row in rows:
        assert all(0 <= row[c] <= 1 for c in ("hot_norm", "hot_norm_raw", "rep_norm", "sent_norm", "concept_hot_norm"))
        assert not (row["is_suppressed"] and row["is_downweighted"])


def test_parameters(spark):
    off = score_articles(batch(spark), hot(spark), ScoringParams(routine_uris=None, category_uris="bad"), NOW)
    assert off.filter("is_routine_topic OR is_category_topic").count() == 0
    only_fresh = ScoringParams(tau_hours=1, weight_hot=0, weight_authority=0, weight_concept=0, weight_freshness=1, weight_sentiment=0)
    row = score_articles(batch(spark), hot(spark), only_fresh, NOW).filter("id = 'a2'").first()
    assert row["final_score_v2"] == pytest.approx(0.36787944)


def test_old_concepts_can_be_left_out(spark):
    aged = hot(spark).withColumn("updated_at", F.lit(NOW - timedelta(hours=30)))
    keep = score_articles(batch(spark), aged, PARAMS, NOW).agg(F.max("entity_hot_score")).first()[0]
    drop = score_articles(batch(spark), aged, ScoringParams(trending_max_age_hours=24), NOW).agg(F.max("entity_hot_score")).first()[0]
    assert (keep, drop) == (100.0, 0.0)


def test_row_without_publish_time_is_set_aside(spark):
    scored, aside = split_unscorable(score_articles(batch(spark, [*ROWS, ("a7", 1, 1, 0.1, None, None)]), hot(spark), PARAMS, NOW))
    assert scored.count() == 6 and [r["id"] for r in aside.collect()] == ["a7"]


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="sentiment"):
        score_articles(batch(spark).drop("sentiment"), hot(spark), PARAMS, NOW)
    with pytest.raises(ValueError, match="hot_norm"):
        total(batch(spark), PARAMS)
    with pytest.raises(ValueError, match="as_of"):
        score_articles(batch(spark), hot(spark), PARAMS)


@pytest.mark.parametrize("text,uris", [
    (None, []), ("[]", []), ("null", []), ("bad[", []), ('{"uri":"a"}', []), ('["x",{"uri":"a"}]', ["a"]),
    ('[{"label":"no uri"}]', []), ('[{"uri":"a"},{"uri":"a"},{"uri":"b"}]', ["a", "b"]),
])
def test_dirty_concepts(spark, text, uris):
    rows = spark.createDataFrame([(text,)], "concepts string")
    assert rows.select(uri_set(concept_uris(rows))).first()[0] == uris


def test_json_concepts_score_like_arrays(spark):
    plain = batch(spark)
    stored = plain.withColumn("concepts", F.to_json("concepts"))
    want = score_articles(plain, hot(spark), PARAMS, NOW).select("id", *COLUMNS).collect()
    got = score_articles(stored, hot(spark), PARAMS, NOW).select("id", *COLUMNS).collect()
    assert sorted(got) == sorted(want)


def test_monitor_on_empty_window(spark):
    scored = score_articles(batch(spark), hot(spark), PARAMS, NOW)
    row = monitor.suppression_monitor(scored, NOW + timedelta(days=30)).first()
    assert row["total_articles_24h"] == 0 and row["suppression_rate"] is None
    assert monitor.batch_suppression(scored.limit(0)).first()["suppressed_pct"] == 0.0
