"""State of daily monitoring, observed metrics and declared columns, beyond what their queries show."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import schemas
from tidewire.operators import daily_state, monitor
from tidewire.params import ScoringParams
from tidewire.plans import daily, driver_views
from tidewire.sources import landing, sinks

SF = "/root/testdata/sf0.001"
NOW = datetime(2025, 9, 2, 12, tzinfo=timezone.utc)


def _near(rows, others):
    key = lambda r: str(r[0])
    for a, b in zip(sorted(rows, key=key), sorted(others, key=key), strict=True):
        assert list(a) == pytest.approx(list(b)) if all(isinstance(x, (int, float)) for x in a) else all(
            x == y or x == pytest.approx(y) for x, y in zip(a, b))


def _batch(spark, ids, hour, event="e"):
    lines = [(f'{{"uri": "{i}", "dateTimePub": "2025-09-0{1 + k % 2}T{hour:02}:00:00Z", "eventUri": "{event}", "sentiment": 0.{1 + k % 9}, '
              f'"source": {{"uri": "s{k % 3}", "ranking": {{"importanceRank": {1 + k}}}}}, "concepts": [{{"uri": "c/{k % 4}"}}]}}',)
             for k, i in enumerate(ids)]
    return landing.flatten_articles(landing.parse_articles(spark.createDataFrame(lines, "value string")), NOW)


def test_state_of_a_store_equals_its_history(spark, tmp_path):
    """Three runs with late rows, then a date is taken back, twice by the same deletion."""
    store, params = daily.Store(str(tmp_path / "store"), key_buckets=4), ScoringParams(routine_uris=["c/1"], category_uris=["c/2"])

    def compared():
        state = daily.read_table(spark, store.state, daily.STATE)
        scores = daily.read_table(spark, store.scores, daily.STORED_SCORES)
        for own, whole in ((daily_state.trend, monitor.suppression_trend), (daily_state.by_source, monitor.suppression_by_source),
                           (daily_state.effect, monitor.damping_effect), (daily_state.quality, monitor.quality_by_treatment)):
            _near(own(state).collect(), whole(scores).collect())
            _near(own(daily_state.compacted(state)).collect(), whole(scores).collect())
        return scores.count()

    for number, ids in enumerate(("abcdefg", "hijkl", "mno")):
        daily.store_articles(spark, store, _batch(spark, ids, 10 + number), f"b{number}", NOW)
        daily.score_new(spark, store, NOW, params)
    assert compared() == 15
    paths = {p.split("/store/")[1].split("/")[0] for p in daily.read_table(spark, store.state, daily.STATE).inputFiles()}
    assert paths == {"daily_state"}
    for _ in range(2):
        daily.delete_scores(spark, store, "2025-09-01", NOW)
        assert compared() == 6


def test_state_of_nothing(spark):
    empty = driver_views.scores(spark, SF).limit(0)
    assert daily_state.trend(daily_state.partials(empty)).count() == 0


def test_observed_run_reads_nothing_again(spark, tmp_path):
    run, folder = monitor.ObservedRun(bytes_per_token=3), str(tmp_path)
    rows = spark.createDataFrame([("选题1\n\n标题：a", "p" * 10, "2025-09-01"), ("none", "é", "2025-09-02")], "text string, prompt string, day string")
    sinks.write_stage(run.candidates(rows, F.col("day") == "2025-09-01"), folder, "2025-09-01", "prefiltered")
    sinks.write_stage(run.prompts(rows, F.col("prompt")), folder, "2025-09-01", "prompts")
    sinks.write_stage(run.briefings(rows, F.col("text")), folder, "2025-09-01", "briefings")
    sinks.write_stage(run.cards(rows, F.col("text") != ""), folder, "2025-09-01", "cards")
    found = run.metrics(spark).first().asDict()
    assert found == {"n_candidates": 2, "fallback_used": True, "n_prompts": 2, "prompt_bytes": 12, "token_estimate": 4, "n_briefings": 2,
                     "retries": 4, "is_complete": False, "n_cards": 2, "schema_validated": True, "dry_run": False}
    plan = run.metrics(spark)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_observed_run_of_nothing(spark, tmp_path):
    run, rows = monitor.ObservedRun(), spark.createDataFrame([], "text string")
    for number, observed in enumerate((run.candidates(rows, F.lit(True)), run.prompts(rows, F.col("text")),
                                       run.briefings(rows, F.col("text")), run.cards(rows, F.lit(True)))):
        observed.write.parquet(f"{tmp_path}/{number}")
    found = run.metrics(spark).first().asDict()
    assert not found["is_complete"] and found["prompt_bytes"] == found["token_estimate"] == found["retries"] == 0


def test_declarations_survive_files(spark, tmp_path):
    schema = schemas.declared(T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField(
        "flag", T.BooleanType())]), {"n": "7", "flag": "true"}, ["id", "flag"])
    old, new = str(tmp_path / "t" / "old"), str(tmp_path / "t" / "new")
    spark.createDataFrame([("a",)], "id string").write.parquet(old)
    rows = spark.createDataFrame([("b", 1, False), ("c", None, None)], "id string, n long, flag boolean")
    schemas.with_declarations(rows, schema).write.parquet(new)
    back = spark.read.parquet(new)
    assert schemas.schema_differences(back, schema) == []
    assert {f.name: f.metadata.get(schemas.DEFAULT) for f in back.schema.fields} == {"id": None, "n": "7", "flag": "true"}
    merged = schemas.read_declared(spark, str(tmp_path / "t" / "*"))
    assert sorted(map(tuple, merged.collect())) == [("a", 7, True), ("b", 1, False), ("c", None, None)]
    alone = schemas.read_declared(spark, old, schema)
    assert [tuple(r) for r in alone.collect()] == [("a", 7, True)]
    plain = spark.read.parquet(old)
    assert schemas.schema_differences(plain, schema) == [
        "id: required False instead of True", "n: missing", "flag: missing"]
