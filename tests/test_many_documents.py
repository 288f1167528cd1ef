"""Sinks and keyword lists whose work must not fall to the driver or leave the texts."""

import hashlib

import pytest
from pyspark.sql import functions as F
from test_keywords import _check

from tidewire.operators import keywords
from tidewire.plans import queries
from tidewire.sources import files, sinks


def test_briefings_are_committed_by_tasks(spark, tmp_path, monkeypatch):
    """Hundreds of documents, some of several rows, written twice: no document is committed by the driver."""
    def refuse(*_):
        raise AssertionError("the driver commits each document")

    monkeypatch.setattr(sinks, "_write_documents", refuse)
    monkeypatch.setattr(sinks, "DOCUMENTS_PER_TASK", 40)
    folder = str(tmp_path / "brief ings")
    rows = [(f"text {i}\n\nof {i}\n" if i % 7 else None if i else "", i // 2 if i < 20 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "text string, second long").repartition(5)
    run_at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("second"))
    name = lambda second: f"2024-01-01_08-{second // 60:02d}-{second % 60:02d}_daily_briefing.md"
    sinks.write_briefings(df.withColumn("text", F.lit("earlier")), folder, run_at)
    sinks.write_briefings(df, folder, run_at)
    want = {}
    for text, second in rows:
        want.setdefault(name(second), []).append(text or "")
    for read in (files.read_recorded(spark, folder), files.read_documents(spark, folder)):
        got = {}
        for r in read.orderBy("place").collect():
            got.setdefault(r["path"].rsplit("=", 1)[1], []).append(r["value"])
        assert got.keys() == want.keys()
        assert all(sorted("\n".join(got[n]).split("\n")) == sorted("\n".join(want[n]).split("\n")) for n in want)
        assert "\n".join(got[name(100)]) == "text 100\n\nof 100\n"
    recorded = files.recorded_documents(spark, folder)
    assert {r["name"]: r["n_rows"] for r in recorded.collect()} == {n: len(t) for n, t in want.items()}
    assert sorted(r["name"] for r in files.list_documents(spark, folder).collect()) == sorted(want)
    assert not list((tmp_path / "brief ings").glob(".staged-*"))
    sinks.write_briefings(df.limit(0), folder, run_at)
    assert files.recorded_documents(spark, folder).count() == len(want)


def test_recorded_documents_do_not_go_to_the_driver(spark, tmp_path):
    """Names and paths grow with the documents: none is broadcast, and texts reach the workers in bounded batches."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "64m")
    rows = [(i, None if i == 3 else "" if i == 4 else f"text {i}\n\nof {i}\n" * (1 + i % 3)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    try:
        found = queries.briefing_sink(spark, str(tmp_path))
        assert spark.conf.get(name) == f"{8 << 20}b"
    finally:
        spark.conf.set(name, before)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    text_name = lambda i: f"2024-01-02_06-{i // 60:02d}-{i % 60:02d}_daily_briefing.md"
    assert {tuple(r) for r in found.collect()} == {(text_name(i), hashlib.md5((t or "").encode()).hexdigest()) for i, t in rows}


LISTS = [
    [], [("a", "abcd"), ("b", "é𝄞"), ("c", "漢字漢")], [("a", "a"), ("a", "zzzzkey1"), ("b", "k abc"), ("c", "abcde"), ("c", "none")],
    [("a", ""), ("b", None), ("c", "\n"), ("d", "abc")], [("a", "z" * 70 + "key1234"), ("b", "z" * 70 + "key12345"), ("c", "z" * 64), (None, "a")]]


@pytest.mark.parametrize("pairs", LISTS)
@pytest.mark.parametrize("characters,automata", [(2_000_000, 16), (50, 1000), (1, 0)])
def test_lists_in_one_automaton_in_several_and_in_none(spark, monkeypatch, pairs, characters, automata):
    monkeypatch.setattr(keywords, "AUTOMATON_CHARACTERS", characters)
    monkeypatch.setattr(keywords, "AUTOMATA", automata)
    _check(spark, pairs)


def test_stretches_do_not_leave_the_texts(spark):
    rows = spark.createDataFrame([(1, "abc abcd"), (2, None)], "id long, text string")
    listed = spark.createDataFrame([("a", "abcd")], "kind string, keyword string")
    plan = keywords.candidate_keywords(rows, "id", F.col("text"), listed)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "Join" not in plan


def test_articles_do_not_move_for_bodies_or_heads(spark):
    """Heads are looked up, and bodies join report rows, so that no row is moved with the body of a document in it."""
    plan = queries.report_json(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
