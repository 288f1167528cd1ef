import json
import os
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewire.operators.report import report_documents, report_lines
from tidewire.params import ReportParams
from tidewire.sources import files, sinks

NOW = datetime(2025, 9, 3, 1, 2, 3, tzinfo=timezone.utc)
REPORTS = {"summary_2025-09-01_scheduled_06-00-00.json": 100, "summary_2025-09-01_manual_08-00-00.json": 300,
           "summary_2025-09-02_scheduled_06-00-00.json": 200, "other_2025-09-01_x.json": 900}
BRIEFINGS = {"2025-09-01_07-00-00_daily_briefing.md": 100, "2025-09-01_notes.md": 300, "2025-09-02_notes.md": 400}


@pytest.fixture()
def folder(tmp_path):
    for name, age in {**REPORTS, **BRIEFINGS}.items():
        file = tmp_path / name
        file.write_text(f"text of {name}")
        os.utime(file, (1_756_800_000 + age, 1_756_800_000 + age))
    return tmp_path


def listed(spark, folder, pattern):
    return files.list_files(spark, str(folder), pattern)


@pytest.mark.parametrize("args,name", [
    (dict(strategy="by_ds", date="2025-09-02"), "summary_2025-09-02_scheduled_06-00-00.json"),
    (dict(strategy="by_ds", date="2025-09-01"), "summary_2025-09-01_manual_08-00-00.json"),
    (dict(strategy="latest_any"), "summary_2025-09-01_manual_08-00-00.json"),
    (dict(strategy="by_ds_then_latest", date="2025-09-02"), "summary_2025-09-02_scheduled_06-00-00.json"),
    (dict(strategy="by_ds_then_latest", date="2025-01-01"), "summary_2025-09-01_manual_08-00-00.json"),
    (dict(strategy="by_ds", date="2025-09-01", date_override="2025-09-02"), "summary_2025-09-02_scheduled_06-00-00.json"),
    (dict(strategy="by_ds", date="2025-01-01", any_date=True), "summary_2025-09-01_manual_08-00-00.json"),
    (dict(strategy="by_ds", explicit="other_2025-09-01_x.json"), "other_2025-09-01_x.json"),
])
def test_report_choice(spark, folder, args, name):
    assert files.report_path(listed(spark, folder, "*.json"), **args).endswith(name)


def test_report_choice_fails(spark, folder):
    reports = listed(spark, folder, "*.json")
    with pytest.raises(FileNotFoundError):
        files.report_path(reports, "by_ds", "2025-01-01")
    with pytest.raises(FileNotFoundError):
        files.report_path(reports, "by_ds", explicit="absent.json")
    with pytest.raises(ValueError):
        files.newest_report(reports, "newest")


def test_fallback_window(spark, folder):
    reports = listed(spark, folder, "*.json")
    late = datetime.fromtimestamp(1_756_800_000 + 3600 * 47, timezone.utc)
    too_late = datetime.fromtimestamp(1_756_800_000 + 3600 * 49, timezone.utc)
    assert files.newest_within(reports, late).first()["path"].endswith("manual_08-00-00.json")
    assert files.newest_within(reports, too_late).first()["path"] is None


@pytest.mark.parametrize("args,names", [
    (dict(strategy="latest_any"), ["2025-09-02_notes.md"]),
    (dict(strategy="by_date", date="2025-09-01"), ["2025-09-01_07-00-00_daily_briefing.md", "2025-09-01_notes.md"]),
    (dict(date="2025-09-01"), ["2025-09-01_07-00-00_daily_briefing.md"]),
    (dict(date="2025-09-02"), ["2025-09-02_notes.md"]),
    (dict(date="2025-09-01", any_date=True), ["2025-09-02_notes.md"]),
    (dict(explicit=["2025-09-02_notes.md", "2025-09-01_notes.md"]), ["2025-09-02_notes.md", "2025-09-01_notes.md"]),
])
def test_briefing_choice(spark, folder, args, names):
    paths = files.briefing_paths(listed(spark, folder, "*.md"), **args)
    assert [p.rsplit("/", 1)[1] for p in paths] == names


def test_briefing_choice_fails(spark, folder):
    texts = listed(spark, folder, "*.md")
    with pytest.raises(FileNotFoundError):
        files.briefing_paths(texts, date="2025-01-01")
    with pytest.raises(FileNotFoundError):
        files.briefing_paths(texts, explicit="absent.md")


def joined(folder: Path) -> str:
    return "".join(p.read_text(encoding="utf-8") for p in sorted(folder.glob("part-*")))


def test_digest_on_disk(spark, folder):
    paths = files.briefing_paths(listed(spark, folder, "*.md"), "by_date", "2025-09-01")
    texts = files.read_texts(spark, paths)
    blocks = files.build_digest(texts, [F.col("name")])
    sinks.write_digest(blocks, str(folder / "digest"))
    want = "".join(f"# Report: {n}\n\ntext of {n}\n\n---\n\n" for n in sorted(BRIEFINGS) if n.startswith("2025-09-01"))
    assert joined(folder / "digest" / "digest=all") == want
    assert files.build_digest(texts.limit(0), [F.col("name")]).count() == 0


def report_rows(spark, n=25):
    return spark.range(1, n + 1).select(
        F.lit("2025-09-01").cast("date").alias("logical_date"), F.col("id").alias("rank"),
        F.round(1 / F.col("id"), 4).alias("score"), F.lit("s").alias("source"), F.concat(F.lit('标题 "q" '), "id").alias("title"),
        F.lit(None).cast("string").alias("url"), F.lit("2025-09-01T08:00:00+08:00").alias("publishedAt"),
        F.lit("e").alias("eventId"), F.lit("line\nbreak").alias("body"))


def test_report_on_disk_is_one_json_document(spark, tmp_path):
    lines = report_lines(report_rows(spark), NOW, ReportParams(data_source="x"))
    root = str(tmp_path / "r")
    for run_type, minute in (("manual", 1), ("manual", 1), ("scheduled", 2)):
        sinks.write_report(lines.repartition(5), root, run_type, F.lit(f"2025-09-03 01:0{minute}:03").cast("timestamp"))
    found = files.list_documents(spark, root)
    names = sorted(r["name"] for r in found.collect())
    assert names == ["summary_2025-09-01_manual_01-01-03.json", "summary_2025-09-01_scheduled_01-02-03.json"]
    path = files.report_path(found, "by_ds", "2025-09-01")
    assert path.endswith(names[1])
    text = "".join(r["value"] for r in files.read_documents(spark, path).orderBy("place").collect())
    document = json.loads(joined(tmp_path / "r" / f"file_name={names[0]}"))
    assert json.loads(text) == document
    assert document["reportMetadata"] == {
        "reportGeneratedAt": "2025-09-03T01:02:03.000000+00:00", "reportForDate": "2025-09-01", "articleCount": 25, "dataSource": "x"}
    assert [a["rank"] for a in document["articles"]] == list(range(1, 26))
    assert document["articles"][2] == {
        "rank": 3, "score": 0.3333, "source": "s", "title": '标题 "q" 3', "url": None,
        "publishedAt": "2025-09-01T08:00:00+08:00", "eventId": "e", "body": "line\nbreak"}


def test_report_document_of_top_k(spark):
    row = report_documents(report_rows(spark), NOW, 10).first()
    document = json.loads(row["document"])
    assert row["article_count"] == 10 and [a["rank"] for a in document["articles"]] == list(range(1, 11))
    assert report_lines(report_rows(spark, 0), NOW).count() == 0


def test_stages_and_daily_append(spark, tmp_path):
    root = str(tmp_path)
    folder = sinks.write_stage(report_rows(spark, 3), root, "2025-09-01", "prefiltered")
    assert folder.endswith("prefiltered_20250901") and spark.read.json(folder).count() == 3
    day = spark.createDataFrame([("2025-09-01", "## a\n")], "date string, text string")
    sinks.append_daily(day, root + "/daily")
    sinks.append_daily(day.withColumn("text", F.lit("## b\n")), root + "/daily")
    text = "".join(p.read_text() for p in (tmp_path / "daily" / "date=2025-09-01").glob("part-*"))
    assert "## a" in text and "## b" in text
    sinks.write_briefings(day.select("text"), root + "/briefings", F.lit(NOW))
    assert (tmp_path / "briefings" / "file_name=2025-09-03_09-02-03_daily_briefing.md").is_dir()
