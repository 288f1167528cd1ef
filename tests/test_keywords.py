"""Long keyword lists against ``contains``, digests by narrow rows, and the manifest of written documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.operators import keywords, lookup
from tidewire.operators.ranking import running_totals
from tidewire.sources import files, sinks

TEXTS = [None, "", "a", "ab", "abc abcd", "xabcdey", "𝄞é𝄞 漢字漢", "line\nbreak abc\n", "aaaaaa", "ABCD", "abcabcabd", "tab\tend", "z" * 5000 + "key1234"]


def _list(spark, pairs):
    return spark.createDataFrame(pairs, "kind string, keyword string")


def _check(spark, pairs, kinds=("a", "b", "c")):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    got = {r["id"]: [r[f"has_{k}"] for k in kinds] for r in keywords.with_listed_marks(rows, "id", "text", _list(spark, pairs), kinds).collect()}
    assert got == {i: [t is not None and any(w is not None and w in t for kind, w in pairs if kind == k) for k in kinds] for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("pairs", [
    [], [("a", "abcd"), ("b", "é𝄞"), ("c", "漢字漢")], [("a", "a"), ("a", "zzzzkey1"), ("b", "k abc"), ("c", "abcde"), ("c", "none")],
    [("a", ""), ("b", None), ("c", "\n"), ("d", "abc")], [("a", "abcabd"), ("a", "abcabd"), ("b", "aaaaaaa"), ("c", "cab")]])
def test_marks(spark, pairs):
    _check(spark, pairs)


def test_ten_thousand_keywords(spark):
    rng = random.Random(4)
    pairs = [(rng.choice("abc"), "".join(rng.choice("abcdéz") for _ in range(rng.randint(2, 9)))) for _ in range(10_000)]
    _check(spark, pairs)
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    marked = keywords.with_listed_marks(rows, "id", "text", _list(spark, pairs), ("a", "b", "c"))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?<!array_)contains\(", plan.lower())) == 3


def test_list_too_long_to_broadcast(spark, monkeypatch):
    how, _, spread = lookup.lookup.__defaults__
    monkeypatch.setattr(lookup.lookup, "__defaults__", (how, 0, spread))
    _check(spark, [("a", "abcd"), ("b", "abc"), ("c", "é")])


def test_stretches(spark):
    rows = spark.createDataFrame([(1, "abcabcd𝄞"), (2, None), (3, ""), (4, "ab")], "id int, t string")
    for lengths in ((1,), (2,), (4, 8), (1, 2, 4, 8)):
        want = sorted({(i, t[k:k + n]) for i, t in ((1, "abcabcd𝄞"), (4, "ab")) for n in lengths for k in range(len(t) + 1 - n)})
        assert sorted(map(tuple, keywords.with_stretches(rows, "id", F.col("t"), lengths).collect())) == want


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_totals(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice("xxxxy") if rng.random() < 0.95 else None, i, rng.randint(0, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(5)
    got = sorted(map(tuple, running_totals(df, [F.col("k")], "v", "g").collect()), key=repr)
    want, seen = [], {}
    for g, k, v in rows:
        position, total = seen.get(g, (0, 0))
        want.append((g, k, v, position + 1, total))
        seen[g] = position + 1, total + v
    assert got == sorted(want, key=repr)


def test_digest_index_points_into_the_written_text(spark, tmp_path):
    rows = spark.createDataFrame([(f"n{i:03}", "é" * (i % 7) + "\nline", "d" if i % 3 else "e") for i in range(60)] + [
        ("n999", None, "d")], "name string, text string, lang string").repartition(4)
    folder = str(tmp_path / "digests")
    sinks.write_reports_digest(files.digest_blocks(rows, F.col("lang")), [F.col("name")], folder)
    for digest in "de":
        whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "digests" / f"digest={digest}").glob("part-*")))
        index = files.digest_index(rows, [F.col("name")], F.col("lang")).filter(F.col("digest") == digest).orderBy("position").collect()
        for number, r in enumerate(index, 1):
            assert r["position"] == number
            assert whole[r["offset"]:r["offset"] + r["size"]].startswith(f"# Report: {r['name']}\n\n".encode())
        assert index[-1]["offset"] + index[-1]["size"] == len(whole)


def test_texts_of_a_digest_move_once(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("name", F.col("doc_id").cast("string"))
    blocks = files.build_digest(rows, [F.col("doc_id")], F.col("lang"), "doc_id")
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 0 and plan.count("Exchange rangepartitioning") == 0
    sorted_blocks = files.digest_blocks(rows, F.col("lang")).repartitionByRange("digest", "doc_id")
    assert sorted_blocks._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_manifest(spark, tmp_path):
    folder = str(tmp_path / "briefings")
    assert files.recorded_documents(spark, folder).count() == 0
    rows = spark.createDataFrame([("one\ntwo", "2024-01-01 00:00:00"), ("three", "2024-01-01 00:00:01")], "text string, at string")
    for _ in range(2):
        sinks.write_briefings(rows, folder, F.col("at").cast("timestamp"))
    recorded = files.recorded_documents(spark, folder)
    listed = files.list_documents(spark, folder)
    assert recorded.count() == 2 and recorded.filter("n_rows = 1").count() == 2
    assert sorted(r["name"] for r in recorded.collect()) == sorted(r["name"] for r in listed.collect())
    one = recorded.orderBy("name").first()
    assert sorted(r["value"] for r in files.read_documents(spark, one["path"]).collect()) == ["one", "two"]
    # Nothing is listed: what is not recorded is not found.
    (tmp_path / "briefings" / "file_name=2030-01-01_stray.md").mkdir()
    (tmp_path / "briefings" / "file_name=2030-01-01_stray.md" / "part-0").write_text("x")
    assert files.recorded_documents(spark, folder).count() == 2 and files.list_documents(spark, folder).count() == 3
    assert files.newest_within(files.recorded_documents(spark, folder), "2020-01-01T00:00:00Z").first()["path"] is None
