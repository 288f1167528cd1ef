"""Hot keys, large sides and plans: the paths that small data would not take by itself."""

import contextlib
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions.timecols import in_logical_day, logical_date_bj
from tidewire.operators import dedup, lookup, monitor, ranking, report, scoring, select
from tidewire.plans import driver_views as V
from tidewire.sources import sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def uneven(spark, n=30000):
    """A third of the rows has key 0, a few have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 1000 != 1, F.col("id") % 500)
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    facts, dim = uneven(spark), spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    small = lookup.lookup(facts, dim, "k", "id", how)
    large = lookup.lookup(facts, dim, "k", "id", how, max_bytes=0, spread=16)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)


def test_salted_join_splits_the_hot_key(spark):
    facts, dim = uneven(spark), spark.range(0, 400).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = lookup.lookup(facts, dim, "k", "id", max_bytes=0, spread=64)
        sizes = [r["count"] for r in large.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 2.5 * sum(sizes) / 8


def test_keys_fetch_wide_rows(spark):
    facts = uneven(spark)
    keys = facts.filter("v = 3").select("id")
    want = facts.filter("v = 3").collect()
    assert sorted(lookup.rows_with_keys(facts, keys, "id").collect()) == sorted(want)
    assert sorted(lookup.rows_with_keys(facts, keys, "id", max_bytes=0).collect()) == sorted(want)


@pytest.mark.parametrize("setting", [
    {}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb"},
    {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "37"}])
def test_positions_with_ties_and_hot_group(spark, setting):
    before = {key: spark.conf.get(key) for key in setting}
    for key, value in setting.items():
        spark.conf.set(key, value)
    try:
        check_positions(spark)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def check_positions(spark):
    rows = uneven(spark)
    plain = rows.withColumn("p", F.row_number().over(Window.orderBy(F.desc("v"), "id")))
    assert ranking.numbered(rows, [F.desc("v"), F.col("id")], name="q").join(plain, "id").filter("p <> q").count() == 0
    window = Window.partitionBy("k").orderBy(F.desc("v"), "id")
    plain = rows.withColumn("p", F.row_number().over(window))
    got = ranking.numbered(rows, [F.desc("v"), F.col("id")], within="k", name="q")
    assert got.count() == rows.count()
    assert got.join(plain, "id").filter("p <> q").count() == 0


def test_group_cut_runs_before_the_shuffle(spark):
    text = plan(ranking.first_per_group(uneven(spark), ["k"], [F.col("v"), F.col("id")], 2))
    assert text.count("WindowGroupLimit") == 2


def test_large_n_per_group_takes_distributed_positions(spark):
    rows, order = uneven(spark), [F.desc("v"), F.col("id")]
    plain = rows.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    got = ranking.first_per_group(rows, ["k"], order, 1500)
    assert sorted(got.collect(), key=str) == sorted(plain.filter("p <= 1500").drop("p").collect(), key=str)
    top = ranking.numbered_top(rows, order, 1500, within="k", name="q")
    assert top.join(plain, "id").filter("p <> q").count() == 0 and top.count() == plain.filter("p <= 1500").count()
    assert [r["rank"] for r in ranking.numbered_top(rows, order, 1200).select("rank").orderBy("rank").collect()] == list(range(1, 1201))


def test_first_rows_per_group(spark):
    rows = uneven(spark)
    want = ranking.first_per_group(rows, ["k"], [F.desc("v"), F.col("id")], 3)
    got = ranking.first_rows_per_group(rows, [F.col("k")], [F.col("v")], "id", 3)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_scores_do_not_depend_on_partitions(spark):
    def run(parts):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            scored = scoring.score_articles(V.articles(spark, SF), V.trending(spark, SF), V.PARAMS, V.as_of(spark, SF))
            return sorted(report.daily_report(scored, V.articles(spark, SF)).collect(), key=str)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run("1") == run("200")


def test_concepts_fold_before_the_shuffle_without_wide_columns(spark):
    raw = scoring.raw_scores(V.articles(spark, SF), V.trending(spark, SF).select("uri", "score"), V.PARAMS)
    text = plan(raw)
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "Cartesian" not in text and "NestedLoop" not in text
    shuffled = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert "title" not in shuffled and "url" not in shuffled


def test_large_trending_table_gives_the_same_scores(spark, monkeypatch):
    rows = V.plain_articles(spark, SF)
    hot = V.trending(spark, SF).select("uri", "score")
    uris = F.col("concepts.uri")
    small = scoring.with_entity_hot(rows, hot, ["id"], uris).collect()
    monkeypatch.setattr(lookup, "payload_bytes", lambda df: lookup.MAX_BROADCAST_BYTES + 1)
    large = scoring.with_entity_hot(rows, hot, ["id"], uris)
    assert "SortMergeJoin" in plan(large)
    assert sorted(large.collect()) == sorted(small)


def test_day_filter_reaches_the_scan(spark):
    rows = V.plain_articles(spark, SF)
    text = plan(rows.filter(in_logical_day(rows, "published_at", "2024-01-10")).select("id"))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_stored_scores_are_pruned_by_date(spark, tmp_path):
    scored = V.scores(spark, SF).withColumn("logical_date", logical_date_bj(F.col("published_at")))
    sinks.append_table(scored, str(tmp_path / "s"), by="logical_date")
    stored = spark.read.parquet(str(tmp_path / "s"))
    now = V.as_of(spark, SF)
    got, want = monitor.suppression_monitor(stored, now), monitor.suppression_monitor(V.scores(spark, SF), now)
    assert got.collect() == want.collect()
    assert "PartitionFilters: [isnotnull(logical_date" in plan(got) and "logical_date#" in plan(got)
    rows = report.daily_report(stored, V.articles(spark, SF), "2024-01-10")
    assert sorted(rows.collect()) == sorted(report.daily_report(V.scores(spark, SF), V.articles(spark, SF), "2024-01-10").collect())


def test_at_most_two_per_event_and_null_events_share(spark):
    scored = V.scores(spark, SF).withColumn("event_uri", F.when(F.col("event_uri") != "ev-1", F.col("event_uri")))
    rows = report.daily_report(scored, V.articles(spark, SF))
    assert rows.groupBy("logical_date", "eventId").count().filter("count > 2").count() == 0
    ranks = rows.groupBy("logical_date").agg(F.count("*").alias("n"), F.max("rank").alias("m"), F.count_distinct("rank").alias("d"))
    assert ranks.filter("n <> m OR n <> d").count() == 0


def similar(a, b):
    stretch = (1 << 6) - 1
    return sum((a >> 6 * i) & stretch == (b >> 6 * i) & stretch for i in range(10)) >= 8


def test_near_repeats_against_all_pairs(spark):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    texts = [" ".join(words * 6)] * 40 + [" ".join(words * 6 + [f"w{i}"]) for i in range(60)]
    texts += [" ".join(f"t{i}x{j}" for j in range(20)) for i in range(30)] + ["", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: r for r in dedup.near_repeats(rows, "id", F.col("t")).collect()}
    assert len(got) == len(texts)
    assert any(r["is_repeat"] for r in got.values()) and not all(r["is_repeat"] for r in got.values())
    sigs = {i: r["sig"] for i, r in got.items()}
    for i, r in got.items():
        assert r["earliest"] == min(j for j in sigs if similar(sigs[i], sigs[j]))
        assert bin(sigs[i] ^ sigs[r["earliest"]]).count("1") <= 12


def test_similar_repeats_against_all_pairs(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.sample(pool, rng.randint(1, 12))) for _ in range(150)] + ["", None, "  ", "a a b", "B a"]
    texts += [t + " more" for t in texts[:60]] + ["hot one two three four"] * 30
    texts += [f"hot one two three four five six seven eight x{i}" for i in range(60)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: (r["earliest"], r["is_repeat"]) for r in dedup.similar_repeats(rows, "id", F.col("t")).collect()}
    sets = [frozenset((t or "").lower().split()) for t in texts]
    for i, a in enumerate(sets):
        first = min(j for j, b in enumerate(sets) if a == b or 5 * len(a & b) >= 4 * len(a | b))
        assert got[i] == (first, first < i)


def test_first_of_each(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "a")], "id int, t string")
    assert sorted(r["id"] for r in dedup.first_of_each(rows, "id", F.col("t")).collect()) == [1, 3, 4, 5]


def test_url_forms(spark):
    urls = ["https://www.Example.com/a/", "http://example.com/a#x", "http://example.com/a?utm_source=y", "http://example.com/b", None, None]
    rows = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    assert sorted(r["id"] for r in dedup.same_url_dropped(rows, "id").collect()) == [0, 3, 4, 5]


def test_whitelist_switches(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, source string")
    trusted = spark.createDataFrame([("a",)], "uri string")
    assert select.trusted_only(rows, "source", trusted).count() == 1
    assert select.trusted_only(rows, "source", trusted.limit(0)).count() == 0
    assert select.trusted_only(rows, "source", trusted, enabled=False).count() == 2


def test_event_whitelist_takes_events_once(spark):
    events = spark.createDataFrame([("e1", ["a", "b"]), ("e2", ["c"]), ("e3", None)], "uri string, source_uris array<string>")
    trusted = spark.createDataFrame([("a",), ("b",)], "uri string")
    assert [r["uri"] for r in select.events_of_sources(events, trusted).collect()] == ["e1"]
