"""Similar sets of words against all pairs, and how many pairs are considered for it."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.operators import dedup


def _set(text):
    return frozenset(w for w in re.split("[ \t\r\n]+", (text or "").lower()) if w)


def _expected(rows, at_least):
    sets = {k: _set(t) for k, t in rows}
    earliest = {}
    for k, own in sets.items():
        near = [j for j, other in sets.items() if own == other or len(own & other) >= at_least * len(own | other) - 1e-9]
        earliest[k] = min(near)
    return sorted((k, e, e < k) for k, e in earliest.items())


def _texts(seed, n, vocabulary, longest):
    rng = random.Random(seed)
    texts = [None, "", " ", "one", "ONE  one", "one two", "one two three four five", "one two three four", "one two three four six"]
    while len(texts) < n:
        size = rng.randint(1, longest)
        words = [f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(size)]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3])):
            changed = [w if rng.random() > 0.08 else f"w{rng.randrange(vocabulary)}" for w in words]
            texts.append(" ".join(changed + [f"w{rng.randrange(vocabulary)}"] * rng.choice([0, 0, 1, 2])))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,vocabulary,longest,at_least", [(1, 50, 12, 0.8), (2, 400, 60, 0.8), (3, 30, 30, 0.6), (4, 3000, 300, 0.9)])
def test_similar_repeats(spark, seed, vocabulary, longest, at_least):
    rows = _texts(seed, 300, vocabulary, longest)
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    got = sorted(tuple(r) for r in dedup.similar_repeats(df, "id", F.col("text"), at_least).collect())
    assert got == _expected(rows, at_least)


def test_crowded_words_meet_in_parts(spark):
    """A word that hundreds of sets are entered under, in parts of seven."""
    rng = random.Random(9)
    rows = [(i, "common " + " ".join(f"w{rng.randrange(6)}" for _ in range(6))) for i in range(300)]
    _, sets = dedup.ordered_sets(spark.createDataFrame(rows, "id long, text string"), "id", F.col("text"))
    pairs = lambda crowd: sorted(map(tuple, dedup.similar_candidates(sets, crowd=crowd).collect()))
    assert pairs(7) == pairs(10_000) != []


def test_nothing_is_similar_in_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert dedup.similar_repeats(df, "id", F.col("text")).count() == 0


def test_candidates_stay_level(spark):
    """Ten times the texts of one small vocabulary give hardly more candidates per text."""
    for scale in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
        _, sets = dedup.ordered_sets(docs, "doc_id", F.col("text"))
        assert dedup.similar_candidates(sets).count() < 0.5 * sets.count()


def test_bounds_are_part_of_the_join(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, sets = dedup.ordered_sets(docs, "doc_id", F.col("text"))
    plan = dedup.similar_candidates(sets)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "meeting" in line and "bit_count" in line]
    assert joins and all("least" in line for line in joins)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_copies_are_compared_once_a_set(spark, monkeypatch):
    """Of a group of near copies, all alike, the words of each set are compared with those of one other."""
    whole = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(whole + [f"own{k}"])) for k in range(40)]
    compared, plain = [], dedup.really_similar
    monkeypatch.setattr(dedup, "really_similar", lambda pairs, *rest: compared.append(pairs.count()) or plain(pairs, *rest))
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    got = sorted(tuple(r) for r in dedup.similar_repeats(df, "id", F.col("text")).collect())
    assert got == _expected(rows, 0.8) == [(k, 0, k > 0) for k in range(40)]
    assert sum(compared) == 39


@pytest.mark.parametrize("tries", [0, 1])
def test_failed_candidates_are_followed_by_the_others(spark, monkeypatch, tries):
    """Candidates of smaller numbers that fail do not hide a similar one behind them."""
    monkeypatch.setattr(dedup, "TRIES", tries)
    monkeypatch.setattr(dedup, "WORD_BUCKETS", 64)
    rows = _texts(11, 250, 25, 25)
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    got = sorted(tuple(r) for r in dedup.similar_repeats(df, "id", F.col("text")).collect())
    assert got == _expected(rows, 0.8)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e f g h i j"), (None, "a b c d e f g h i k"), (3, "a b c d e f g h i j"), (3, "x y"), (2, "x y"), (None, "x")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted((tuple(r) for r in dedup.similar_repeats(df, "id", F.col("text")).collect()), key=str)
    assert got == sorted([(None, 3, None), (None, 3, None), (3, 3, False), (3, 2, True), (2, 2, False), (None, None, None)], key=str)
