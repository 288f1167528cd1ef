import pytest
from pyspark.sql import functions as F

from tidewire.functions import timecols as TC
from tidewire.params import cutoff_hour, uri_list, unusual_uris, whitelist_setting


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(
        column(F.col("t").cast("timestamp")).cast("string").alias("x")).first()["x"]


def test_utc_to_bj(spark):
    assert one(spark, "2025-09-01 16:05:00", TC.utc_to_bj) == "2025-09-02 00:05:00"
    assert one(spark, "2025-09-01 16:05:00+00:00", TC.utc_to_bj) == "2025-09-02 00:05:00"


@pytest.mark.parametrize("text,cutoff,day", [
    ("2025-09-01 16:05:00", 6, "2025-09-01"),
    ("2025-09-01 21:59:00", 6, "2025-09-01"),
    ("2025-09-01 22:00:00", 6, "2025-09-02"),
    ("2025-02-28 21:00:00", 6, "2025-02-28"),
    ("2025-03-31 22:30:00", 6, "2025-04-01"),
    ("2025-09-01 20:00:00", 8, "2025-09-01"),
    ("2025-09-01 22:00:00", 8, "2025-09-01"),
    ("2025-09-01 23:00:00", 8, "2025-09-01"),
    ("2025-09-02 00:00:00", 8, "2025-09-02"),
])
def test_logical_date_and_range_agree(spark, text, cutoff, day):
    assert one(spark, text, lambda t: TC.logical_date_bj(t, cutoff)) == day
    rows = spark.createDataFrame([(text,)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert rows.filter(TC.in_logical_day(rows, "t", day, cutoff)).count() == 1


@pytest.mark.parametrize("text,cutoff,day", [
    ("2025-09-02 00:30:00", 6, "2025-09-01"),
    ("2025-09-02 22:00:00", 6, "2025-09-02"),
    ("2025-09-02 00:00:00", 8, "2025-09-01"),
    ("2025-09-02 01:00:00", 8, "2025-09-01"),
])
def test_previous_date(spark, text, cutoff, day):
    assert one(spark, text, lambda t: TC.prev_logical_date_str(t, cutoff)) == day


def failing(_):
    raise RuntimeError


@pytest.mark.parametrize("env,getter,hour", [
    (None, None, 6), ("8", None, 8), ("0", None, 0), ("23", None, 23), ("invalid", None, 6), ("25", None, 6),
    ("-1", None, 6), (None, lambda k: "10", 10), (None, failing, 6), ("8", lambda k: None, 8), ("8", lambda k: "x", 6),
])
def test_cutoff(monkeypatch, env, getter, hour):
    monkeypatch.delenv("BJ_CUTOFF_HOUR", raising=False)
    if env is not None:
        monkeypatch.setenv("BJ_CUTOFF_HOUR", env)
    assert cutoff_hour(getter) == hour


@pytest.mark.parametrize("text,expected", [
    ("2025-09-01T10:00:00Z", "2025-09-01 10:00:00"),
    ("2025-09-01T10:00:00+08:00", "2025-09-01 02:00:00"),
    ("2025-09-01T10:00:00-05:00", "2025-09-01 15:00:00"),
    ("2025-09-01T10:00:00", "2025-09-01 10:00:00"),
    ("2025-09-01", "2025-09-01 00:00:00"),
    ("", None), (None, None), ("garbage", None), ("2025", None), ("2025-99-01", None),
])
def test_publish_time(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(TC.parse_publish_time(F.col("t")).cast("string")).first()[0]
    assert got == expected


def test_iso_text(spark):
    assert one(spark, "2025-09-01 16:05:00", TC.iso_text) == "2025-09-02T00:05:00+08:00"
    assert one(spark, "2025-09-01 16:05:00.25", TC.iso_text) == "2025-09-02T00:05:00.250000+08:00"


def test_settings():
    assert uri_list(None) == () and uri_list("x") == () and uri_list(["b", "a", "b"]) == ("a", "b")
    assert unusual_uris(["http://a", "\thttp://b", "http://ahttp://b"]) == ["\thttp://b", "http://ahttp://b"]
    assert whitelist_setting("True", '["a"]') == (True, ["a"])
    assert whitelist_setting("nonsense", '["a"]') == (True, ["a"])
    assert whitelist_setting("False", '["a"]') == (False, [])
    assert whitelist_setting("true", "[]") == (False, [])
    assert whitelist_setting("true", "{") == (False, [])
    assert whitelist_setting("true", '{"a": 1}') == (False, [])
