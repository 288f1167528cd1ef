"""Queries again with every small side taken for too large to broadcast, against the same SQL."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from tidewire.operators import lookup, ranking

SF = "/root/testdata/sf0.001"
NAMES = [
    "score_articles", "entity_hot_score", "daily_report", "daily_report_all_days", "report_order", "latest_articles_per_event",
    "source_whitelist", "insert_ignore", "unscored_queue", "raw_without_summary", "exact_dedup", "near_dup_simhash",
    "url_or_title_dedup", "richest_per_group", "card_picks", "digest_concat", "ingest_landed_files", "read_landed_events",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture()
def oversized(spark, monkeypatch):
    for module in (lookup, ranking):
        monkeypatch.setattr(module, "payload_bytes", lambda df: lookup.MAX_BROADCAST_BYTES + 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_shuffle_paths(spark, duck, oversized, name):
    assert differences(spark, duck, SF, contract.queries()[name], contract.oracle_sql()[name]) is None
