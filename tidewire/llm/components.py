"""Connected components of links of any number, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators.lookup import lookup
from tidewire.session import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours; the sums are partial, so a hub costs nothing extra."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _pointed(edges: DataFrame, which: str) -> DataFrame:
    """The ends ``v`` of some links, linked to the smallest neighbour of ``u``; the links of a hub are spread."""
    met = lookup(edges.filter(which), settle(_least(edges)), "u", spread_by="v", how="inner")
    return settle(met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of undirected links ``u, v``; the component is the smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to the smallest
    neighbour it has, then its smaller neighbours to the smallest of them. Each step is an aggregate with
    partial sums and a lookup of its result, in which the links of a hub are spread; the rounds grow with the
    logarithm of the nodes. Every step is stored in the shared folder. Links with a null end and links of a node to itself count for nothing.
    """
    edges = settle(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    last = None
    while True:
        now = _fingerprint(edges)
        if now == last or now[0] == 0:
            break
        last = now
        both = _both_ways(edges)
        large = _pointed(both, "v > u")
        small = _pointed(large, "v < u")
        edges = settle(small.union(_least(large).select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    # Every node but the smallest of its component now points at it.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
