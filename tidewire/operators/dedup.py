"""Repeats: same url, similar text by the words it shares or by SimHash, richest row of a group."""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.lookup import MAX_BROADCAST_BYTES, lookup, payload_bytes, rows_with_keys
from tidewire.operators.ranking import first_rows_per_group
from tidewire.session import settle

SIMILARITY = 0.8
# Sets that are entered under one word meet in parts of this size.
CROWD = 500
# Words are counted in so many buckets, for their order.
WORD_BUCKETS = 1 << 20
# Candidates that a set tries singly after its first.
TRIES = 3
# Parity maps of a set, 64 bits each.
PARITY_MAPS = 4
# Of the wide map, which only pairs that passed the narrow one are tried by.
WIDE_MAPS = 32
BITS = 60
BANDS = 10
AGREEING = 8
_COUNTER_BITS = 30  # two bit counters share one long; a text of 2 GB has fewer than 2**30 words
_LANES = 2
_STEP = BITS // _LANES


def words(text: Column) -> Column:
    """Lower-case words; white space at either end leaves an empty one, which has no hash."""
    return F.split(F.lower(text), "[ \\t\\r\\n]+")


def word_hash(word: Column) -> Column:
    """The first 60 bits of the MD5 digest, NULL for an empty word."""
    return F.when(word != "", F.conv(F.substring(F.md5(word), 1, 15), 16, 10).cast("long"))


def signatures(df: DataFrame, key: str, text: Column) -> DataFrame:
    """60-bit SimHash per row, as (key, sig). A text without words has the signature 0.

    A bit is set if more than half of the words have it set. The words are counted bit by bit in a
    hash aggregate whose partial step runs before the shuffle.
    """
    lanes = sum(1 << (_COUNTER_BITS * lane) for lane in range(_LANES))
    exploded = df.select(key, F.explode_outer(words(text)).alias("word"))
    hashed = exploded.select(key, word_hash(F.col("word")).alias("h"))
    counted = hashed.groupBy(key).agg(
        F.count("h").alias("n"),
        *[F.sum(F.shiftright("h", i).bitwiseAND(F.lit(lanes))).alias(f"s{i}") for i in range(_STEP)],
    )
    mask = F.lit((1 << _COUNTER_BITS) - 1)
    sig = F.lit(0).cast("long")
    for bit in range(BITS):
        lane, i = divmod(bit, _STEP)
        ones = F.shiftright(f"s{i}", _COUNTER_BITS * lane).bitwiseAND(mask)
        sig = sig.bitwiseOR(F.when(ones * 2 > F.col("n"), F.lit(1 << bit)).otherwise(F.lit(0).cast("long")))
    return counted.select(key, sig.alias("sig"))


def agreement_masks(bands: int = BANDS, agreeing: int = AGREEING) -> list[int]:
    """One mask for each choice of ``agreeing`` out of ``bands`` equal stretches of the signature."""
    width = BITS // bands
    stretch = [((1 << width) - 1) << (width * b) for b in range(bands)]
    return [sum(choice) for choice in combinations(stretch, agreeing)]


def earliest_similar(sigs: DataFrame, key: str, bands: int = BANDS, agreeing: int = AGREEING) -> DataFrame:
    """For each signature the smallest key among the rows with at least 8 of 10 equal stretches.

    Two signatures are similar if at least ``agreeing`` of their ``bands`` stretches are equal, which
    implies that at least 80 % of their bits are. Similar pairs share one of the masked values, so
    the smallest key per masked value is the whole answer and no pair is ever formed. Equal
    signatures are folded first. A masked value leaves 12 bits open, so at most 4,096 signatures
    can share it, however the data look.

    Pairs that differ in three or more stretches are not similar by this rule, even where 80 % of
    their bits agree.
    """
    distinct = sigs.groupBy("sig").agg(F.min(key).alias("first"))
    masked = F.array(*[F.col("sig").bitwiseAND(F.lit(m)) for m in agreement_masks(bands, agreeing)])
    keyed = distinct.select("sig", "first", F.posexplode(masked).alias("mask_no", "masked"))
    lowest = F.min("first").over(Window.partitionBy("mask_no", "masked"))
    return keyed.withColumn("lowest", lowest).groupBy("sig").agg(F.min("lowest").alias("earliest"))


def near_repeats(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, sig, earliest, is_repeat): a repeat has a row of smaller key with 8 of 10 equal stretches.

    A quick and partial test; ``similar_repeats`` finds all texts that share 80 % of their words.
    """
    sigs = settle(signatures(df, key, text))
    marked = lookup(sigs, settle(earliest_similar(sigs, key)), "sig", spread_by=key, how="inner")
    return marked.withColumn("is_repeat", F.col("earliest") < F.col(key))


def word_bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")


def rarest_first(keyed: DataFrame) -> Callable[[Column], Column]:
    """Orders an array of sorted words by how many rows hold the words of their bucket, rarest first.

    Only the counts of ``WORD_BUCKETS`` buckets pass the driver, whatever the size of the table. Words that share a
    bucket count as equally rare, so the order is rough but the same for all rows, which is what the bounds rely on.
    """
    single = keyed.select(F.explode("words").alias("word"))
    counted = single.groupBy(word_bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(WORD_BUCKETS, dtype=np.int64)
    counts[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    kept = keyed.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(buckets: pd.Series) -> pd.Series:
        return buckets.map(lambda each: np.argsort(kept.value[each], kind="stable").astype(np.int32))

    return lambda column: F.transform(places(F.transform(column, word_bucket)), lambda i: F.get(column, i))


@F.pandas_udf(T.ArrayType(T.LongType()))
def parity_maps(buckets: pd.Series) -> pd.Series:
    """The narrow map and then the wide one, 64 bits each: every word flips the one bit of its bucket in either."""
    def of(each: np.ndarray) -> np.ndarray:
        wide = (np.bincount(each % (64 * WIDE_MAPS), minlength=64 * WIDE_MAPS) & 1).astype(np.uint8)
        narrow = wide.reshape(-1, 64 * PARITY_MAPS).sum(axis=0).astype(np.uint8) & 1
        return np.packbits(np.concatenate([narrow, wide])).view("<i8")

    return buckets.map(of)


def ordered_sets(df: DataFrame, key: str, text: Column) -> tuple[DataFrame, DataFrame]:
    """The rows as ``key, set_id``, and the different sets of words: ``set_id, number, first, size, words, bits, wide``.

    ``words`` come rarest first, ties in their own order, ``first`` is the smallest key of the set, ``bits`` and
    ``wide`` its parity maps: each word flips one bit, so that two sets differ in at least as many words as their maps in bits.
    Numbers follow the order of ``first``, NULL last. Of the rows of a set one brings its words.
    """
    marked = df.select(key, F.array_sort(F.array_distinct(F.filter(words(text), lambda w: w != ""))).alias("words"))
    keyed = settle(marked.select(key, F.md5(F.concat_ws(" ", "words")).alias("set_id"), "words").withColumn(
        "row", F.monotonically_increasing_id()))
    narrow = keyed.groupBy("set_id").agg(F.min(key).alias("first"), F.min("row").alias("row"))
    numbered = settle(narrow.orderBy(F.col("first").asc_nulls_last(), "set_id").withColumn("number", F.monotonically_increasing_id()))
    ordered = rarest_first(keyed.filter(F.size("words") > 0))
    # The numbers are broadcast while they are few; beyond that the words are shuffled, once.
    few = payload_bytes(numbered.select("row", "number")) <= MAX_BROADCAST_BYTES
    worded = keyed.filter(F.size("words") > 0).select("row", "set_id", "words")
    whole = worded.join(F.broadcast(numbered.drop("set_id")) if few else numbered.drop("set_id"), "row").withColumn(
        "maps", parity_maps(F.transform("words", word_bucket)))
    return keyed.select(key, "set_id"), settle(whole.select(
        "set_id", "number", "first", F.size("words").alias("size"), ordered(F.col("words")).alias("words"),
        F.slice("maps", 1, PARITY_MAPS).alias("bits"), F.slice("maps", PARITY_MAPS + 1, WIDE_MAPS).alias("wide")))


def least_shared(a_size: Column, b_size: Column, at_least: float) -> Column:
    """How many words two sets share at least, if they are similar."""
    return F.ceil((a_size + b_size) * (at_least / (1 + at_least)) - 1e-9).cast("int")


def similar_candidates(sets: DataFrame, at_least: float = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of set numbers that may be similar; all that are similar are among them. See ``meetings``."""
    return meetings(sets, sets, at_least, crowd).distinct()


def meetings(smaller: DataFrame, larger: DataFrame, at_least: float = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of numbers that may be similar, ``a`` of the sets in ``smaller``, ``b`` of those in ``larger``; pairs recur.

    In the order of rarity two similar sets share a word so early that enough others can follow it on both sides. The
    smaller set is entered under its first words, as many as a partner of its own size leaves open; the larger one asks
    under its first words for each class of sizes that a partner can have, with as many as that class leaves open. So
    only sets of near sizes meet. Where they meet, the places of the word bound the words they share from above, and
    their parity maps bound the words they differ in from below; a pair that fails either bound never leaves the join.
    A word under which many sets are entered is split into parts that each meet all that ask for it.
    """
    size = F.col("size")
    step = -math.log(at_least)
    size_class = lambda n: F.floor(F.log(n) / step + 1e-9).cast("int")
    narrow = ["number", "size", *[F.col("bits")[k].alias(f"bits{k}") for k in range(PARITY_MAPS)]]

    def under(rows: DataFrame, kind: Column, open_places: Column) -> DataFrame:
        each = rows.select(*narrow, kind.alias("kind"), F.posexplode(F.slice("words", 1, open_places)).alias("place", "word"))
        return each.withColumn("meeting", F.xxhash64("word", "kind")).drop("word", "kind")

    entered = under(smaller, size_class(size), size - least_shared(size, size, at_least) + 1)
    smallest = F.ceil(size * at_least - 1e-9).cast("int")
    asking = larger.withColumn("kind", F.explode(F.sequence(size_class(smallest), size_class(size))))
    # The smallest size of the class, or somewhat less; the partner is no smaller than that.
    partner = F.least(size, F.greatest(smallest, F.floor(F.exp(F.col("kind") * step)).cast("int") - 1))
    asked = under(asking, F.col("kind"), size - least_shared(size, partner, at_least) + 1)

    crowds = settle(entered.groupBy("meeting").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select(
        "meeting", F.ceil(F.col("n") / crowd).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    left = lookup(entered, crowds, "meeting", "number").withColumn("part", F.pmod(F.xxhash64("number"), parts).cast("int")).drop("parts")
    right = lookup(asked, crowds, "meeting", "number").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    a, b = left.alias("a"), right.alias("b")
    shared = least_shared(F.col("a.size"), F.col("b.size"), at_least)
    ordered = (F.col("a.size") < F.col("b.size")) | (
        (F.col("a.size") == F.col("b.size")) & (F.col("a.number") < F.col("b.number")))
    follow = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place"))
    differ = sum((F.bit_count(F.col(f"a.bits{k}").bitwiseXOR(F.col(f"b.bits{k}"))) for k in range(PARITY_MAPS)), F.lit(0))
    bound = (follow >= shared) & (differ <= F.col("a.size") + F.col("b.size") - 2 * shared)
    met = a.join(b, (F.col("a.meeting") == F.col("b.meeting")) & (F.col("a.part") == F.col("b.part")) & ordered & bound)
    return met.select(F.col("a.number").alias("a"), F.col("b.number").alias("b"))


def really_similar(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    """Those of the pairs ``later, earlier`` whose words, compared in full, are similar.

    Words are fetched only for pairs whose wide parity maps leave that open.
    """
    def asked(pairs: DataFrame, *names: str) -> Callable[[str], DataFrame]:
        wanted = settle(pairs.select(F.col("later").alias("number")).union(pairs.select("earlier")).distinct())
        kept = rows_with_keys(sets.select("number", *names), wanted, "number", "left_semi")
        return lambda side: kept.select(F.col("number").alias(side), *[F.col(n).alias(f"{side}_{n}") for n in names])

    maps = asked(pairs, "size", "wide")
    differ = F.aggregate(F.zip_with("later_wide", "earlier_wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
    most = F.col("later_size") + F.col("earlier_size") - 2 * least_shared(F.col("later_size"), F.col("earlier_size"), at_least)
    pairs = settle(pairs.join(maps("later"), "later").join(maps("earlier"), "earlier").filter(differ <= most).select("later", "earlier"))
    side = asked(pairs, "words")
    whole = pairs.join(side("later"), "later").join(side("earlier"), "earlier")
    shared = F.size(F.array_intersect("later_words", "earlier_words"))
    return whole.filter(shared >= least_shared(F.size("later_words"), F.size("earlier_words"), at_least)).select("later", "earlier")


def earliest_links(sets: DataFrame, at_least: float = SIMILARITY) -> DataFrame:
    """(later, earlier): for each set that is similar to one of a smaller number the smallest such number.

    Every set first tries its smallest candidate; where that is similar, the others cannot matter, so a group of copies
    costs one comparison a set and no pair of it leaves the join. Sets whose first try fails meet the others again;
    they try the next ones singly ``TRIES`` times, then all that are left.
    """
    later, earlier = F.greatest("a", "b").alias("later"), F.least("a", "b").alias("earlier")
    smallest = lambda pairs: settle(pairs.groupBy("later").agg(F.min("earlier").alias("earlier")))
    tried = smallest(meetings(sets, sets, at_least).select(later, earlier))
    found = settle(really_similar(tried, sets, at_least))
    failed = settle(tried.join(found, "later", "left_anti").withColumnRenamed("earlier", "after"))
    if failed.isEmpty():
        return found
    again = rows_with_keys(sets, failed.select(F.col("later").alias("number")), "number", "left_semi")
    met = meetings(again, sets, at_least).union(meetings(sets, again, at_least)).select(later, earlier)
    left = settle(met.join(failed, "later").filter("earlier > after").select("later", "earlier").distinct())
    for _ in range(TRIES):
        tried = smallest(left)
        new = settle(really_similar(tried, sets, at_least))
        found = found.union(new)
        over = tried.withColumnRenamed("earlier", "after")
        left = settle(left.join(over, "later").filter("earlier > after").select("later", "earlier").join(new, "later", "left_anti"))
        if left.isEmpty():
            return found
    return found.union(really_similar(left, sets, at_least).groupBy("later").agg(F.min("earlier").alias("earlier")))


def similar_repeats(df: DataFrame, key: str, text: Column, at_least: float = SIMILARITY) -> DataFrame:
    """(key, earliest, is_repeat) by the Jaccard similarity of the sets of words.

    ``earliest`` is the smallest key among the rows with a similarity of ``at_least`` to the row, itself
    included; none is missed: see ``meetings`` and ``earliest_links``. Equal sets are one set from the start; only the
    words of candidates are fetched, and compared in full. A row without words is alike to all such rows.
    """
    keyed, sets = ordered_sets(df, key, text)
    links = earliest_links(sets, at_least)
    named = sets.select("number", "set_id", "first")
    nearest = links.join(named.select(F.col("number").alias("later"), "set_id"), "later").join(
        named.select(F.col("number").alias("earlier"), F.col("first").alias("linked")), "earlier").select("set_id", "linked")
    # Rows of a set of their own need its first key, all others also that of their links.
    firsts = settle(keyed.groupBy("set_id").agg(F.min(key).alias("first")).join(nearest, "set_id", "left").select(
        "set_id", F.least("first", "linked").alias("earliest")))
    told = lookup(keyed, firsts, "set_id", spread_by=key, how="inner")
    return told.select(key, "earliest", (F.col("earliest") < F.col(key)).alias("is_repeat"))


def normal_url(url: Column) -> Column:
    """Url without scheme, ``www.``, fragment, tracking query and trailing slash, in lower case."""
    bare = F.regexp_replace(F.lower(F.trim(url)), r"^https?://(www\.)?", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    bare = F.regexp_replace(bare, r"[?&](utm_[a-z]+|ref)=[^&]*", "")
    return F.regexp_replace(bare, "/+$", "")


def first_of_each(df: DataFrame, key: str, value: Column) -> DataFrame:
    """The row with the smallest unique ``key`` of each value; rows without a value all stay.

    Only values that occur more than once are looked up, so that the rows stay where they are
    unless there are very many of them.
    """
    valued = df.withColumn("__value", value)
    repeated = valued.filter(F.col("__value").isNotNull()).groupBy("__value").agg(
        F.min(key).alias("__first"), F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    marked = lookup(valued, settle(repeated), "__value", spread_by=key)
    return marked.filter(F.col("__first").isNull() | (F.col("__first") == F.col(key))).select(*df.columns)


def same_url_dropped(df: DataFrame, key: str, url: str = "url") -> DataFrame:
    """The first row by ``key`` of each normalised url."""
    return first_of_each(df, key, normal_url(F.col(url)))


def exact_repeats_dropped(df: DataFrame, key: str, text: str) -> DataFrame:
    """The first row by ``key`` of each text, compared by a 256-bit digest."""
    return first_of_each(df, key, F.sha2(F.col(text), 256))


def repeats_dropped(df: DataFrame, key: str, url: str = "url", title: str = "title") -> DataFrame:
    """Rows without an earlier row of the same url or a similar title."""
    similar = settle(similar_repeats(df, key, F.col(title)).filter("is_repeat").select(key))
    return rows_with_keys(same_url_dropped(df, key, url), similar, key, "left_anti")


def richest_per_group(df: DataFrame, group: str, key: str, body: str = "body") -> DataFrame:
    """One row per group: the one with the longest body."""
    return first_rows_per_group(df, [F.col(group)], [F.length(body)], key)
