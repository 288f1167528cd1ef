"""Marks for keyword lists of any length, found by automata, or by the first characters of each keyword."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.lookup import lookup
from tidewire.session import settle

# An automaton holds so many characters of keywords, each keyword up to LONGEST of them. A list is read by AUTOMATA at most.
AUTOMATON_CHARACTERS, LONGEST, AUTOMATA = 2_000_000, 64, 16
# Texts of a batch of answers.
BATCH_ROWS = 2_000
# Keywords are found by so many first characters: the greatest number that they have.
HEADS = (8, 4, 2, 1)


def with_stretches(rows: DataFrame, key: str, text: Column, lengths: Sequence[int]) -> DataFrame:
    """``key, stretch``: the different stretches of a text of some lengths, which are among ``HEADS``.

    By doubling: a stretch is two neighbours of half its length. Each length is a projection of its own, as one that
    held the others inside would compute them again and again.
    """
    made = rows.select(key, F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)).alias("s1"))
    width = 1
    while width < max(lengths):
        half = F.col(f"s{width}")
        behind = F.slice(half, F.lit(1 + width), F.greatest(F.size(half), F.lit(0)))
        # The last ones have no neighbour and become NULL.
        made = made.withColumn(f"s{2 * width}", F.zip_with(half, behind, lambda a, b: F.concat(a, b)))
        width *= 2
    wanted = F.array_distinct(F.concat(*[F.col(f"s{n}") for n in lengths]))
    return made.select(key, F.explode(wanted).alias("stretch")).filter("stretch is not null")


def _kinds_found(rows: DataFrame, key: str, text: Column, words: list[tuple[str, list[str], list[tuple[str, str]]]]) -> DataFrame:
    """``key, certain, possible`` by one automaton; a word has the kinds that it decides and the keywords that it begins."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for number, (word, _, _) in enumerate(shared.value):
            automaton.add_word(word, number)
        automaton.make_automaton()
        certain_type = pa.list_(pa.string())
        possible_type = pa.list_(pa.struct([("kind", pa.string()), ("keyword", pa.string())]))
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                places, certain, possible = [], [], []
                for k in range(part.num_rows):
                    read = part.column(1)[k].as_py()
                    met = {number for _, number in automaton.iter(read)} if read else ()
                    if met:
                        places.append(k)
                        certain.append(sorted({kind for number in met for kind in shared.value[number][1]}))
                        possible.append([{"kind": kind, "keyword": word} for kind, word in sorted(
                            {pair for number in met for pair in shared.value[number][2]})])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(places, pa.int64())), pa.array(certain, certain_type), pa.array(possible, possible_type)],
                    names=[key, "certain", "possible"])

    narrow = rows.select(key, text.alias("__text"))
    return narrow.mapInArrow(find, f"`{key}` {narrow.schema[0].dataType.simpleString()}, certain array<string>, "
                                   "possible array<struct<kind: string, keyword: string>>")


def candidate_keywords(rows: DataFrame, key: str, text: Column, keywords: DataFrame,
                       heads: Sequence[int] = HEADS) -> DataFrame:
    """``key, certain, possible`` of the rows that a keyword may occur in, by the characters that it begins with.

    ``certain`` are the kinds with a keyword that is found whole, ``possible`` the ``kind, keyword`` of which only the first
    characters are. The texts are read where they are, by an automaton of bounded size for each part of the list, and only
    what is found leaves them. Of lists too long for that, the first of ``heads`` characters meet the stretches of the texts.
    """
    words = settle(keywords.filter("keyword <> ''").select(F.left("keyword", F.lit(LONGEST)).alias("word"), "kind", "keyword").groupBy(
        "word").agg(F.collect_set(F.when(F.col("word") == F.col("keyword"), F.col("kind"))).alias("certain"),
                    F.collect_set(F.when(F.col("word") != F.col("keyword"), F.struct("kind", "keyword"))).alias("possible")))
    size = F.length("word") + F.aggregate("possible", F.lit(0), lambda n, k: n + F.length(k["keyword"]))
    parts = -(-(words.agg(F.sum(size).alias("n")).first()["n"] or 0) // AUTOMATON_CHARACTERS)
    if 0 < parts <= AUTOMATA:
        found = None
        for part in range(parts):
            listed = words.filter(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).collect()
            if not listed:
                continue
            met = _kinds_found(rows, key, text, [(r["word"], list(r["certain"]), [tuple(k) for k in r["possible"]]) for r in listed])
            found = met if found is None else found.unionByName(met)
        return found.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("certain"))).alias("certain"),
                                      F.array_distinct(F.flatten(F.collect_list("possible"))).alias("possible"))
    head = F.coalesce(*[F.when(F.length("keyword") >= n, n) for n in sorted(heads, reverse=True)])
    index = settle(keywords.filter(F.length("keyword") >= min(heads)).select(
        F.substring(F.col("keyword"), F.lit(1), head).alias("stretch"), "kind", "keyword").distinct())
    lengths = sorted(r["n"] for r in index.select(F.length("stretch").alias("n")).distinct().collect())  # some of ``heads``
    if not lengths:
        return rows.limit(0).select(key, F.array(F.lit("")).alias("certain"), F.array(F.struct(
            F.lit("").alias("kind"), F.lit("").alias("keyword"))).alias("possible"))
    met = lookup(with_stretches(rows, key, text, lengths), index, "stretch", key, "inner")
    whole = F.col("keyword") == F.col("stretch")
    return met.groupBy(key).agg(F.collect_set(F.when(whole, F.col("kind"))).alias("certain"),
                                F.collect_set(F.when(~whole, F.struct("kind", "keyword"))).alias("possible"))


def with_listed_marks(rows: DataFrame, key: str, text: str, keywords: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """``rows`` with ``has_<kind>``: whether one of the keywords of that kind occurs in the text, as ``contains`` says.

    ``keywords`` has ``kind, keyword``; ``key`` is unique in ``rows``. Keywords whose first characters occur are looked for
    in the text itself, by one expression however long the list is. An empty keyword occurs in every text that is
    not NULL; a NULL text contains nothing; keywords of other kinds are ignored.
    """
    listed = keywords.filter(F.col("kind").isin(list(kinds)) & F.col("keyword").isNotNull())
    everywhere = {r["kind"] for r in listed.filter("keyword = ''").select("kind").distinct().collect()}
    found = settle(candidate_keywords(rows, key, F.col(text), listed))
    # Unique on both sides, so no key is hot.
    marked = rows.join(found, key, "left")

    def occurs(kind: str) -> Column:
        if kind in everywhere:
            return F.col(text).isNotNull()
        of_kind = F.filter("possible", lambda k: k["kind"] == kind)
        return F.coalesce(F.array_contains("certain", kind), F.lit(False)) | F.coalesce(
            F.exists(of_kind, lambda k: F.contains(F.col(text), k["keyword"])), F.lit(False))

    return marked.withColumns({f"has_{kind}": occurs(kind) for kind in kinds}).drop("certain", "possible")
