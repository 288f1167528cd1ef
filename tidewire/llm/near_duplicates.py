"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of, short_slices
from tidewire.llm.components import connected_components
from tidewire.llm.hashing import WordHasher, mixed
from tidewire.operators.lookup import lookup
from tidewire.session import settle

SHINGLE, THRESHOLD = 5, 0.8
# 16 bands of 4 samples: two texts of weighted Jaccard similarity 0.8 share a band with probability 0.9998.
BANDS, ROWS = 16, 4
# Document frequencies of words are counted in so many hash buckets.
FREQUENCY_BITS = 18
# Weights are powers of 2 ** (1 / STEPS); a shingle and its level share one 64-bit value.
STEPS, LEVEL_BITS = 4, 7
_ZERO_LEVEL = 32
_DRAW_BITS = 16
_LONG = 20_000
# A pair is compared in full if so much of the agreement of samples that the threshold lets expect is there:
# at the threshold itself that fails with probability 3e-5.
MIN_AGREEMENT = 0.75
# Members of a bucket are considered in blocks of this many.
BLOCK = 256
_SHINGLE_FACTORS = mixed(np.arange(1, 4096, dtype=np.uint64)) | np.uint64(1)


def word_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many documents each bucket of words occurs. The result has 2 ** FREQUENCY_BITS entries at any size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(), np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
        for batch in short_slices(batches):
            hashes, borders = hasher(next(columns_of(batch, "text")))
            bucket = (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)
            owner = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
            once = np.unique((owner << FREQUENCY_BITS) | bucket)
            total += np.bincount(once & ((1 << FREQUENCY_BITS) - 1), minlength=len(total))
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counts = rows.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
    found[counts["bucket"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy(dtype=np.int64)
    return found


class ShingleVectors:
    """Weighted shingles of texts. A weight is the count of a shingle times the mean IDF of its words."""

    def __init__(self, frequencies: np.ndarray, documents: int, size: int = SHINGLE):
        self.size, self.hasher = size, WordHasher()
        self.idf = np.log1p(documents / (1.0 + frequencies))

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text its distinct shingles as sorted values: shingle above, level of the weight below."""
        hashes, borders = self.hasher(texts)
        idf = np.concatenate([[0.0], np.cumsum(self.idf[(hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)])])
        for start, end in zip(borders[:-1], borders[1:]):
            n = min(self.size, end - start)
            if n == 0:
                yield np.zeros(0, dtype=np.uint64)
                continue
            count = end - start - n + 1
            shingles = np.zeros(count, dtype=np.uint64)
            for k in range(n):
                shingles += hashes[start + k:start + k + count] * _SHINGLE_FACTORS[k]
            weight = (idf[start + n:end + 1] - idf[start:end - n + 1]) / n
            shingles, first, times = np.unique(
                mixed(shingles) >> np.uint64(LEVEL_BITS), return_index=True, return_counts=True)
            level = np.rint(STEPS * np.log2(times * np.maximum(weight[first], 1e-6))).astype(np.int64) + _ZERO_LEVEL
            yield (shingles << np.uint64(LEVEL_BITS)) | np.clip(level, 0, (1 << LEVEL_BITS) - 1).astype(np.uint64)


WEIGHTS = 2.0 ** ((np.arange(1 << LEVEL_BITS) - _ZERO_LEVEL) / STEPS)
_LEVEL_MASK = np.uint64((1 << LEVEL_BITS) - 1)


def weights_of(vector: np.ndarray) -> np.ndarray:
    return WEIGHTS[(vector & _LEVEL_MASK).astype(np.int64)]


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over the sum of the larger weights."""
    _, i, j = np.intersect1d(a >> np.uint64(LEVEL_BITS), b >> np.uint64(LEVEL_BITS), assume_unique=True, return_indices=True)
    wa, wb = weights_of(a), weights_of(b)
    common = np.minimum(wa[i], wb[j]).sum()
    return float(common / (wa.sum() + wb.sum() - common)) if len(a) and len(b) else 0.0


class WeightedSampler:
    """Improved consistent weighted sampling (Ioffe, 2010).

    Sample j of shingle k with weight w draws r, c from Gamma(2, 1) and beta from U(0, 1), the same in every
    text; t = floor(ln w / r + beta) and ln a = ln c - r (t - beta + 1). The shingle of the least a, with its
    t, is the sample. Draws come from a table of 2 ** 16 rows, which a hash of shingle and sample picks; as
    weights have few levels, ln a is tabled too.
    """

    def __init__(self, samples: int = BANDS * ROWS):
        random = np.random.default_rng(7)
        size = 1 << _DRAW_BITS
        r, c, beta = random.gamma(2, 1, size), random.gamma(2, 1, size), random.random(size)
        self.r, self.beta, self.log_weight = r, beta, np.log(WEIGHTS)
        self.log_a = np.concatenate([
            (np.log(c) - r * (np.floor(w / r + beta) - beta + 1)).astype(np.float32) for w in self.log_weight])
        self.factors = (mixed(np.arange(1, samples + 1, dtype=np.uint64)) | np.uint64(1))[:, None]

    def __call__(self, vector: np.ndarray) -> np.ndarray:
        """The 64-bit samples of a text; equal values are equal samples."""
        least = found = None
        for k in range(0, len(vector), _LONG):
            part = vector[k:k + _LONG]
            shingle, level = part >> np.uint64(LEVEL_BITS), (part & _LEVEL_MASK).astype(np.int64) << _DRAW_BITS
            draw = ((shingle * self.factors) >> np.uint64(64 - _DRAW_BITS)).astype(np.int64) + level
            log_a = self.log_a[draw]
            at = log_a.argmin(axis=1)
            row = np.arange(len(at))
            drawn, weight = draw[row, at] & ((1 << _DRAW_BITS) - 1), self.log_weight[draw[row, at] >> _DRAW_BITS]
            t = np.floor(weight / self.r[drawn] + self.beta[drawn]).astype(np.int64)
            value = shingle[at] + t.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            if least is None:
                least, found = log_a[row, at], value
            else:
                better = log_a[row, at] < least
                least, found = np.where(better, log_a[row, at], least), np.where(better, value, found)
        return found


def band_keys(samples: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = samples.reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(parts.shape[1]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return keys.view(np.int64)


def _signatures(rows: DataFrame, frequencies: np.ndarray, documents: int, size: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((frequencies, documents))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sampler = ShingleVectors(*shared.value, size), WeightedSampler()
        for batch in short_slices(batches):
            keys, texts = columns_of(batch, "key", "text")
            kept, bands, marks, weights = [], [], [], []
            for key, vector in zip(keys, vectors(texts)):
                if len(vector):
                    kept.append(key)
                    samples = sampler(vector)
                    bands.append(band_keys(samples))
                    marks.append((mixed(samples) >> np.uint64(56)).astype(np.uint8).view(np.int8))
                    weights.append(weights_of(vector).sum())
            flat = np.concatenate(bands) if bands else np.zeros(0, dtype=np.int64)
            small = np.concatenate(marks) if marks else np.zeros(0, dtype=np.int8)
            offsets = np.arange(len(kept) + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.string()), pa.ListArray.from_arrays(pa.array(offsets * BANDS), pa.array(flat)),
                 pa.ListArray.from_arrays(pa.array(offsets * (BANDS * ROWS)), pa.array(small)), pa.array(weights, pa.float64())],
                names=["key", "bands", "marks", "weight"])

    return rows.select("key", "text").mapInArrow(sign, "key string, bands array<long>, marks array<tinyint>, weight double")


def _vectors(rows: DataFrame, frequencies: np.ndarray, documents: int, size: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((frequencies, documents))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = ShingleVectors(*shared.value, size)
        for batch in short_slices(batches):
            keys, texts = columns_of(batch, "key", "text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([v.tobytes() for v in vectors(texts)], pa.binary())],
                names=["key", "vector"])

    return rows.select("key", "text").mapInArrow(weigh, "key string, vector binary")


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` of weighted Jaccard similarity ``threshold`` or more. Both joins are on a unique side."""
    both = pairs.join(vectors.select(F.col("key").alias("v"), F.col("vector").alias("b")), "v").join(
        vectors.select(F.col("key").alias("u"), F.col("vector").alias("a")), "u").select("u", "v", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_slices(batches, "a"):
            a, b = columns_of(batch, "a", "b")
            similar = [weighted_jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= threshold
                       for x, y in zip(a, b)]
            yield batch.select(["u", "v"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(compare, "u string, v string")


def _plausible(other: Column, threshold: float) -> Column:
    """Whether a row's text and another can reach the threshold by their weights, and probably do by their samples."""
    agree = F.aggregate(
        F.zip_with("marks", other["marks"], lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    weights = F.col("weight"), other["weight"]
    return (F.least(*weights) >= F.greatest(*weights) * (threshold - 1e-9)) & (
        agree >= int(MIN_AGREEMENT * threshold * BANDS * ROWS))


def _dealt(members: DataFrame) -> DataFrame:
    """Members of a bucket in blocks of about ``BLOCK``; each block meets each other one and itself."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = lookup(members, settle(sizes), "bucket", "key", "inner").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    met = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    dealt = met.withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")}).drop("with", "blocks")
    return dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _met(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[tuple[list[dict], list[dict], np.ndarray]]:
    """For each two blocks their rows and the agreement of samples of the pairs worth a comparison, else -1.

    These are of different components, plausible, and in no earlier band together.
    """
    least = int(MIN_AGREEMENT * threshold * BANDS * ROWS)

    def met(rows: list[dict]) -> tuple[list[dict], list[dict], np.ndarray] | None:
        i, j, band = rows[0]["i"], rows[0]["j"], rows[0]["band"]
        left = [r for r in rows if r["block"] == i]
        right = left if i == j else [r for r in rows if r["block"] == j]
        if not left or not right:
            return None
        (ca, ma, wa, ba), (cb, mb, wb, bb) = (
            [np.array([r[c] for r in side]) for c in ("component", "marks", "weight", "bands")] for side in (left, right))
        agree = np.zeros((len(left), len(right)), dtype=np.int16)
        for k in range(ma.shape[1]):
            agree += ma[:, k][:, None] == mb[:, k]
        worth = (agree >= least) & (ca[:, None] != cb) & (
            np.minimum(wa[:, None], wb) >= np.maximum(wa[:, None], wb) * (threshold - 1e-9))
        for k in range(band):
            worth &= ba[:, k][:, None] != bb[:, k]
        return left, right, np.where(np.triu(worth) if i == j else worth, agree, -1)

    held: list[dict] = []
    last: tuple | None = None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for row in batch.slice(start, 256).to_pylist():
                group = (row["bucket"], row["i"], row["j"])
                if held and group != last:
                    if (found := met(held)) is not None:
                        yield found
                    held = []
                last = group
                held.append(row)
    if held and (found := met(held)) is not None:
        yield found


def _block_links(members: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Links ``u, v`` that join all components which similar pairs of a bucket join, found block against block.

    Samples alone tell which members have a partner worth a comparison; only these are dealt out with their
    vectors. Within two blocks the most agreeing pairs are compared first, and components that a link
    joined need no other, so what comes out grows with the members, not with the pairs.
    """
    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, agree in _met(batches, threshold):
            some = [left[k] for k in np.nonzero((agree >= 0).any(axis=1))[0]] + [
                right[k] for k in np.nonzero((agree >= 0).any(axis=0))[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["bucket"] for r in some], pa.int64()), pa.array([r["key"] for r in some], pa.string())],
                names=["bucket", "key"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, agree in _met(batches, threshold):
            a, b = ([np.frombuffer(r["vector"], np.uint64) for r in side] for side in (left, right))
            joined: dict[str, str] = {}

            def root(component: str) -> str:
                while component in joined:
                    component = joined[component]
                return component

            u, v = np.nonzero(agree >= 0)
            found = []
            for k in np.argsort(-agree[u, v], kind="stable"):
                x, y = root(left[u[k]]["component"]), root(right[v[k]]["component"])
                if x != y and weighted_jaccard(a[u[k]], b[v[k]]) >= threshold:
                    joined[max(x, y)] = min(x, y)
                    found.append((left[u[k]]["key"], right[v[k]]["key"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], names=["u", "v"])

    wanted = settle(_dealt(members).mapInArrow(partners, "bucket long, key string").distinct())
    chosen = settle(members.join(wanted, ["bucket", "key"], "left_semi").join(vectors, "key"))
    return _dealt(chosen).mapInArrow(links, "u string, v string")


def _joined(members: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame | None:
    """``key, component``: what links of similar pairs of a bucket join; None if there are none.

    Members of one component need no more comparison. First every text meets one pivot, the smallest of
    its buckets that is plausible; then, in the buckets that still hold several components, all pairs
    across components are considered, block against block. A pair is compared in full if it is
    plausible by the weights and the samples of its texts.
    """
    components = None
    members = settle(members.withColumn("component", F.col("key")))
    for pivots in (True, False):
        if pivots:
            side = ["key", "marks", "weight"]
            firsts = settle(members.groupBy("bucket").agg(F.min_by(F.struct(*side), "key").alias("pivot")))
            faced = lookup(members, firsts, "bucket", "key", "inner").filter(
                (F.col("key") != F.col("pivot.key")) & _plausible(F.col("pivot"), threshold))
            pairs = settle(faced.groupBy(F.col("key").alias("v")).agg(F.min("pivot.key").alias("u")))
            found = settle(_verified(pairs, vectors, threshold))
        else:
            states = members.groupBy("bucket").agg((F.min("component") != F.max("component")).alias("mixed"))
            members = settle(members.join(states.filter("mixed").select("bucket"), "bucket", "left_semi"))
            found = settle(_block_links(members, vectors, threshold))
        if not found.isEmpty():
            stars = components and components.select(F.col("key").alias("u"), F.col("component").alias("v"))
            components = settle(connected_components(found if stars is None else found.union(stars))).withColumnsRenamed(
                {"node": "key"})
            members = lookup(members, components.withColumnRenamed("component", "now"), "key", "bucket").withColumn(
                "component", F.coalesce("now", "component")).drop("now")
    return components


def _classed(docs: DataFrame, doc_id: str, text: str, size: int, threshold: float) -> DataFrame:
    """``doc_id, key, class`` of every row: key of the text and smallest key of its class; null for null texts."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("key", F.md5("text"))
    ids = settle(rows.select("doc_id", "key"))
    texts = rows.filter(F.col("text").isNotNull())
    frequencies, documents = word_frequencies(texts), ids.filter("key is not null").count()
    signatures = settle(_signatures(texts, frequencies, documents, size).dropDuplicates(["key"]))
    buckets = signatures.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = settle(buckets.join(shared, "bucket", "left_semi"))
    wanted = settle(members.select("key").distinct().withColumn("wanted", F.lit(True)))
    # The key is unique on the right, so no key is hot.
    members = members.join(signatures.select("key", "bands", "marks", "weight"), "key")
    vectors = settle(_vectors(
        lookup(texts, wanted, "key", "doc_id", "inner").select("key", "text").dropDuplicates(["key"]),
        frequencies, documents, size))
    components = _joined(members, vectors, threshold)
    if components is None:
        return settle(ids.withColumn("class", F.col("key")))
    classed = lookup(ids, components.withColumnRenamed("component", "class"), "key", "doc_id")
    return settle(classed.withColumn("class", F.coalesce("class", "key")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Classes of texts that links of weighted Jaccard similarity ``threshold`` or more join.

    Returns ``doc_id, class_id, kept``, one row per row of ``docs``: the smallest id of the class, and whether
    this is it. A text's shingles are runs of ``size`` words (all its words, if it has fewer); the weight of
    one is its count times the mean IDF of its words, rounded to a quarter of a power of two. Document
    frequencies count all documents, in 2 ** 18 buckets of words.

    Equal texts are one text from here on. Consistent weighted samples in 16 bands of 4 give buckets of
    candidates; ``_joined`` compares what can still join two classes and is plausible by the samples, exactly,
    and joins it by connected components. Only texts in shared buckets get a vector. Documents are read three times and not shuffled.

    A null text is a class of its own, and so is a text without words, together with its equals. Null ids
    do not count as smallest; a class of null ids has a null ``class_id``, and a null id is kept only if its text
    is null. Repeated rows fall into one class, and those with its smallest id are all kept. Other columns
    are ignored.
    """
    classed = _classed(docs, doc_id, text, size, threshold)
    classes = settle(classed.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("n")).filter("n > 1").select("class", "class_id"))
    told = lookup(classed, classes.withColumn("several", F.lit(True)), "class", "doc_id")
    class_id = F.when(F.col("several"), F.col("class_id")).otherwise(F.col("doc_id"))
    return told.select("doc_id", class_id.alias("class_id"),
                       (F.col("several").isNull() | F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))).alias("kept"))


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                       threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with one row of each class: that with the smallest id (null last, then by key of the text).

    Rows with null texts all stay. Of rows that repeat the id and the text of a class's first one, one stays.
    """
    classed = _classed(docs, doc_id, text, size, threshold).filter("key is not null")
    # Of the smallest structs, that without a null id comes first.
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    firsts = settle(classed.groupBy("class").agg(F.min(first).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    keys = settle(lookup(classed, firsts.select("class", "first"), "class", "doc_id", "inner").groupBy("key").agg(
        F.first("first").alias("first"),
        F.count_if((F.col("key") == F.col("first.key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).alias("n")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), F.md5(text).alias("key"))
    told = lookup(rows, keys, "key", "id")
    # The key of a null text is null and finds nothing.
    chosen = told.filter(F.col("first").isNull() | (
        (F.col("first.key") == F.col("key")) & F.col("id").eqNullSafe(F.col("first.doc_id"))))
    if keys.filter("n > 1").isEmpty():
        return chosen.select("row.*")
    once = chosen.filter("n is null or n = 1").select("row")
    return once.unionByName(chosen.filter("n > 1").dropDuplicates(["key"]).select("row")).select("row.*")
