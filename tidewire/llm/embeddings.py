"""Embedding near-dedup: cells by signs of random hyperplanes, exact cosines in all cells that can be near enough, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.components import connected_components
from tidewire.operators.lookup import lookup
from tidewire.session import settle, settle_at
from tidewire.sources.sinks import opened, qualified

THRESHOLD = 0.98
# Hyperplanes grow with the largest label, by its bits and so many more. The first of their signs deal out a label; the
# distances from all of them tell which cells a vector need not visit.
LEAST_SIGNS, MORE_SIGNS, MOST_SIGNS = 16, 7, 28
# Members of a cell are compared in blocks of this many, with visitors in blocks of so many times more.
BLOCK, VISITORS = 1024, 4
# Links whose hashes are compared at once; entries of a matrix of similarities or distances that is built at once.
_PAIRS, _ENTRIES = 100_000, 1 << 20
# Squared distances are off by rounding, by far less than this.
_SLACK = 1e-9


def signs_for(largest: int) -> int:
    return min(max(LEAST_SIGNS, largest.bit_length() + MORE_SIGNS), MOST_SIGNS)


def _planes(size: int, signs: int) -> np.ndarray:
    """Normals of random hyperplanes at right angles to each other; where there are fewer dimensions than signs, the others are zero."""
    drawn = np.random.default_rng(size).standard_normal((size, min(signs, size)))
    return np.pad(np.linalg.qr(drawn)[0], ((0, 0), (0, max(0, signs - size))))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _sides(vectors: DataFrame, signs: int) -> DataFrame:
    """``margins``: how far the unit vector lies from each hyperplane; ``hash``: on which sides."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                column = part.column(part.schema.get_field_index("vector"))
                margins = np.zeros((part.num_rows, signs))
                sizes = np.array([len(v) for v in column])
                for size in np.unique(sizes):
                    rows = np.nonzero(sizes == size)[0]
                    x = column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)
                    if size not in planes:
                        planes[size] = _planes(int(size), signs)
                    margins[rows] = _unit(x) @ planes[size]
                hashes = ((margins > 0) @ (1 << np.arange(signs))).astype(np.int32)
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * signs)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(hashes), pa.ListArray.from_arrays(offsets, pa.array(margins.ravel()))],
                    names=[*part.schema.names, "hash", "margins"])

    return vectors.mapInArrow(
        sign, "key string, label_key string, n long, vector array<double>, hash int, margins array<double>")


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _boxes(at: str) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each label its cells, and the least and the largest margins of their members."""
    files, base = opened(at)
    cells = ds.dataset(base, filesystem=files, format="parquet").to_table().sort_by([("label_key", "ascending"), ("hash", "ascending")])
    hashes, low, high = cells["hash"].to_numpy(), *(_matrix(cells[c].combine_chunks(), cells.num_rows) for c in ("low", "high"))
    labels, starts = np.unique(np.array(cells["label_key"].to_pylist(), dtype=object), return_index=True)
    ends = [*starts[1:], cells.num_rows]
    return {k: (hashes[i:j], low[i:j], high[i:j]) for k, i, j in zip(labels, starts, ends)}


def _visits(home: DataFrame, cells_at: str, threshold: float) -> DataFrame:
    """The cells that a vector visits: of its label those before its own whose box is near enough for a link.

    Hyperplanes at right angles keep distances or shorten them, so of two vectors that link, the one of the later cell
    visits that of the other one.
    """
    reach = 2 - 2 * threshold + _SLACK

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = None
        for batch in (b for b in batches if b.num_rows):
            boxes = boxes or _boxes(cells_at)
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            own, margins = column("hash").to_numpy(), _matrix(column("margins"), batch.num_rows)
            labels, which = np.unique(np.array(column("label_key").to_pylist(), dtype=object), return_inverse=True)
            ordered = np.argsort(which, kind="stable")
            for label, rows in zip(labels, np.split(ordered, np.cumsum(np.bincount(which))[:-1])):
                cells, low, high = boxes[label]
                step = max(1, _ENTRIES // len(cells))
                for part in (rows[k:k + step] for k in range(0, len(rows), step)):
                    far = np.zeros((len(part), len(cells)))
                    for k in range(margins.shape[1]):
                        x = margins[part, k, None]
                        far += np.maximum(np.maximum(low[:, k] - x, x - high[:, k]), 0) ** 2
                    r, c = np.nonzero((far <= reach) & (cells < own[part, None]))
                    some = batch.select(["key", "label_key", "table"]).take(pa.array(part[r]))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cells[c])], names=["key", "label_key", "table", "hash"])

    return home.mapInArrow(visit, "key string, label_key string, table int, hash int")


def _compare(left: tuple, right: tuple | None, table: int, threshold: float) -> tuple[np.ndarray, list, list]:
    """Links within a block, or between two: counts per member, and a spanning set of links.

    A link counts in the first table in which both vectors share a bucket.
    """
    keys, n, x, hashes = left if right is None else tuple(np.concatenate(c) for c in zip(left, right))
    others = 0 if right is None else len(left[0])
    step = max(1, _ENTRIES // max(1, len(x) - others))
    ends = [np.empty((2, 0), dtype=np.int64)]
    for k in range(0, others or len(x), step):
        a, b = np.nonzero(x[k:min(k + step, others or len(x))] @ x[others:].T >= threshold)
        ends.append(np.stack([a + k, b + others]))
    a, b = np.concatenate(ends, axis=1)
    a, b = a[a < b], b[a < b]
    counts = np.zeros(len(keys), dtype=np.int64)
    if not len(a):
        return counts, [], []
    for k in range(0, len(a), _PAIRS):
        u, v = a[k:k + _PAIRS], b[k:k + _PAIRS]
        first = (hashes[u, :table] != hashes[v, :table]).all(axis=1)
        np.add.at(counts, u[first], n[v[first]])
        np.add.at(counts, v[first], n[u[first]])
    # Labels spread along links until they rest; each member then links to the label of its group.
    label = np.arange(len(keys))
    while True:
        now = label.copy()
        np.minimum.at(now, a, label[b])
        np.minimum.at(now, b, label[a])
        now = now[now]
        if (now == label).all():
            break
        label = now
    linked = np.nonzero(label != np.arange(len(keys)))[0]
    return counts, keys[linked].tolist(), keys[label[linked]].tolist()


_GROUP = ["label_key", "table", "hash", "i", "j"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each group, which arrive sorted; of a batch the last group may go on in the next one."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        other = np.zeros(batch.num_rows - 1, dtype=bool)
        for name in _GROUP:
            column = batch.column(batch.schema.get_field_index(name))
            other |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(np.nonzero(other)[0] + 1).tolist()]
        for start, end in zip(starts, starts[1:]):
            yield batch.slice(start, end - start)
        rest = batch.slice(starts[-1])
    if rest is not None:
        yield rest


def _bucket_links(dealt: DataFrame, threshold: float) -> DataFrame:
    """Compare the blocks that share ``bucket, i, j``, which arrive sorted: ``key, links, other``."""
    def pairs(group: pa.RecordBatch) -> tuple[list, list, list]:
        column = lambda name: group.column(group.schema.get_field_index(name))
        i, j = (column(name)[0].as_py() for name in ("i", "j"))
        block = column("block").to_numpy()
        sides = [np.nonzero(block == i)[0]] + ([np.nonzero(block == j)[0]] if i != j else [])
        if not all(map(len, sides)) or (len(sides) == 1 and len(sides[0]) < 2):
            return [], [], []
        x = _unit(_matrix(column("vector"), group.num_rows))
        keys, n = np.array(column("key").to_pylist()), column("n").to_numpy()
        # Two vectors meet in one cell only.
        blocks = [(keys[s], n[s], x[s], np.zeros((len(s), 0))) for s in sides]
        counts, nodes, roots = _compare(blocks[0], blocks[1] if len(blocks) > 1 else None, 0, threshold)
        some = np.nonzero(counts)[0]
        return (keys[np.concatenate(sides)][some].tolist() + nodes, counts[some].tolist() + [0] * len(nodes), [None] * len(some) + roots)

    def told(found: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.int64(), pa.string()))], names=["key", "links", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[], [], []]
        for group in _groups(batches):
            for all_, some in zip(found, pairs(group)):
                all_ += some
            if len(found[0]) > 5000:
                yield told(found)
                found = [[], [], []]
        if found[0]:
            yield told(found)

    return dealt.mapInArrow(compare, "key string, links long, other string")


def link_embeddings(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, signs: int | None = None, block: int = BLOCK) -> DataFrame:
    """All links between vectors of one label at a cosine of ``threshold`` or more, in double precision.

    Returns ``vec_id, n_links, component_id, kept``, one row per row: how many other vectors it is linked to, the
    smallest id reachable by links, and whether that is its own.

    Equal vectors of a label are one from here on, with their number. Signs of random hyperplanes deal a label out into
    cells of about ``block`` members; as many hyperplanes are drawn as the rows of the largest label ask for unless
    ``signs`` says. A vector visits the earlier cells of its label that its distances from the hyperplanes leave open,
    so every pair that can link meets, and meets once. Members and visitors of a cell are dealt into blocks
    and compared block against block as matrices, whatever the size of the cell; a task holds two blocks.
    No list of pairs is made: blocks return counts and a spanning set of links, from which connected components follow.
    Vectors without any order in many dimensions visit most cells, so for these the cosines grow with the square of a label.

    Vectors that are null, empty, zero, or hold null or non-finite components, and null labels, link with nothing: no
    links, and their own id as component. Vectors of different length do not link. Null ids count as
    links of others but never as the smallest id. Repeated rows link with each other. Other columns are ignored.
    """
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"),
        F.col(label).cast("string").alias("label_key"))
    usable = F.col("label_key").isNotNull() & F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("vector", lambda v: v != 0)
    # Zeros of either sign are equal; the length keeps vectors of different dimensions in different buckets.
    same = F.transform("vector", lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v))
    rows = rows.withColumn("label_key", F.concat_ws("/", F.size("vector").cast("string"), "label_key")).withColumn(
        "key", F.when(usable, F.md5(F.concat_ws(":", "label_key", F.array_join(same.cast("array<string>"), ",")))))
    ids = settle(rows.select("vec_id", "key"))
    distinct = rows.filter("key is not null").groupBy("key").agg(
        F.first("label_key").alias("label_key"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    if signs is None:
        largest = vectors.filter(F.col(label).isNotNull()).groupBy(label).count().agg(F.max("count")).first()[0]
        signs = signs_for(largest or 0)
    signed = settle(_sides(distinct.select("key", "label_key", "n", "vector"), signs))
    depth = F.least(F.lit(signs), F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / block)))).cast("int")
    depths = settle(signed.groupBy("label_key").count().select("label_key", depth.alias("table")))
    home = lookup(signed.select("key", "label_key", "hash", "margins"), depths, "label_key", "key").withColumn(
        "hash", F.expr("hash & (shiftleft(1, table) - 1)"))
    bucket = ["label_key", "table", "hash"]
    cut = home.filter("table > 0")
    boxes = cut.groupBy(*bucket).agg(*(
        F.array(*(f(F.get("margins", F.lit(k))) for k in range(signs))).alias(name) for name, f in (("low", F.min), ("high", F.max))))
    visits = settle(_visits(cut, qualified(vectors.sparkSession, settle_at(boxes)), threshold))
    placed = home.select("key", *bucket, F.lit(True).alias("home")).unionByName(visits.withColumn("home", F.lit(False)))
    sizes = settle(placed.groupBy(*bucket).agg(
        F.count_if("home").alias("size"), F.count_if(~F.col("home")).alias("visitors")).filter("size + visitors > 1"))
    # Blocks of members come first, then those of visitors. A member meets all of them once, a visitor those of members.
    dealt_to = lambda blocks: F.pmod(F.xxhash64("key"), blocks).cast("int")
    crowded = settle(placed.join(sizes, bucket).withColumns({
        "own": F.ceil(F.col("size") / block).cast("int"),
        "others": F.ceil(F.col("visitors") / (VISITORS * block)).cast("int")}).withColumn(
            "block", F.when(F.col("home"), dealt_to(F.col("own"))).otherwise(F.col("own") + dealt_to(F.col("others")))))
    last = F.col("own") - 1 + F.when(F.col("home"), F.col("others")).otherwise(0)
    met = crowded.select("*", F.explode(F.sequence(F.lit(0), last)).alias("with"))
    dealt = met.join(signed.select("key", "n", "vector"), "key").withColumns({
        "i": F.least("block", "with"), "j": F.greatest("block", "with")})
    columns = [*bucket, "i", "j"]
    dealt = dealt.select(*columns, "block", "key", "n", "vector").repartition(*columns).sortWithinPartitions(*columns)
    found = settle(_bucket_links(dealt, threshold))
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    links = found.filter("other is not null").select(F.col("key").alias("u"), F.col("other").alias("v"))
    components = connected_components(links).withColumnsRenamed({"node": "key", "component": "root"})
    state = settle(signed.select("key", "n").join(counts, "key", "left").join(components, "key", "left").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root")))
    placed = settle(lookup(ids, state, "key", "vec_id"))
    least = placed.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    told = lookup(placed, settle(least), "root", "vec_id")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return told.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"),
                       F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
