"""Quality by co-training: a classifier of the content and one of the page metadata teach each other."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import carried, carried_row, columns_of, passed, passed_schema, release_memory, short_slices
from tidewire.llm.logistic import fit_logistic, sigmoid
from tidewire.session import settle

# Bound of the labelled sample, in rows. All other rows are unlabelled, and all of them take part in each round.
MAX_LABELLED = 6000
ROUNDS = 4
# Newton steps of a round: each is one pass over the features of all rows. They end with a step below this one.
MAX_STEPS, LEAST_STEP = 8, 1e-2
# The sums of the tasks are added up in so many groups before they reach the driver.
SUM_GROUPS = 32
# A pseudo-label is passed on above a score at which the view is right so often on the calibration rows.
MIN_PRECISION, MIN_SUPPORT = 0.97, 20
THRESHOLD = 0.5
TRIGRAM_BITS = 8
SOURCES, LANGUAGES = 64, 16
RIDGE = 0.1


def content_features(text: str | None) -> np.ndarray:
    """Byte trigrams of the whole text in hashed buckets, and how varied, loud and wordy it is."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    x = np.zeros(1 + (1 << TRIGRAM_BITS) + 5)
    x[0] = 1.0
    if len(raw) > 2:
        wide = raw.astype(np.uint32)
        h = wide[:-2] * np.uint32(2654435761) + wide[1:-1] * np.uint32(668265263) + wide[2:] * np.uint32(2246822519)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(739982445)
        counts = np.log1p(np.bincount(h >> np.uint32(32 - TRIGRAM_BITS), minlength=1 << TRIGRAM_BITS) * (1000.0 / len(raw)))
        x[1:-5] = 3 * counts / np.linalg.norm(counts)
    words = (text or "").split()
    n, size = max(1, len(words)), max(1, len(raw))
    upper = np.count_nonzero((raw >= 65) & (raw <= 90))
    plain = upper + np.count_nonzero(((raw >= 97) & (raw <= 122)) | (raw >= 128) | ((raw >= 48) & (raw <= 57)) | (raw <= 32))
    x[-5:] = [len(set(words)) / n, upper / size, 1 - plain / size, min(10.0, len(raw) / n / 10), np.log1p(len(words)) / 5]
    return x


def metadata_features(source: str | None, lang: str | None, n_chars: int | None, n_lines: int) -> np.ndarray:
    """Source and language in hashed buckets, length and lines; nulls have buckets of their own."""
    x = np.zeros(1 + SOURCES + LANGUAGES + 4)
    x[0] = 1.0
    x[1 + (0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCES - 1))] = 1.0
    x[1 + SOURCES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANGUAGES - 1))] = 1.0
    size = max(0, n_chars or 0)
    x[-4:] = [float(n_chars is None), np.log1p(size) / 5, np.log1p(n_lines) / 3, np.log1p(size / (1 + n_lines)) / 3]
    return x


@dataclass
class QualityModel:
    """Weights of both views, their calibrations (offset, slope), and the weights of the calibrated views."""

    content: np.ndarray | None = None
    metadata: np.ndarray | None = None
    calibration: np.ndarray | None = None
    combination: np.ndarray | None = None
    prior: float = 0.5

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: content, metadata, both."""
        if self.content is None:
            return np.full((len(content), 3), self.prior)
        logits = np.stack([content @ self.content, metadata @ self.metadata], axis=1)
        logits = self.calibration[:, 0] + logits * self.calibration[:, 1]
        both = self.combination[0] + logits @ self.combination[1:]
        return sigmoid(np.column_stack([logits, both]))


def _calibrated(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    return fit_logistic(np.column_stack([np.ones(len(y)), logit]), y, ridge=1e-3)


def _cut(scores: np.ndarray, y: np.ndarray, label: int) -> float:
    """The mildest score beyond which the calibration rows have the label often enough; infinite if none is."""
    sign = 1 if label else -1
    order = np.argsort(-sign * scores, kind="stable")
    right = np.cumsum(y[order] == label) / np.arange(1, len(y) + 1)
    good = np.nonzero((right >= MIN_PRECISION) & (np.arange(len(y)) + 1 >= MIN_SUPPORT))[0]
    return float(scores[order][good[-1]]) if len(good) else sign * np.inf


@dataclass
class Lesson:
    """What one view is taught in a step: its weights, and those and the cuts (up, down) of the view that teaches it."""

    student: np.ndarray
    teacher: np.ndarray
    up: float
    down: float

    def sums(self, x: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Number, label sum, gradient and curvature over the rows that the teacher is sure of; ``other`` are its features."""
        told = other @ self.teacher
        sure = (told >= self.up) ^ (told <= self.down)
        x, y = x[sure], (told[sure] >= self.up).astype(float)
        p = sigmoid(x @ self.student)
        curve = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None])
        return np.concatenate([[len(x), y.sum()], x.T @ (p - y), curve.ravel()])


def _width(lesson: Lesson) -> int:
    return 2 + len(lesson.student) + len(lesson.student) ** 2


def _step(x: np.ndarray, y: np.ndarray, beta: np.ndarray, told: np.ndarray) -> np.ndarray:
    """One Newton step on the labelled rows and the sums over pseudo-labelled ones, which together weigh as much at most."""
    n, k = told[0], len(beta)
    share = min(1.0, len(y) / n) if n else 0.0
    penalty = np.full(k, RIDGE * (len(y) + share * n) / 100 + 1e-6)
    penalty[0] = 1e-6
    p = sigmoid(x @ beta)
    gradient = x.T @ (p - y) + share * told[2:2 + k] + penalty * beta
    curve = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + share * told[2 + k:].reshape(k, k) + np.diag(penalty)
    step = np.linalg.solve(curve, gradient)
    return step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))


def fit_quality(content: np.ndarray, metadata: np.ndarray, y: np.ndarray,
                told: Callable[[Lesson, Lesson], tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> QualityModel:
    """Co-training: in each round either view labels the unlabelled rows it is sure of, for the other one.

    A quarter of the labelled rows calibrates the views and their combination and sets how sure is sure;
    the rest trains. Pseudo-labels are made anew in each round, so that no error stays. ``told`` gives the sums of both
    lessons (content, metadata) over all unlabelled rows.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    held = np.arange(len(y)) % 4 == 0
    if not (0 < y[held].sum() < held.sum() and 0 < y[~held].sum() < (~held).sum()):
        return QualityModel(prior=float(prior))
    views = (content, metadata)
    weights = [fit_logistic(x[~held], y[~held], RIDGE) for x in views]
    for _ in range(rounds):
        teachers = [(w, *(_cut(x[held] @ w, y[held], label) for label in (1, 0))) for x, w in zip(views, weights)]
        if all(np.isinf(up) and np.isinf(down) for _, up, down in teachers):
            break
        for _ in range(MAX_STEPS):
            sums = told(Lesson(weights[0], *teachers[1]), Lesson(weights[1], *teachers[0]))
            steps = [_step(x[~held], y[~held], w, s) for x, w, s in zip(views, weights, sums)]
            weights = [w - step for w, step in zip(weights, steps)]
            if max(np.abs(step).max() for step in steps) < LEAST_STEP:
                break
    logits = [x[held] @ w for x, w in zip(views, weights)]
    calibration = np.array([_calibrated(v, y[held]) for v in logits])
    both = np.column_stack([np.ones(held.sum()), *[c[0] + c[1] * v for c, v in zip(calibration, logits)]])
    return QualityModel(*weights, calibration, fit_logistic(both, y[held], ridge=1e-2), float(prior))


def _featured(rows: DataFrame) -> DataFrame:
    """Both views' features of all rows, as float16 bytes."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_slices(batches):
            texts, sources, langs, sizes = columns_of(batch, "text", "source", "lang", "n_chars")
            a = [content_features(t).astype(np.float16).tobytes() for t in texts]
            b = [metadata_features(s, g, n, (t or "").count("\n")).astype(np.float16).tobytes()
                 for s, g, n, t in zip(sources, langs, sizes, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(batch.schema.get_field_index("label")), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                names=["doc_id", "label", "content", "metadata"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("label", T.IntegerType()), T.StructField("content", T.BinaryType()),
                           T.StructField("metadata", T.BinaryType())])
    return rows.mapInArrow(build, schema)


def _known(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` labelled ids by hash order, chosen on narrow columns: ``id, label``."""
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("label"))
    ids = docs.select(F.col("doc_id").alias("id")).filter("id is not null").distinct()
    return ids.join(known, "id").orderBy(F.xxhash64("id"), F.col("id")).limit(max_labelled)


def _sums(features: DataFrame, lessons: tuple[Lesson, Lesson]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of both lessons over all rows: one row a task, added up in groups of tasks, then on the driver."""
    sizes = [_width(lesson) for lesson in lessons]

    def taught(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes))
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                x, other = (_matrix(values, len(lesson.student)) for values, lesson in zip(columns_of(part, "content", "metadata"), lessons))
                total += np.concatenate([lessons[0].sums(x, other), lessons[1].sums(other, x)])
        group = TaskContext.get().partitionId() % SUM_GROUPS
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])
        release_memory()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(1):
                sums = np.frombuffer(value.as_py())
                total = sums + (0.0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    rows = features.select("content", "metadata").mapInArrow(taught, "part int, sums binary").repartition(
        SUM_GROUPS, "part").mapInArrow(added, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(sum(sizes)))
    return total[:sizes[0]], total[sizes[0]:]


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float16).reshape(-1, width).astype(float)


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
                  source: str = "source", lang: str = "lang", n_chars: str = "n_chars", threshold: float = THRESHOLD,
                  max_labelled: int = MAX_LABELLED, keep: Sequence[str] = ()) -> DataFrame:
    """Quality of all documents, as ``doc_id, content_score, metadata_score, score, accepted``.

    The content view sees byte trigrams of the whole text and its variety; the metadata view sees source,
    language, length and lines. Both are logistic regressions, trained on the same labelled rows; over some
    rounds each labels the unlabelled rows it is sure of for the other. Each view is calibrated on labelled rows
    that did not train it, and a logistic regression of both calibrated views gives ``score``, the
    probability of label 1; ``accepted`` is 1 from ``threshold`` on.

    At most ``max_labelled`` labelled rows, by hash order of the id, are fitted on as such. All other rows are
    unlabelled, and each round's pseudo-labels cover all of them: their features are stored once, a Newton step is
    a pass over them that adds up gradients and curvatures, and the steps are taken on the driver. All
    pseudo-labelled rows together weigh as much as the labelled ones at most, at any size. Texts are not shuffled.

    Null texts count as empty, null metadata has buckets of its own, null or repeated ids are kept; rows with null
    ids are unlabelled, and of rows that repeat a labelled id one teaches. An id with both labels counts as 0.
    Without labels of both classes all scores are the smoothed share of label 1.
    The columns named in ``keep`` come back as fields of a column ``row``; others are ignored.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"), F.col(n_chars).cast("long").alias("n_chars"),
        *carried(docs, keep, text))
    narrow = rows.select("doc_id", "text", "source", "lang", "n_chars")
    # At most max_labelled ids: the bound of the broadcast.
    chosen = F.broadcast(_known(narrow, labels, label, doc_id, max_labelled))
    features = settle(_featured(narrow.join(chosen, F.col("doc_id") == F.col("id"), "left").drop("id")))
    known = features.filter("label is not null").groupBy("doc_id").agg(F.min(F.struct("content", "metadata", "label")).alias("one")).select(
        "one.*").collect()
    # The same order in each run: by what the rows hold.
    known.sort(key=lambda r: (zlib.crc32(r["content"]), r["content"], r["metadata"]))
    widths = len(content_features("")), len(metadata_features(None, None, None, 0))
    parts = [_matrix([bytes(r[c]) for r in known], w) for c, w in zip(("content", "metadata"), widths)]
    unlabelled = features.filter("label is null")
    model = fit_quality(*parts, np.array([r["label"] for r in known], dtype=float), lambda *lessons: _sums(unlabelled, lessons))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_slices(batches):
            texts, sources, langs, sizes = columns_of(batch, "text", "source", "lang", "n_chars")
            found = model.scores(
                np.array([content_features(t) for t in texts]),
                np.array([metadata_features(s, g, n, (t or "").count("\n")) for s, g, n, t in zip(sources, langs, sizes, texts)]))
            others, names = passed(batch, keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[:, k]) for k in range(3)], *others],
                names=["doc_id", "content_score", "metadata_score", "score", *names])

    schema = T.StructType([rows.schema["doc_id"], *[
        T.StructField(c, T.DoubleType()) for c in ("content_score", "metadata_score", "score")], *passed_schema(rows, keep)])
    return rows.mapInArrow(score, schema).select(
        "doc_id", "content_score", "metadata_score", "score", (F.col("score") >= threshold).cast("int").alias("accepted"),
        *carried_row(keep, text))
