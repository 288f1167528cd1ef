"""Toxicity by compression distance: two zstandard dictionaries, compared window by window."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of, words
from tidewire.llm.logistic import fit_logistic

# Bounds of the labelled sample that the model is fitted on: rows of each class, and code points of a text.
MAX_FIT_ROWS = 3000
MAX_FIT_CHARS = 20_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
LEVEL, WINDOW_LOG, SEARCH_LOG, STRATEGY = 6, 17, 6, zstandard.STRATEGY_LAZY2
ORDINARY_BYTES, TOXIC_BYTES, STRONGEST_BYTES = 6144, 1024, 2048
# The first matches of a compressor need some bytes behind them, so that each window ends in the same bytes.
TAIL_BYTES = 16
# Passages for the toxic dictionary: words that toxic texts hold e^2.5 times as often, beyond chance.
MIN_LOG_ODDS, MIN_LIKELIHOOD = 2.5, 12.0
GAINS = range(1, 9)
CACHE_WORDS = 200_000


@dataclass
class ToxicityModel:
    """Dictionaries as raw bytes, and weights over the share and number of windows that gain 1..8 bytes."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    prior: float = 0.5


def _trained(samples: Sequence[bytes], size: int) -> bytes:
    """A trained dictionary; samples too few to train on are the dictionary themselves."""
    if sum(map(len, samples)) > 4 * size:
        try:
            return zstandard.train_dictionary(size, list(samples), level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def _log_likelihood(a: int, n: int, b: int, m: int) -> float:
    """G2 of a word in ``a`` of ``n`` toxic and ``b`` of ``m`` ordinary texts."""
    def part(k: int, size: int, rate: float) -> float:
        return (k * math.log(rate) if k else 0.0) + ((size - k) * math.log(1 - rate) if size > k else 0.0)
    pooled = (a + b) / (n + m)
    return 2 * (part(a, n, a / n) + part(b, m, b / m) - part(a, n, pooled) - part(b, m, pooled))


def telling_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> dict[bytes, float]:
    """Words that mark toxic texts, with their likelihood ratios."""
    n, m = len(toxic), len(ordinary)
    in_toxic = Counter(w for t in toxic for w in set(t))
    in_ordinary = Counter(w for t in ordinary for w in set(t))
    found = {}
    for word, a in in_toxic.items():
        b = in_ordinary[word]
        odds = math.log((a + 0.5) / (n + 1)) - math.log((b + 0.5) / (m + 1))
        if a > 1 and odds >= MIN_LOG_ODDS and (g := _log_likelihood(a, n, b, m)) >= MIN_LIKELIHOOD:
            found[word] = g
    return found


class WindowGains:
    """Bytes by which the toxic dictionary shortens a window more than the ordinary one does.

    A window is one word with a space on both sides. Its gain is kept while it is among recent words.
    """

    def __init__(self, model: ToxicityModel):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            # The window must reach back over the whole dictionary.
            parameters = zstandard.ZstdCompressionParameters(
                window_log=WINDOW_LOG, hash_log=17, chain_log=17, search_log=SEARCH_LOG, min_match=4, strategy=STRATEGY,
                target_length=64, write_content_size=False, write_dict_id=False, write_checksum=False)
            return zstandard.ZstdCompressor(dict_data=shared, compression_params=parameters)

        self.tail = model.ordinary[-TAIL_BYTES:]
        self.ordinary = compressor(model.ordinary)
        # Both end in the same bytes, so that they differ by the toxic passages alone.
        self.toxic = compressor(model.toxic + model.ordinary)
        self.known: dict[bytes, int] = {}

    def gain(self, word: bytes) -> int:
        value = self.known.get(word)
        if value is None:
            window = b" " + word + b" " + self.tail
            value = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
            value = self.known[word] = min(max(value, 0), GAINS[-1])
        return value

    def features(self, text_words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        gains = np.bincount(
            np.fromiter(map(self.gain, text_words), np.int64, len(text_words)), minlength=GAINS[-1] + 1)
        at_least = gains[::-1].cumsum()[::-1][1:]
        share = at_least / max(1, len(text_words))
        return np.concatenate([[1.0], np.log1p(at_least), np.sqrt(share) * 5, [math.log1p(len(text_words)) / 5]])


def fit_toxicity(rows: Sequence[tuple[str, int]]) -> ToxicityModel:
    """Fit on ``(text, label)`` pairs: two thirds build the dictionaries, one third calibrates."""
    texts = {text: label for text, label in sorted(rows, key=lambda r: (r[0], r[1]))}
    labelled = [(words(text), label) for text, label in texts.items()]
    prior = (sum(label for _, label in labelled) + 1) / (len(labelled) + 2)
    fitting = [r for i, r in enumerate(labelled) if i % 3]
    toxic = [w for w, label in fitting if label]
    ordinary = [w for w, label in fitting if not label]
    if not toxic or not ordinary:
        return ToxicityModel(prior=prior)
    telling = telling_words(toxic, ordinary)
    passages = [b" " + w + b" " for t in toxic for w in t if w in telling]
    plain = [b" " + b" ".join(t[i:i + 8]) + b" " for t in ordinary for i in range(0, len(t), 8)]
    step = 1 + len(plain) // 40_000
    strongest = b"".join(b" " + w + b" " for w in sorted(telling, key=lambda w: (telling[w], w)))
    toxic_dictionary = _trained([b"".join(passages[i:i + 8]) for i in range(0, len(passages), 8)], TOXIC_BYTES)
    model = ToxicityModel(
        ordinary=_trained(plain[::step], ORDINARY_BYTES),
        toxic=toxic_dictionary + strongest[-STRONGEST_BYTES:], prior=prior)
    gains = WindowGains(model)
    calibration = [r for i, r in enumerate(labelled) if i % 3 == 0] or labelled
    x = np.array([gains.features(w) for w, _ in calibration])
    y = np.array([label for _, label in calibration], dtype=float)
    model.weights = fit_logistic(x, y).tolist() if 0 < y.sum() < len(y) else []
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
                    text: str = "text", max_rows: int = MAX_FIT_ROWS, max_chars: int = MAX_FIT_CHARS) -> DataFrame:
    """At most ``max_rows`` labelled rows of each class outside the held-out fold, by hash order of the id.

    Ids are chosen on the narrow labels; only then are their texts read. Texts beyond ``max_chars`` code
    points are not fitted on. An id with both labels counts as 1.
    """
    one = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS))
    one = one.filter(fold != HELD_OUT)
    order = (F.xxhash64("id"), F.col("id"))
    chosen = one.filter("label = 1").orderBy(*order).limit(max_rows).unionByName(
        one.filter("label = 0").orderBy(*order).limit(2 * max_rows))
    # Up to three times max_rows ids: the bound of the broadcast.
    return docs.filter(F.length(text) <= max_chars).join(
        F.broadcast(chosen), F.col(doc_id) == F.col("id")).select(F.col(text).alias("text"), F.col("label").cast("int"))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
                   text: str = "text", threshold: float = THRESHOLD, max_rows: int = MAX_FIT_ROWS,
                   max_chars: int = MAX_FIT_CHARS) -> DataFrame:
    """Toxicity of whole texts as ``doc_id, held_out, score, predicted, n_windows``.

    Separate zstandard dictionaries are trained on passages of toxic and of ordinary texts. Each window of
    a text is compressed with both; the number and share of windows that the toxic dictionary shortens by
    at least 1..8 bytes more are the inputs of a logistic calibration. Nothing but the text is an input.

    The model is fitted on the driver on a bounded sample (``labelled_sample``): at most ``max_rows`` toxic
    and twice as many ordinary rows, never of the held-out fold (crc32 of the id as text, modulo 3, is 1).
    All documents are scored where they are read, without a shuffle.

    Null and empty texts have no windows and get the score of a text without any gain. Null ids are never
    held out nor learned from. Without labels of both classes every score is the smoothed share of label 1.
    Repeated rows are scored alike. Other columns are ignored.
    """
    fold = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    sample = labelled_sample(docs, labels, label, doc_id, text, max_rows, max_chars)
    model = fit_toxicity([(r["text"], r["label"]) for r in sample.toLocalIterator()])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = WindowGains(model) if model.weights else None
        weights = np.array(model.weights)
        for batch in batches:
            scores, sizes = [], []
            for text_words in map(words, next(columns_of(batch, "text"))):
                sizes.append(len(text_words))
                logit = float(gains.features(text_words) @ weights) if gains else math.log(model.prior / (1 - model.prior))
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, logit)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())],
                names=["doc_id", "held_out", "score", "n_windows"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"doc_id {id_type}, held_out boolean, score double, n_windows long")
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_windows")
