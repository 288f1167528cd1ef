"""Benchmark decontamination: one automaton over the windows of all benchmark items."""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import (
    WORD_BYTES, carried, carried_row, columns_of, passed, passed_schema, short_slices, words)
from tidewire.session import settle

WINDOW = 13
# Words of a block: its automaton takes about a kilobyte a word in each worker.
MAX_WORDS = 200_000
MIN_SHARE = 20
_WORD = re.compile(rb"[^ ]+")
# The automaton reads one character per word. Its alphabet starts here, above the surrogates.
_FIRST = 0xE000

_SPANS = "array<struct<start: long, end: long>>"


def item_windows(item_words: list[bytes], window: int = WINDOW) -> list[list[bytes]]:
    """All runs of ``window`` words; a shorter item, but not an empty one, is one window."""
    if len(item_words) <= window:
        return [item_words] if item_words else []
    return [item_words[i:i + window] for i in range(len(item_words) - window + 1)]


class Scanner:
    """Finds item windows in texts; words are spelled as single characters."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.alphabet: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item_id, item_words in items:
            for run in item_windows(item_words, window):
                spelled = "".join(
                    self.alphabet.setdefault(w, chr(_FIRST + len(self.alphabet))) for w in run)
                owners.setdefault(spelled, set()).add(item_id)
        self.automaton = ahocorasick.Automaton()
        for spelled, ids in owners.items():
            self.automaton.add_word(spelled, (len(spelled), sorted(ids)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered runs of word positions (end exclusive, merged) and the items whose windows occur."""
        runs: list[tuple[int, int]] = []
        found: set[str] = set()
        if self.empty or not text_words:
            return runs, found
        get = self.alphabet.get
        spelled = "".join([get(w, " ") for w in text_words])
        # Ends come in ascending order, so a later window may only swallow runs at the tail.
        for last, (length, ids) in self.automaton.iter(spelled):
            start, end = last + 1 - length, last + 1
            while runs and start <= runs[-1][1]:
                start = min(start, runs[-1][0])
                runs.pop()
            runs.append((start, end))
            found.update(ids)
        return runs, found


def merge_runs(first: list[tuple[int, int]], second: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(first + second):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of word positions as code point offsets into the text."""
    raw = text.encode()
    bounds = [m.span() for m in _WORD.finditer(raw.translate(WORD_BYTES))]
    lead = np.frombuffer(raw, dtype=np.uint8)
    # A code point starts at every byte that is no continuation byte.
    points = np.concatenate([[0], np.cumsum((lead & 0xC0) != 0x80)])
    return [{"start": int(points[bounds[a][0]]), "end": int(points[bounds[b - 1][1]])} for a, b in runs]


_LAST_SCANNER: dict[str, Scanner] = {}


def _scanner(name: str, shared: Broadcast, window: int) -> Scanner:
    """The scanner of a block, built once per worker; that of the block before goes."""
    if name not in _LAST_SCANNER:
        _LAST_SCANNER.clear()
        _LAST_SCANNER[name] = Scanner(pickle.loads(shared.value), window)
    return _LAST_SCANNER[name]


def _scan_block(rows: DataFrame, items: list[tuple[str, list[bytes]]], window: int, last: bool,
                keep: Sequence[str]) -> DataFrame:
    """Add the hits of one block of items; after the last block texts give way to their hit stretches."""
    shared, name = rows.sparkSession.sparkContext.broadcast(pickle.dumps(items)), uuid.uuid4().hex
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(name, shared, window)
        for batch in short_slices(batches):
            counts, hits, ids, spans = [], [], [], []
            for text, old_ids, old_runs in zip(*columns_of(batch, "text", "item_ids", "runs")):
                text_words = words(text)
                runs, found = scanner.scan(text_words)
                runs = merge_runs([(r["start"], r["end"]) for r in old_runs], runs) if old_runs else runs
                counts.append(len(text_words))
                hits.append(sum(b - a for a, b in runs))
                ids.append(sorted(found.union(old_ids)))
                spans.append((original_spans(text, runs) if runs else []) if last
                             else [{"start": a, "end": b} for a, b in runs])
            # Texts are needed until the last block.
            others, names = passed(batch, keep if last else ["text"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()),
                 pa.array(ids, pa.list_(pa.string())), pa.array(spans, runs_type), *others],
                names=["doc_id", "n_words", "n_hit", "item_ids", "spans" if last else "runs", *names])

    runs = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("spans" if last else "runs", runs),
        *passed_schema(rows, keep if last else ["text"])])
    return rows.mapInArrow(scan, schema)


def _blocks(benchmark: DataFrame, item: str, text: str, max_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of about ``max_words`` words each, fetched one after the other."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // (2 * max_words)  # a word takes two bytes at least, with its separator
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item"], words(r["text"])) for r in items.filter(part == k).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       max_words: int = MAX_WORDS, min_share: int = MIN_SHARE,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Occurrences of benchmark windows in whole texts.

    Returns ``doc_id, n_words, n_hit, item_ids, spans, contaminated``, one row per row of ``docs``: words,
    words inside any occurrence of a window, sorted ids (as strings) of the items that occur, and the hit
    stretches as code point offsets into the original text. A text is contaminated if it has a hit and
    ``min_share * n_hit >= n_words``.

    One automaton holds the windows of all items while the benchmark has up to ``max_words`` words, and
    each text is scanned once; a worker builds it once. A larger benchmark is taken in blocks of that size, one scan and one stored
    table each, so the memory of a task does not grow with it. Texts are not shuffled.

    Null or empty texts have no words and no hits; null or repeated ids are kept as they are; an item with
    a null id counts under the id ``''``, one without words never occurs, and repeated items count once.
    An empty benchmark gives no hits. The columns named in ``keep`` come back as fields of a column ``row``; others
    are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carried(docs, keep, text)).withColumns(
        {"item_ids": F.array().cast("array<string>"), "runs": F.array().cast(_SPANS)})
    blocks = _blocks(benchmark, item_id, item_text, max_words)
    items = next(blocks)
    for following in blocks:
        rows = settle(_scan_block(rows, items, window, False, keep))
        items = following
    found = _scan_block(rows, items, window, True, keep)
    contaminated = (F.col("n_hit") > 0) & (F.lit(min_share) * F.col("n_hit") >= F.col("n_words"))
    return found.select("doc_id", "n_words", "n_hit", "item_ids", "spans", contaminated.alias("contaminated"),
                        *carried_row(keep, text))
