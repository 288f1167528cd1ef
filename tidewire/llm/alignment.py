"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm.common import columns_of, slices
from tidewire.operators.lookup import lookup
from tidewire.session import settle

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Ids of a pair are packed into one integer.
_SHIFT = 32
_SPACE_MARK = "▁"
# Places that tokens of neither side cross: before a space between another character and a visible Latin one. Byte-level
# words never hold a space behind their start, and pieces are checked when they are read.
_CUT = re.compile("(?<=[^ ])(?= [!-~À-ɏ])")
# What stands between two such places. New ones are read one behind the other, so many characters at a time.
_STRETCH = re.compile(" [!-~À-ɏ](?s:.*)(?<! )")
JOINED_LENGTH = 50_000
# Stretches that a worker keeps with their ids, up to a length; twice at most, as what was not used lately may go.
KEPT_STRETCHES, KEPT_LENGTH = 100_000, 64

Vocabulary = tuple[Callable[[list[str]], list[list[int]]], list[bytes]]


def _shown_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(content: str) -> Vocabulary:
    """A byte-level vocabulary: how it encodes texts, and the bytes of each id. Special tokens' strings are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    model = Tokenizer.from_str(content)
    model.encode_special_tokens = True
    shown, spelled = _shown_bytes(), [b""] * model.get_vocab_size()
    for token, i in model.get_vocab().items():
        spelled[i] = bytes([shown[c] for c in token]) if all(c in shown for c in token) else token.encode()
    return lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)], spelled


@lru_cache(maxsize=2)
def piece_level(content: bytes) -> Vocabulary:
    """A piece vocabulary that puts a space in front of a text by itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    spelled = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPACE_MARK, " ").encode()
        for i, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]
    if any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in map(model.id_to_piece, range(len(spelled)))):
        raise ValueError("the pieces cross word boundaries")
    return lambda texts: model.encode(texts, num_threads=1), spelled


class Reader:
    """Ids of both vocabularies for whole texts, put together from those of the different stretches in them."""

    def __init__(self, first: Vocabulary, second: Vocabulary):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = first, second
        self.sizes_a, self.sizes_b = (
            np.array([len(s) for s in spelled], dtype=np.int64) for spelled in (self.bytes_a, self.bytes_b))
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.earlier: dict[str, tuple[bytes, bytes, bool]] = {}

    def _learn(self, stretches: set[str]) -> None:
        if len(self.known) > KEPT_STRETCHES:
            self.known, self.earlier = {}, self.known
        joined: list[str] = []
        size = 0
        for stretch in stretches.difference(self.known):
            entry = self.earlier.get(stretch)
            if entry is not None:
                self.known[stretch] = entry
            elif _STRETCH.fullmatch(stretch):
                joined.append(stretch)
                size += len(stretch)
                if size > JOINED_LENGTH:
                    self._learn_joined(joined)
                    joined, size = [], 0
            else:
                self._learn_each([stretch])
        if joined:
            self._learn_joined(joined)

    def _learn_joined(self, new: list[str]) -> None:
        """No token crosses from one stretch into the next, so they are read as one text."""
        text = "".join(new)
        raw = text.encode()
        bounds = np.cumsum([len(s.encode()) for s in new])
        sides = []
        for ids, spelled, sizes in ((self.encode_a([text])[0], self.bytes_a, self.sizes_a),
                                    (self.encode_b([text[1:]])[0], self.bytes_b, self.sizes_b)):
            flat = np.array(ids, "<i4")
            ends = np.cumsum(sizes[flat])
            last = np.searchsorted(ends, bounds)
            if b"".join([spelled[i] for i in ids]) != raw or (ends[last] != bounds).any():
                return self._learn_each(new)
            packed, cuts = flat.tobytes(), (4 * (last + 1)).tolist()
            sides.append([packed[start:end] for start, end in zip([0, *cuts], cuts)])
        self.known.update(zip(new, zip(*sides, [True] * len(new))))

    def _learn_each(self, new: list[str]) -> None:
        for stretch, a, b in zip(new, self.encode_a(new), self.encode_b([s[1:] for s in new])):
            raw = stretch.encode()
            spelled = b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
            self.known[stretch] = np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes(), spelled

    def read(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids as 32-bit integers; none for empty texts and for those that either side does not spell."""
        cut = [_CUT.split(" " + text) if text else [] for text in texts]
        stretches = set(chain.from_iterable(cut))
        self._learn(stretches)
        a, b = [b""] * len(texts), [b""] * len(texts)
        for k, parts in enumerate(cut):
            if parts:
                ids_a, ids_b, spelled = zip(*map(self.known.__getitem__, parts))
                if all(spelled):
                    a[k], b[k] = b"".join(ids_a), b"".join(ids_b)
        for stretch in [s for s in stretches if len(s) > KEPT_LENGTH]:
            del self.known[stretch]
        return a, b


@lru_cache(maxsize=1)
def reader(byte_file: str, piece_file: bytes) -> Reader:
    """Set up once per worker."""
    return Reader(byte_level(byte_file), piece_level(piece_file))


def _flat(ids: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row, the text of each, and the byte behind each, counted over all texts."""
    flat = np.frombuffer(b"".join(ids), "<i4")
    return flat, np.repeat(np.arange(len(ids)), [len(i) // 4 for i in ids]), np.cumsum(sizes[flat])


def overlaps(a_doc: np.ndarray, a_starts: np.ndarray, b_doc: np.ndarray, b_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens (by position) that share bytes; tokens of either side cover each text without gaps.

    Of two tokens that share bytes the later start lies in the other token, or both start together. So the token of
    the other side that covers a start, found by ``merge_asof``, gives every pair in one direction or the other.
    """
    a, b = np.arange(len(a_starts)), np.arange(len(b_starts))
    left, right = pd.DataFrame({"at": a_starts, "doc": a_doc}), pd.DataFrame({"at": b_starts, "doc": b_doc})
    in_b = pd.merge_asof(left, right.assign(other=b), on="at", by="doc")["other"].to_numpy()
    in_a = pd.merge_asof(right, left.assign(other=a), on="at", by="doc")["other"].to_numpy()
    # Pairs that start together were found from both sides.
    new = a_starts[in_a] < b_starts
    return np.concatenate([a, in_a[new]]), np.concatenate([in_b, b[new]])


def _group_texts(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, n_docs: int,
                 group_doc: np.ndarray, a_words: np.ndarray, b_words: np.ndarray) -> list[str]:
    """Per text its groups as ``a1,a2|b1;a3|b2``. Groups are numbered over all texts, in order."""
    n_groups = len(group_doc)
    last_of_doc = np.ones(n_groups, dtype=bool)
    last_of_doc[:-1] = group_doc[1:] != group_doc[:-1]
    a_last = np.append(a_group[1:] != a_group[:-1], True)[:len(a_group)]
    b_last = np.append(b_group[1:] != b_group[:-1], True)[:len(b_group)]
    # Sorted by group and side, stably: the place of a token is its own number plus the tokens of the other side before it.
    a_of, b_of = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_through, b_before = np.cumsum(a_of), np.cumsum(b_of) - b_of
    parts = np.empty(len(a_ids) + len(b_ids), dtype=object)
    parts[np.arange(len(a_ids)) + b_before[a_group]] = a_words[a_last.astype(int), a_ids]
    parts[np.arange(len(b_ids)) + a_through[b_group]] = b_words[np.where(b_last, 1 + last_of_doc[b_group], 0), b_ids]
    ends = np.cumsum(np.bincount(group_doc, weights=a_of + b_of, minlength=n_docs)).astype(np.int64)
    whole = parts.tolist()
    return ["".join(whole[start:end]) for start, end in zip([0, *ends.tolist()], ends.tolist())]


@lru_cache(maxsize=4)
def _words(n: int, *ends: str) -> np.ndarray:
    return np.array([[f"{i}{end}" for i in range(n)] for end in ends], dtype=object)


def _by_text(codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order within each text; texts come in order already."""
    kinds, places = np.unique(codes, return_inverse=True)
    places = np.sort(docs * len(kinds) + places)
    return (kinds[places % len(kinds)], places // len(kinds)) if len(kinds) else (codes, docs)


def _aligned(texts: list[str], both: Reader) -> tuple[list, ...]:
    """Columns of :func:`align_tokens` behind the id."""
    ids_a, ids_b = both.read(texts)
    sizes_a, sizes_b = both.sizes_a, both.sizes_b
    a, a_doc, a_ends = _flat(ids_a, sizes_a)
    b, b_doc, b_ends = _flat(ids_b, sizes_b)
    at_a, at_b = overlaps(a_doc, a_ends - sizes_a[a], b_doc, b_ends - sizes_b[b])
    together = a_ends[at_a] == b_ends[at_b]
    at_a, at_b = at_a[together], at_b[together]
    link_doc = a_doc[at_a]
    # A group ends where tokens of both sides end.
    cuts, first_link = np.unique(a_ends[at_a], return_index=True)
    group_doc = link_doc[first_link]
    groups = _group_texts(a, np.searchsorted(cuts, a_ends), b, np.searchsorted(cuts, b_ends), len(texts), group_doc,
                          _words(len(sizes_a), ",", "|"), _words(len(sizes_b), ",", ";", ""))
    codes, docs = _by_text((a[at_a].astype(np.int64) << _SHIFT) | b[at_b], link_doc)
    starts = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1]))[:len(codes)])
    counts = np.diff(np.append(starts, len(codes)))
    lists = np.concatenate([[0], np.cumsum(np.bincount(docs[starts], minlength=len(texts)))]).astype(np.int32)
    return (
        [len(i) // 4 for i in ids_a], [len(i) // 4 for i in ids_b], np.bincount(group_doc, minlength=len(texts)),
        np.bincount(link_doc, minlength=len(texts)), groups,
        pa.ListArray.from_arrays(pa.array(lists), pa.array(codes[starts])),
        pa.ListArray.from_arrays(pa.array(lists), pa.array(counts, pa.int64())))


def align_tokens(docs: DataFrame, byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Alignment of a byte-level vocabulary (A) and a piece vocabulary (B) over whole texts.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, pair_links``, one row per row of ``docs``. Both read a
    space and the text. Byte offsets where tokens of both end cut them into groups, written ``a1,a2|b1;a3|b2`` in order. Of all
    pairs of tokens that share bytes, those that end together are links; ``pairs`` holds the different id pairs of the
    links (A's id times 2^32 plus B's, ascending) and ``pair_links`` how many links each has in the text.

    Null and empty texts, and texts whose tokens do not spell them on either side, have no tokens: zeros, no pairs and empty
    groups. Strings of special tokens are plain text. Null or repeated ids and repeated rows are kept, other columns
    ignored; an empty table gives none. Vocabularies are files of fixed size, read on the driver and set up once per
    worker. Texts are not shuffled; memory follows the longest text, or 1 MB of shorter ones.
    """
    context = docs.sparkSession.sparkContext
    files = context.broadcast((Path(byte_path).read_text(encoding="utf-8"), Path(piece_path).read_bytes()))
    json.loads(files.value[0])  # a broken file is refused on the driver
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = reader(*files.value)
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
        for batch in slices(batches, max_bytes=1_000_000):
            columns = _aligned([t or "" for t in next(columns_of(batch, "text"))], both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "pair_links"])

    return rows.mapInArrow(
        align, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        "groups string, pairs array<long>, pair_links array<long>")


def pair_table(aligned: DataFrame) -> DataFrame:
    """Links per id pair over all texts, as ``pair, total, best``; best: no pair of the same B id has more. Stored."""
    each = aligned.select(F.inline(F.arrays_zip("pairs", "pair_links"))).groupBy(F.col("pairs").alias("pair")).agg(
        F.sum("pair_links").alias("total"))
    each = settle(each.withColumn("b", F.col("pair").bitwiseAND((1 << _SHIFT) - 1)))
    most = each.groupBy("b").agg(F.max("total").alias("most"))
    return settle(each.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best")))


def link_strengths(aligned: DataFrame) -> DataFrame:
    """The columns of ``aligned`` but its arrays, with ``n_best`` and ``count_sum``.

    A pair counts as many as all texts have links of it. ``count_sum`` adds up the counts of a text's links; ``n_best``
    counts those whose pair has the highest count of its B id, ties included. ``aligned`` is stored first without the groups.
    Pairs are added up per text and task before they are shuffled; the table of pairs is at most as large as the
    product of the vocabularies, so its size is measured before it is broadcast.
    """
    stored = settle(aligned.drop("groups").withColumn("__row", F.monotonically_increasing_id()))
    pairs = pair_table(stored)
    links = stored.select("__row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), "pair_links")))
    strengths = lookup(links, pairs, "pair", "__row", "inner").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("pair_links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("pair_links") * F.col("total")).alias("count_sum"))
    rows = stored.drop("pairs", "pair_links").join(strengths, "__row", "left").drop("__row")
    return rows.fillna(0, ["n_best", "count_sum"])
