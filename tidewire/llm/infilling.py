"""Fill-in-middle transformation: cuts between units, found in a wavelet matrix over character classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of, slices
from tidewire.llm.wavelet import WaveletMatrix

SENTINELS = ("<P>", "<S>", "<M>")
SEED, PLAIN_PERCENT, SPM_PERCENT = 1, 10, 20
# Classes of characters: a letter with another letter behind it, the last letter of a run, digits, spaces, line
# breaks (and the last character of a text, which ends a unit of any kind), others.
INNER, LAST, DIGIT, SPACE, BREAK, OTHER = range(6)
_LEVELS = 3
# The classes that end a unit: runs of ASCII letters and single other characters; lines with their break; characters.
UNITS = {"token": (LAST, DIGIT, SPACE, BREAK, OTHER), "line": (BREAK,), "char": (INNER, LAST, DIGIT, SPACE, BREAK, OTHER)}


def character_classes(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point of texts that follow each other; ``ends`` are the ends of those not empty."""
    classes = np.full(len(codes), OTHER, dtype=np.uint8)
    letter = ((codes | 32) - np.uint32(97)) < 26
    followed = np.zeros(len(codes), dtype=bool)
    followed[:-1] = letter[1:]
    followed[ends - 1] = False
    classes[letter] = LAST
    classes[letter & followed] = INNER
    classes[(codes - np.uint32(48)) < 10] = DIGIT
    classes[(codes == 32) | (codes == 9)] = SPACE
    classes[codes == 10] = BREAK
    classes[ends - 1] = BREAK
    return classes


def cuts(texts: list[str], first: np.ndarray, second: np.ndarray, unit: str = "token") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the places (code points) behind two of them, drawn from 0 to all by two random numbers."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    starts = stops - lengths
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    matrix = WaveletMatrix(character_classes(codes, stops[lengths > 0]), _LEVELS)
    kinds = UNITS[unit]
    n = matrix.count(kinds, stops) - matrix.count(kinds, starts)
    one, two = first % (n + 1), second % (n + 1)
    places = [matrix.reach(kinds, starts, stops, wanted) - starts for wanted in (np.minimum(one, two), np.maximum(one, two))]
    return n, places[0], places[1]


def draws(seed: int, doc_id: str | Column) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and id; a null id counts as an empty one."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "token", seed: int = SEED, plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = SENTINELS,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole texts rearranged for infilling, as ``doc_id, n, form, prefix_chars, middle_chars, output``.

    A text is cut in two places behind units (``token``: a run of ASCII letters or any other single character; ``line``;
    ``char``), each drawn from 0 to ``n`` by the digest of seed and id. ``psm`` puts prefix, suffix and middle behind
    their sentinels in that order, ``spm`` suffix, prefix and middle; ``plain`` leaves the text as it is. Lengths count
    code points and are null for plain rows. ``restored`` gives the text back.

    Texts of a batch share one wavelet matrix over character classes: sums of ranks count the units up to a place, and
    bisection on them finds the place behind a unit. Memory follows the longest text, or 1 MB of shorter ones. Texts are not shuffled.

    Null and empty texts, and those that hold a sentinel, are plain (the output of a null is empty). Null ids draw as an
    empty id. Repeated ids and rows are kept, each row for itself; other columns are ignored; an empty table gives none.
    """
    if len({*sentinels}) < 3 or "" in sentinels or any(one[0] in other[1:] for one in sentinels for other in sentinels):
        raise ValueError("three sentinels are needed whose first characters occur nowhere else in them")
    if unit not in UNITS:
        raise ValueError(f"units are {', '.join(UNITS)}")
    names = [f"draw{k}" for k in range(4)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
                       *[d.alias(name) for d, name in zip(draws(seed, doc_id), names)])
    p_mark, s_mark, m_mark = sentinels

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1_000_000):
            texts = next(columns_of(batch, "text"))
            h1, h2, h3, h4 = (batch.column(2 + k).to_numpy() for k in range(4))
            n, firsts, seconds = cuts(texts, h1, h2, unit)
            forms = np.where(h4 % 100 < spm_percent, "spm", "psm").tolist()
            outputs: list[str] = []
            for k, (value, a, b, plain) in enumerate(zip(
                    texts, firsts.tolist(), seconds.tolist(), (h3 % 100 >= 100 - plain_percent).tolist())):
                if plain or not value or any(mark in value for mark in sentinels):
                    forms[k] = "plain"
                    outputs.append(value)
                elif forms[k] == "psm":
                    outputs.append(f"{p_mark}{value[:a]}{s_mark}{value[b:]}{m_mark}{value[a:b]}")
                else:
                    outputs.append(f"{s_mark}{value[b:]}{p_mark}{value[:a]}{m_mark}{value[a:b]}")
            plain = np.array(forms) == "plain"
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(firsts, pa.int64(), mask=plain), pa.array(seconds - firsts, pa.int64(), mask=plain),
                 pa.array(outputs, pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(
        transform, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, "
        "middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of. No text with a sentinel was rearranged, so each stands there once."""
    p_mark, s_mark, m_mark = sentinels

    def between(after: str, before: str | None) -> Column:
        start = F.instr(output, after) + len(after)
        end = F.instr(output, before) if before else F.char_length(output) + 1
        return F.substring(output, start, end - start)

    return (
        F.when(form == "psm", F.concat(between(p_mark, s_mark), between(m_mark, None), between(s_mark, m_mark)))
        .when(form == "spm", F.concat(between(p_mark, m_mark), between(m_mark, None), between(s_mark, p_mark)))
        .otherwise(output))
