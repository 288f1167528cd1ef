"""SentencePiece encoding and decoding: the best n segmentations over the lattice of pieces."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of, short_slices
from tidewire.llm.lattice import BatchLattice

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 3
# Segments of each worker that keep their best path; when there are more, only those that came up again stay.
# Segments up to BATCH_LENGTH characters are solved side by side, up to BATCH_ROWS at once.
CACHE_SEGMENTS, BATCH_LENGTH, BATCH_ROWS = 300_000, 32, 4_000
# Of segments whose other segmentations were asked for, so many.
CACHE_OTHERS = 15_000
# Below the lowest score of a single character, as for an unknown character of a unigram model.
UNKNOWN_PENALTY = 10.0
# Pieces at or below this score (runs of spaces) are in the vocabulary to be decoded, not to be built.
NEVER_BUILT = -1e8
DECODE_ROWS = 500
# Sums of the same scores in another order differ by far less.
ROUNDING = 1e-3
_SPACE_MARK = "▁"


class PieceModel:
    """Pieces with their scores, and lattices over stretches of text that no piece crosses.

    Spaces stand for the space mark, so a text that holds the mark itself stays reversible: characters
    without a piece are spelled as byte pieces.
    """

    def __init__(self, content: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces: dict[str, tuple[float, tuple[int, ...]]] = {}
        self.byte_ids = [0] * 256
        self.spelled: dict[int, bytes] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace(_SPACE_MARK, " ")
                pieces[piece] = (model.get_score(i), (i,))
                self.spelled[i] = piece.encode()
        # Starts of pieces that are no pieces themselves have an empty entry.
        self.entries: dict[str, tuple] = {p[:k]: () for p in pieces for k in range(1, len(p))} | pieces
        self.pairs = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        single = [s for p, (s, _) in pieces.items() if len(p) == 1 and s > NEVER_BUILT]
        self.unknown = min(single, default=0.0) - UNKNOWN_PENALTY
        # Cut before the spaces of a word, around line ends and, if no piece holds both, between letters and others.
        cuts = [r" *[^\W\d_]+| *(?:[^ \n\w]|[\d_])+| +|\n", r" *[^ \n]+| +|\n"]
        kept = [c for c in cuts if all(re.fullmatch(c, p) for p in pieces)]
        if not kept:
            raise ValueError("the pieces cross word boundaries")
        self.segments = re.compile(kept[0]).findall
        self.batch = BatchLattice({p: (score, ids[0]) for p, (score, ids) in pieces.items()})
        self.known_n_best: dict[tuple[str, int], tuple[list[float], list[bytes], list[int]]] = {}
        self.known_order: dict[str, bool] = {}
        self._clear()

    def arcs_from(self, segment: str, i: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """The pieces that start at a position: end, score, ids."""
        entry, found, j = self.entries.get(segment[i]), [], i + 1
        if not entry:
            found.append((j, self.unknown, tuple([self.byte_ids[b] for b in segment[i].encode()])))
        while entry is not None:
            if entry:
                found.append((j, *entry))
            j += 1
            if j > len(segment):
                break
            entry = self.entries.get(segment[i:j])
        return found

    def arcs(self, segment: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each position the pieces that end there: start, score, ids."""
        size, get = len(segment), self.entries.get
        ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        for i in range(size):
            entry, j = get(segment[i]), i + 1
            if not entry:
                ending[j].append((i, self.unknown, tuple([self.byte_ids[b] for b in segment[i].encode()])))
            while entry is not None:
                if entry:
                    ending[j].append((i, *entry))
                j += 1
                if j > size:
                    break
                entry = get(segment[i:j])
        return ending

    @staticmethod
    def forward(ending: list[list[tuple[int, float, tuple[int, ...]]]]) -> list[float]:
        """Viterbi scores: the best way from the start to each position."""
        best = [0.0]
        for arcs in ending[1:]:
            best.append(max([best[i] + score for i, score, _ in arcs]))
        return best

    def n_best(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The best ``n`` segmentations."""
        return self.search(segment, n, np.inf)

    def search(self, segment: str, n: int, loss: float) -> list[tuple[float, tuple[int, ...]]]:
        """The best ``n`` segmentations by A* from the end to the start.

        The forward scores are the exact value of what is left, so every path taken from the heap can be
        completed at the value it stands under. Equal scores go by the ids, read from the end. If the last of
        the ``n`` is known to lose ``loss``, paths that lose more are not entered.
        """
        ending = self.arcs(segment)
        best = self.forward(ending)
        most = loss + ROUNDING - best[-1]
        heap: list[tuple[float, tuple[tuple[int, ...], ...], int, float]] = [(-best[-1], (), len(segment), 0.0)]
        found: list[tuple[float, tuple[int, ...]]] = []
        while heap and len(found) < n:
            _, path, at, behind = heapq.heappop(heap)
            if at == 0:
                found.append((behind, tuple(chain.from_iterable(reversed(path)))))
                continue
            for i, score, ids in ending[at]:
                value = -(best[i] + (score + behind))
                if value <= most:
                    heapq.heappush(heap, (value, path + (ids,), i, score + behind))
        return found

    def kept_n_best(self, segment: str, n: int) -> tuple[list[float], list[bytes], list[int]]:
        """Of the best ``n``: losses, ids as 32-bit integers, and places in the order of ids from the end."""
        found = self.known_n_best.get((segment, n))
        if found is None:
            if len(self.known_n_best) >= CACHE_OTHERS:
                self.known_n_best.clear()
            best = self.n_best(segment, n)
            backward = [ids[::-1] for _, ids in best]
            ordered = sorted(backward)
            found = self.known_n_best[segment, n] = (
                [best[0][0] - score for score, _ in best], [np.array(ids, "<i4").tobytes() for _, ids in best],
                [ordered.index(ids) for ids in backward])
        return found

    def second_precedes(self, segment: str, loss: float) -> bool:
        """Whether the ids of the second best, read from the end, come before those of the best; it loses ``loss``."""
        found = self.known_order.get(segment)
        if found is None:
            if len(self.known_order) >= CACHE_SEGMENTS:
                self.known_order.clear()
            best, second = [ids[::-1] for _, ids in self.search(segment, 2, loss)]
            found = self.known_order[segment] = second < best
        return found

    def _clear(self) -> None:
        """Known segments are numbered; of each there are score, loss of the second best, and where its ids start."""
        self.known: dict[str, int] = {}
        self.again = np.zeros(0, dtype=bool)
        self.scores, self.losses = np.zeros(0), np.zeros(0)
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<i4")

    def _forget(self) -> None:
        """Keep the segments that came up again since the last time, if these are few enough."""
        kept, names = np.flatnonzero(self.again), list(self.known)
        if len(kept) > CACHE_SEGMENTS // 2:
            return self._clear()
        self.known = {names[k]: number for number, k in enumerate(kept.tolist())}
        self.again = np.zeros(len(kept), dtype=bool)
        self.scores, self.losses = self.scores[kept], self.losses[kept]
        starts, sizes = self.starts[kept], self.starts[kept + 1] - self.starts[kept]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = self.ids[np.repeat(starts - self.starts[:-1], sizes) + np.arange(self.starts[-1])]

    def numbers(self, segments: list[str]) -> np.ndarray:
        """The numbers of segments; new ones are solved first. If they become too many, some are forgotten before."""
        if len(self.known) > CACHE_SEGMENTS:
            self._forget()
        earlier = len(self.known)
        numbers = np.fromiter(map(self.known.get, segments, repeat(-1)), np.int64, len(segments))
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            absent = [segments[at] for at in missing]
            self._solve(set(absent))
            numbers[missing] = [self.known[segment] for segment in absent]
        self.again[numbers[numbers < earlier]] = True
        return numbers

    def _solve(self, new: set[str]) -> None:
        """Find the best paths of new segments, short ones side by side."""
        short = sorted([t for t in new if len(t) <= BATCH_LENGTH], key=len, reverse=True)
        alone, solved = [t for t in new if len(t) > BATCH_LENGTH], []
        scores, losses, sizes, ids = [self.scores], [self.losses], [], [self.ids]
        for k in range(0, len(short), BATCH_ROWS):
            chunk = short[k:k + BATCH_ROWS]
            ok, counts, chunk_ids, chunk_scores, chunk_losses = self.batch.best(chunk)
            if not ok.all():
                alone += [t for t, fine in zip(chunk, ok.tolist()) if not fine]
                chunk = [t for t, fine in zip(chunk, ok.tolist()) if fine]
            solved += chunk
            sizes.append(counts[ok])
            ids.append(chunk_ids)
            scores.append(chunk_scores[ok])
            losses.append(chunk_losses[ok])
        for segment in alone:
            each = [self._best(p) for p in self.parts(segment)]
            spelled = np.frombuffer(b"".join([e[0] for e in each]), "<i4")
            solved.append(segment)
            sizes.append(np.array([len(spelled)]))
            ids.append(spelled)
            scores.append(np.array([sum([e[1] for e in each])]))
            losses.append(np.array([min([e[2] for e in each])]))
        self.known.update(zip(solved, range(len(self.known), len(self.known) + len(solved))))
        self.again = np.concatenate([self.again, np.zeros(len(solved), dtype=bool)])
        self.scores, self.losses = np.concatenate(scores), np.concatenate(losses)
        ends = len(self.ids) + np.cumsum(np.concatenate(sizes))
        self.starts = np.concatenate([self.starts, ends.astype(np.int64)])
        self.ids = np.concatenate(ids)

    def parts(self, segment: str) -> list[str]:
        """The segment cut between neighbours that no piece holds together."""
        cuts = [k for k in range(1, len(segment)) if segment[k - 1:k + 1] not in self.pairs]
        return [segment[i:j] for i, j in zip([0, *cuts], [*cuts, len(segment)])] if cuts else [segment]

    def _best(self, segment: str) -> tuple[bytes, float, float]:
        """One forward pass that keeps the best two scores at each position."""
        size = len(segment)
        first, second = [0.0] + [-np.inf] * size, [-np.inf] * (size + 1)
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (size + 1)
        for i in range(size):
            one, two = first[i], second[i]
            for j, score, ids in self.arcs_from(segment, i):
                value, next_value = one + score, two + score
                if value > first[j] or value == first[j] and ids < back[j][1]:
                    second[j] = max(first[j], next_value)
                    first[j], back[j] = value, (i, ids)
                elif value > second[j] or next_value > second[j]:
                    second[j] = max(value, next_value)
        at, path = size, []
        while at:
            at, ids = back[at]
            path.append(ids)
        return np.array(list(chain.from_iterable(reversed(path))), "<i4").tobytes(), first[-1], first[-1] - second[-1]

    def encode_all(self, texts: list[str | None], n: int) -> list[list[tuple[float, bytes]] | None]:
        """The best ``n`` segmentations of whole texts, as score and ids; None for None.

        All paths pass the borders between segments, so scores add up.
        """
        cut = [self.segments(" " + text) if text else [] for text in texts]
        numbers = self.numbers(list(chain.from_iterable(cut)))
        starts, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        before = np.concatenate([[0], np.cumsum(sizes)])
        whole = self.ids[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])].tobytes()
        scores, losses, before = self.scores[numbers].tolist(), self.losses[numbers], (4 * before).tolist()
        found: list[list[tuple[float, bytes]] | None] = []
        at = 0
        for text, segments in zip(texts, cut):
            end = at + len(segments)
            best = (sum(scores[at:end], 0.0), whole[before[at]:before[end]])
            found.append(None if text is None else [best] if not segments else self._best_n(
                best, segments, losses[at:end], before[at:end + 1], n))
            at = end
        return found

    def _best_n(self, best: tuple[float, bytes], segments: list[str], losses: np.ndarray, places: list[int],
                n: int) -> list[tuple[float, bytes]]:
        """The best ``n`` segmentations of a whole text; ``places`` tell where the ids of each segment start.

        One among the best n can deviate only in the n - 1 segments whose second best loses least; the others
        keep their best. A* reads the paths of the chosen segments, with ``n`` 1 that of the one that is least sure.
        Equal scores go by the ids, read from the end.
        """
        total, whole = best
        chosen = self._deviating(segments, losses, max(n, 2))
        choices = [self.kept_n_best(segments[k], n) for k in chosen]
        # The stretches of ids around the chosen segments stay as they are.
        kept, behind = [], 0
        for k in chosen:
            kept.append(whole[behind:places[k] - places[0]])
            behind = places[k + 1] - places[0]
        found = []
        for loss, ranks in least_losses([c[0] for c in choices], n, [c[2] for c in choices]):
            parts = chain.from_iterable(zip(kept, [choice[1][rank] for choice, rank in zip(choices, ranks)]))
            found.append((total - loss, b"".join([*parts, whole[behind:]])))
        return found

    def _deviating(self, segments: list[str], losses: np.ndarray, n: int) -> list[int]:
        """The ``n - 1`` segments whose second best loses least, by position.

        Among equal losses, read from the end, a change to smaller ids is best made late and one to larger ids early.
        """
        least = np.partition(losses, n - 2)[: n - 1] if len(losses) > n - 1 else losses
        least = least[least < np.inf]
        if not len(least):
            return []
        limit = least.max()
        tied = np.flatnonzero(losses == limit).tolist()
        sure = np.flatnonzero(losses < limit).tolist()
        wanted = len(least) - len(sure)
        if len(tied) > wanted:
            late, rest = [], []
            for k in reversed(tied):
                (late if self.second_precedes(segments[k], limit) else rest).append(k)
                if len(late) == wanted:
                    break
            tied = (late + rest[::-1])[:wanted]
        return sorted(sure + tied)

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids; control pieces are silent, broken byte sequences become U+FFFD."""
        raw = b"".join([self.spelled.get(i, b"") for i in ids])
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def least_losses(losses: list[list[float]], n: int,
                 places: list[list[int]] | None = None) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` combinations of one entry per list with the least sums; each list ascends from zero.

    Equal sums go by the ``places`` of the entries (by default their ranks), read from the last list.
    """
    def key(ranks: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(p[r] for p, r in zip(places, ranks))[::-1] if places else ranks[::-1]

    start = (0,) * len(losses)
    heap: list[tuple[float, tuple[int, ...], tuple[int, ...]]] = [(0.0, key(start), start)]
    found: list[tuple[float, tuple[int, ...]]] = []
    while heap and len(found) < n:
        loss, _, ranks = heapq.heappop(heap)
        found.append((loss, ranks))
        last = max((k for k, r in enumerate(ranks) if r), default=0)
        for k in range(last, len(ranks)):
            if ranks[k] + 1 < len(losses[k]):
                raised = (*ranks[:k], ranks[k] + 1, *ranks[k + 1:])
                heapq.heappush(heap, (sum(each[r] for each, r in zip(losses, raised)), key(raised), raised))
    return found


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_KEPT: dict[bytes, PieceModel] = {}


def _kept_model(content: bytes) -> PieceModel:
    """The last model of this worker, which goes from task to task with the segments it knows; these are bounded."""
    digest = hashlib.sha256(content).digest()
    if digest not in _KEPT:
        _KEPT.clear()
        _KEPT[digest] = PieceModel(content)
    return _KEPT[digest]


def encode_pieces(docs: DataFrame, model_path: str = DEFAULT_MODEL, n: int = NBEST, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The best ``n`` segmentations of whole texts, as ``doc_id, n_tokens, nbest``.

    ``nbest`` holds structs ``score, ids`` by falling score; fewer than ``n`` if the lattice has fewer paths.
    ``n_tokens`` counts the ids of the first. A text gets one space in front; characters without a piece
    are spelled as byte pieces, so that decoding returns the text exactly.

    Texts are cut where no piece crosses (before the spaces of a word, around line ends). Per segment a
    Viterbi pass gives the best path and how much the second best loses. These losses choose the at most ``n - 1``
    segments in which the best ``n`` can deviate (one for ``n`` 1); only there, and to settle equal losses, A* reads
    segmentations backward under forward scores. Equal scores go by the ids, read from the end. Workers keep the best
    path of recent segments, up to a bound. The vocabulary (a file of fixed size, read on the driver)
    goes to the executors; documents are not shuffled.

    A null text has null ``n_tokens`` and ``nbest``; an empty one has one segmentation without ids and score 0.
    Null or repeated ids and repeated rows are kept. Other columns are ignored.
    """
    content = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _kept_model(content.value)
        for batch in short_slices(batches, max_bytes=1_000_000):
            found = model.encode_all(next(columns_of(batch, "text")), n)
            flat = [entry for entries in found for entry in entries or ()]
            lengths = np.array([len(ids) // 4 for _, ids in flat], dtype=np.int32)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join([ids for _, ids in flat]), "<i4")))
            structs = pa.StructArray.from_arrays(
                [pa.array([score for score, _ in flat], pa.float64()), ids], names=["score", "ids"])
            offsets = np.concatenate([[0], np.cumsum([len(e or ()) for e in found])])
            nbest = pa.ListArray.from_arrays(
                pa.array([None if e is None else int(o) for e, o in zip(found, offsets)] + [int(offsets[-1])], pa.int32()),
                structs)
            counts = pa.array([None if e is None else len(e[0][1]) // 4 for e in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, nbest], names=["doc_id", "n_tokens", "nbest"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        encode, f"doc_id {id_type}, n_tokens long, nbest array<struct<score: double, ids: array<int>>>")


def _spellings(content: bytes) -> pa.BinaryArray:
    """The bytes of each id; control pieces are silent."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    return pa.array(
        [b"" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else
         bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else
         model.id_to_piece(i).replace(_SPACE_MARK, " ").encode() for i in range(model.get_piece_size())], pa.binary())


def _decoded(ids: pa.ListArray, spelled: pa.BinaryArray) -> pa.StringArray:
    """The texts of sequences of ids, as ``PieceModel.decode`` gives them; ids outside the vocabulary are silent."""
    flat = ids.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(spelled)))
    each = spelled.take(pc.if_else(known, flat, pa.scalar(None, flat.type)))
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    raw = pc.binary_join(pa.ListArray.from_arrays(offsets, pc.fill_null(each, b"")), b"")
    texts = [r[1:] if r.startswith(b" ") else r for r in raw.to_pylist()]
    return pa.array([None if null else t.decode("utf-8", "replace") for t, null in zip(texts, ids.is_null().to_pylist())], pa.string())


def decode_pieces(docs: DataFrame, ids: Column, model_path: str = DEFAULT_MODEL, doc_id: str = "doc_id") -> DataFrame:
    """The texts of sequences of ids, as ``doc_id, decoded``; null ids give a null text, no ids the empty text."""
    content = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    rows = docs.select(F.col(doc_id).alias("doc_id"), ids.alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _spellings(content.value)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(start, DECODE_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), _decoded(part.column(1), spelled)], names=["doc_id", "decoded"])

    return rows.mapInArrow(decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")
