"""Best paths through the piece lattices of many short stretches of text at once."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 18
_GAP = chr(0)


def _keys(chars: np.ndarray, ends: list[int]) -> list[np.ndarray]:
    """For each length the keys of all stretches of that length among the first characters, up to the end for that length."""
    wide = chars.astype(np.uint64) + np.uint64(1)
    keys, last = [], wide[:0]
    for length, end in enumerate(ends, 1):
        tail = wide[length - 1:end]
        last = tail * _FACTOR if length == 1 else (last[:len(tail)] + tail) * _FACTOR
        keys.append(last ^ (last >> np.uint64(29)))
    return keys


class BatchLattice:
    """A table of pieces, and Viterbi passes over short texts side by side.

    The two best scores are kept at each position; ties go to the smaller id. A text with a character
    outside the pieces is left out (``ok`` is False): such characters are spelled as several ids.
    """

    def __init__(self, pieces: dict[str, tuple[float, int]]):
        if any(_GAP in p for p in pieces):
            raise ValueError("a piece holds the character that parts the texts")
        self.longest = max(map(len, pieces))
        self.slots = np.zeros(1 << _TABLE_BITS, dtype=np.uint64)
        self.scores = np.full(1 << _TABLE_BITS, -np.inf)
        self.ids = np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
        self.probes = 1
        for piece, (score, i) in pieces.items():
            key = _keys(_chars(piece), [len(piece)] * len(piece))[-1][0]
            at, probe = int(key >> np.uint64(64 - _TABLE_BITS)), 1
            while self.slots[at]:
                at, probe = (at + 1) % len(self.slots), probe + 1
            self.slots[at], self.scores[at], self.ids[at] = key, score, i
            self.probes = max(self.probes, probe)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the table, or of an empty slot."""
        home = (keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        kept = self.slots[home]
        found = np.where(kept == keys, home, -1)
        open_ = np.flatnonzero((kept != keys) & (kept != 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = (home[open_] + probe) % len(self.slots)
            kept = self.slots[at]
            same = kept == keys[open_]
            found[open_[same]] = at[same]
            open_ = open_[~same & (kept != 0)]
        return found

    def best(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts by falling length: whether they are ``ok``, how many ids each has and all ids in a row, scores, losses
        of the second best. A text that is not ``ok`` has no ids."""
        sizes = np.array([len(t) for t in texts])
        longest, count = int(sizes[0]), len(texts)
        # One row of characters with a gap behind each text; no piece holds the gap, so none crosses it.
        flat = _chars(_GAP.join(texts) + _GAP)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        # So many texts, from the first, reach each position; stretches of a length are looked up in these only.
        reach = np.searchsorted(-sizes, -np.arange(longest + 1), side="right")
        ends = np.cumsum(sizes + 1)[reach - 1].tolist()
        places = [self._find(k) for k in _keys(flat, ends[1:self.longest + 1])]
        unknown = places[0] < 0
        unknown[starts + sizes] = False
        ok = ~np.logical_or.reduceat(unknown, starts)
        first = np.full((longest + 1, count), -np.inf)
        second = np.full((longest + 1, count), -np.inf)
        took = np.zeros((longest + 1, count), dtype=np.int64)
        which = np.full((longest + 1, count), -1, dtype=np.int32)
        first[0] = 0.0
        for end in range(1, longest + 1):
            at = starts[:reach[end]] + end
            for length in range(1, min(end, self.longest) + 1):
                place = places[length - 1][at - length]
                known = np.flatnonzero(place >= 0)
                if not len(known):
                    continue
                place = place[known]
                score, i = self.scores[place], self.ids[place]
                value, follow = first[end - length, known] + score, second[end - length, known] + score
                top, now = first[end, known], which[end, known]
                better = (value > top) | ((value == top) & (i < now))
                second[end, known] = np.maximum(np.maximum(second[end, known], follow), np.minimum(top, value))
                won = known[better]
                first[end, won], took[end, won], which[end, won] = value[better], length, i[better]
        at = np.where(ok, sizes, 0)
        tokens = np.zeros((count, longest), dtype="<i4")
        filled = np.zeros(count, dtype=np.int64)
        live = np.flatnonzero(at)
        while len(live):
            filled[live] += 1
            tokens[live, longest - filled[live]] = which[at[live], live]
            at[live] -= took[at[live], live]
            live = live[at[live] > 0]
        ids = tokens[np.arange(longest) >= longest - filled[:, None]]
        whole = first[sizes, np.arange(count)]
        return ok, filled, ids, whole, np.where(ok, whole, 0.0) - second[sizes, np.arange(count)]


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")
