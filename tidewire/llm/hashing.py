"""Word hashes of many texts at once, without a Python loop over words."""

from __future__ import annotations

import numpy as np

from tidewire.llm.common import WORD_BYTES

_RANDOM = np.random.default_rng(20240501)
_OF_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 2**64))
_SEPARATOR = b" \n "


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


class WordHasher:
    """64-bit hashes of words: differences of prefix sums of byte values times powers of one odd factor."""

    def __init__(self) -> None:
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _FACTOR))])
            self.inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _INVERSE))])

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in order, and where each text starts among them (one entry more than texts)."""
        encoded = [t.encode() if t else b"" for t in texts]
        raw = np.frombuffer(_SEPARATOR.join([*encoded, b""]).translate(WORD_BYTES), np.uint8)
        self._grow(len(raw))
        inside = np.concatenate([[False], raw != 0x20, [False]])
        edges = np.nonzero(inside[1:] != inside[:-1])[0]
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_OF_BYTE[raw] * self.powers[:len(raw)])])
        hashes = mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        borders = np.cumsum([0] + [len(e) + len(_SEPARATOR) for e in encoded])
        return hashes, np.searchsorted(starts, borders)
