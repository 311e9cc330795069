"""Hashes of word runs, vectorised over a whole text."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of it."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTES = _splitmix(256, 11)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2 ** 64
_UNDO = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
#: Powers are kept for texts up to this many bytes.
_KEPT = 1 << 20


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i for i below n, modulo 2 ** 64."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    out = []
    for base in (_BASE, _UNDO):
        f = np.full(n, base, dtype=np.uint64)
        f[0] = 1
        out.append(np.multiply.accumulate(f))
    if n <= _KEPT:
        _powers[:] = out
    return out[0], out[1]


class Words:
    """The words of a text, A-Z lower-cased, parted by the white space x20 and x09-x0D, as byte spans of
    ``norm``, the words joined by single spaces."""

    def __init__(self, text: str):
        words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII white space; lowers A-Z alone
        self.norm = b" ".join(words)
        self.n = len(words)
        raw = np.frombuffer(self.norm, dtype=np.uint8)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate([[0], gaps + 1]) if self.n else gaps
        self.ends = np.concatenate([gaps, [len(raw)]]) if self.n else gaps
        up, self.down = _power(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(np.take(_BYTES, raw) * up[:-1], out=self.sums[1:])

    def hashes(self, size: int) -> np.ndarray:
        """The hash of the ``size`` words from each word on, as far as there are so many."""
        if self.n < size:
            return np.zeros(0, dtype=np.uint64)
        a, b = self.starts[:self.n - size + 1], self.ends[size - 1:]
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))

    def shingles(self, size: int = 5) -> np.ndarray:
        """Hashes of the distinct runs of ``size`` words, ascending; of the whole if there are fewer words."""
        return np.unique(self.hashes(min(size, self.n))) if self.n else np.zeros(0, dtype=np.uint64)
