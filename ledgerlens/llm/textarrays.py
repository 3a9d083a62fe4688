"""Word hashes of many texts at once, with numpy.

``words`` turns a list of texts into one byte buffer, finds the words
(runs of anything but ASCII white space) and hashes each with a polynomial
over random 64-bit byte values modulo 2**64, taken from running sums. Nothing
is done a word at a time in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are handled in runs of about this many bytes; a longer text is a run alone.
RUN_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, RUN_BYTES + 4096)
        got = np.full(size, base & ((1 << 64) - 1), np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= 4 * RUN_BYTES:
            _powers[base] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(texts: list[str | None], most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last) index ranges of texts of about ``most`` characters together."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + (n := len(t or "")) > most:
            yield first, i
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield first, len(texts)


class Words:
    """Words of a list of texts: byte spans in ``buf``, hashes, and where each text's words begin."""

    def __init__(self, texts: list[str | None], lower: bool = True):
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        raw = b" ".join(encoded) + b" "
        if lower:
            raw = raw.translate(_LOWER)
        self.buf = np.frombuffer(raw, np.uint8)
        text_at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(e) + 1 for e in encoded], out=text_at[1:])
        space = _IS_SPACE[self.buf]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        #: text i has the words first[i] to first[i + 1]
        self.first = np.searchsorted(self.starts, text_at)
        self.text_at = text_at

    def hashes(self) -> np.ndarray:
        n = len(self.buf) + 1
        total = np.zeros(n, np.uint64)
        np.cumsum(_VALUES[self.buf] * _power(_BASE, n)[: n - 1], out=total[1:])
        raw = (total[self.ends] - total[self.starts]) * _power(_INVERSE, n)[self.starts]
        return mix(raw + (self.ends - self.starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` neighbouring words (whatever texts they lie in)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out + hashes[k : k + n])
    return out


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has one shingle, the whole sequence; a null text or
    one without words has none.
    """
    w = Words(texts)
    h = w.hashes()
    win = windows(h, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(win[a : b - size + 1]))
        elif b > a:
            out.append(windows(h[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


#: Most bits of a parity sketch.
SKETCH_BITS = 4096


def sketch(features: np.ndarray) -> np.ndarray:
    """Parities of the features dealt to as many bits as the set's size, rounded up to a power of two, has (64 to
    SKETCH_BITS), as 64-bit integers. Sketches of one length differ in no more bits than the sets in features."""
    bits = min(max(64, 1 << len(features).bit_length()), SKETCH_BITS)
    place = mix(features + np.uint64(0x60642E2A34326F15)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(bool)).view(np.int64)


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of words [start, end), from running sums: its cost does not grow with the runs' lengths."""
    n = len(hashes) + 1
    total = np.zeros(n, np.uint64)
    np.cumsum(hashes * _power(_BASE, n)[: n - 1], out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
