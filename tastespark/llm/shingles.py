"""Hashed word shingles of whole texts, computed on byte buffers (many texts at once)."""

from __future__ import annotations

import numpy as np

from tastespark.llm.common import make_room, mix64, text_chunks

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 19)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for base in (_BASE, inverse):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes], separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order (A-Z in lower case), and the first word of each text
    (one entry more than texts).  A word's hash is a polynomial over random byte values, mixed.
    ``separator`` tells for each byte whether it stands between words; a space always does."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    gap = separator[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    # the buffer ends in a separator, so words begin and end alternately at the edges
    marks = edge if gap[0] else np.concatenate([[0], edge])
    starts, ends = marks[0::2], marks[1::2]
    up, down = _powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    h = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP[63])
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return h, first


def shingle_sets(texts: list, width: int = 5):
    """(index, sorted distinct shingle hashes as unsigned 64-bit) for each text in order.  With fewer
    words than ``width`` the whole sequence is one shingle; without words the set is empty."""
    make_room()
    for a, b in text_chunks(texts, 1 << 20):
        h, first = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts[a:b]])
        n = len(h) - width + 1
        rolled = np.zeros(max(n, 0), dtype=np.uint64)
        for k in range(width if n > 0 else 0):
            rolled += h[k:k + n] * _STEP[k]
        rolled = mix64(rolled)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= width:
                yield a + i, np.unique(rolled[lo:hi - width + 1])
            elif hi > lo:
                w = h[lo:hi]
                parts = np.concatenate([w * _STEP[:len(w)], np.full(len(w), _STEP[62])])
                yield a + i, mix64(parts.sum(keepdims=True, dtype=np.uint64))
            else:
                yield a + i, np.zeros(0, dtype=np.uint64)


def mixed_sums(s: np.ndarray) -> np.ndarray:
    """Running sums of a set's mixed hashes, from 0 on."""
    total = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(mix64(s), dtype=np.uint64, out=total[1:])
    return total


def set_hash(s: np.ndarray, total: np.ndarray | None = None) -> int:
    """64 bits of a set, independent of order; signed.  ``total``: its ``mixed_sums`` where they are there already."""
    if not len(s):
        return 0
    whole = (mixed_sums(s) if total is None else total)[-1:] + np.full(1, len(s), np.uint64) * _STEP[61]
    return int(mix64(whole).view(np.int64)[0])


def parity_sketch(s: np.ndarray, least: int = 256, most: int = 4096) -> bytes:
    """Parity of the number of elements in each class of hashes: the sketches of two sets differ in at
    most as many bits as the sets differ in elements.  Four bits an element, rounded up to a power of two
    between ``least`` and ``most``; a longer sketch folds to a shorter one by exclusive or of its halves."""
    bits = min(most, max(least, 1 << (4 * max(len(s), 1) - 1).bit_length()))
    counts = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def stacked_sketches(sketches) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    sizes = np.fromiter((len(x) for x in sketches), dtype=np.int64, count=len(sketches))
    width = int(sizes.min()) // 8
    out = np.empty((len(sizes), width), dtype=np.uint64)
    for size in np.unique(sizes):
        which = np.flatnonzero(sizes == size)
        words = np.frombuffer(b"".join([sketches[i] for i in which]), dtype=np.uint64).reshape(len(which), -1, width)
        out[which] = np.bitwise_xor.reduce(words, axis=1)
    return out
