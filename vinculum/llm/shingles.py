"""Word shingles of whole texts as 64-bit hashes, computed for many texts at a time.

Words are maximal runs of bytes outside space and 0x09-0x0D after lower-casing A-Z.  Each
word gets a 64-bit polynomial hash (random coefficient per byte value), each shingle a mixed
combination of its words' hashes.  A text with fewer words than the shingle length has one
shingle made of its whole word sequence; a text without words (or null) has none.
Two different shingles share a hash with chance about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C13)  # odd, 3 mod 4: invertible, and base - 1 has one factor 2
_INVERSE = _U(pow(0x9E3779B97F4A7C13, -1, 1 << 64))
#: Text bytes hashed at once; bounds the tables of powers.
CHUNK = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
_COEF = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_COEF[65:91] = _COEF[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def forget() -> None:
    """Drops the tables of powers; they are made again when needed."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply rounds)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for i, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def _hash_words(buf: np.ndarray, starts_of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of a byte buffer of adjoining texts."""
    n = len(buf)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = _IS_WORD[buf]
    edge = np.zeros(n + 1, bool)
    edge[1:n] = word[1:] != word[:-1]
    edge[0] = edge[n] = True
    edge[starts_of_text[starts_of_text < n]] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = word[starts]
    starts, ends = starts[keep], ends[keep]
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_COEF[buf] * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)), starts


def _long_words(buf: np.ndarray) -> np.ndarray:
    """Word hashes of one very long text, piece by piece, cut where no word is split."""
    out, lo, n = [], 0, len(buf)
    first = np.zeros(1, np.int64)
    while lo < n:
        hi = min(n, lo + CHUNK)
        while hi < n:
            gap = np.flatnonzero(~_IS_WORD[buf[hi : hi + CHUNK]])
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(n, hi + CHUNK)
        out.append(_hash_words(buf[lo:hi], first)[0])
        lo = hi
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (nulls empty) and the n + 1 offsets into them."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the n + 1 offsets of each text's words."""
    buf, offsets = text_buffer(column)
    if len(column) == 1 and len(buf) > 2 * CHUNK:
        h = _long_words(buf)
        return h, np.array([0, len(h)])
    h, starts = _hash_words(buf, offsets[:-1])
    return h, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the n + 1 offsets of the sets."""
    h, offsets = words(column)
    n_words = np.diff(offsets)
    n_out = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    text = np.repeat(np.arange(len(n_words)), n_out)
    first = np.concatenate([[0], np.cumsum(n_out)])
    at = offsets[:-1][text] + np.arange(first[-1]) - first[:-1][text]
    left = np.minimum(offsets[1:][text] - at, k)
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        term = h[np.minimum(at + j, max(0, len(h) - 1))] if len(h) else acc
        acc = mix(acc * _U(0x9FB21C651E98DF25) + term) if j == 0 else np.where(left > j, mix(acc * _U(0x9FB21C651E98DF25) + term), acc)
    order = np.lexsort((acc, text))
    acc, text = acc[order], text[order]
    if len(acc):
        new = np.ones(len(acc), bool)
        new[1:] = (acc[1:] != acc[:-1]) | (text[1:] != text[:-1])
        acc, text = acc[new], text[new]
    return acc, np.searchsorted(text, np.arange(len(n_words) + 1))


def signature_seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7151))
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(values: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Min-hash signatures (rows: texts, columns: n functions, uint32); empty sets all ones."""
    a, b = signature_seeds(n)
    out = np.full((len(offsets) - 1, n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    starts = offsets[:-1][full]
    # Blocks of whole sets that stay in the cache; a longer set is a block of its own.
    cuts = [0]
    while cuts[-1] < len(full):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + 16384, side="left"))))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        end = starts[hi] if hi < len(full) else offsets[-1]
        x, at = values[starts[lo] : end], starts[lo:hi] - starts[lo]
        for s in range(0, len(x), 1 << 18):  # a very long set in pieces
            part = x[s : s + (1 << 18)]
            seg = np.unique(np.maximum(at, s) - s) if s else at
            seg = seg[seg < len(part)]
            rows = np.searchsorted(at, seg + s, side="right") - 1
            for i in range(n):
                v = ((part * a[i] + b[i]) >> _U(32)).astype(np.uint32)
                m = np.minimum.reduceat(v, seg)
                out[full[lo + rows], i] = np.minimum(out[full[lo + rows], i], m)
    return out
