"""Words and shingles of a whole Arrow text column at once, in numpy.

Words are maximal stretches without white space (blank, U+0009 to U+000D), with A-Z lower-cased.
All hashes are 64-bit: a polynomial over random byte values for a word, a mixed weighted sum of
word hashes for a shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240117)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(2**40, 2**62)) | 5
_INVERSE = pow(_BASE, -1, 2**64)
_WEIGHTS = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, one text after the other, and where each begins (n + 1)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(places) or places[0] == places[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def words(data: np.ndarray, places: np.ndarray):
    """``(hash, text, start, end)`` of every word: its text's number and its bytes' places."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    low = _LOWER[data]
    space = _SPACE[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    before = edge[:-1].copy()
    before[1:] |= space[:-1]
    after = edge[1:].copy()
    after[:-1] |= space[1:]
    start = np.flatnonzero(before & ~space)
    end = np.flatnonzero(after & ~space) + 1
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[: len(data)], out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashed, np.searchsorted(places, start, "right") - 1, start, end


def shingles(hashed: np.ndarray, text: np.ndarray, n_texts: int, k: int = 5):
    """``(hash, text)`` of every k-word shingle; of a shorter text, its words as one."""
    counts = np.bincount(text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashed)
    if n >= k:
        total = hashed[: n - k + 1] * _WEIGHTS[0]
        for j in range(1, k):
            total = total + hashed[j : n - k + 1 + j] * _WEIGHTS[j]
        whole = text[: n - k + 1] == text[k - 1 :]
        full, owner = mix(total[whole]), text[: n - k + 1][whole]
    else:
        full, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array(
            [
                (hashed[first[d] : first[d + 1]] * _WEIGHTS[: counts[d]]).sum(dtype=np.uint64)
                for d in short
            ],
            np.uint64,
        )
        extra = extra + counts[short].astype(np.uint64) * _WEIGHTS[k + 1]
        full, owner = np.concatenate([full, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        full, owner = full[order], owner[order]
    return full, owner


def shingle_sets(column: pa.Array, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, places = column_bytes(column)
    hashed, text, _, _ = words(data, places)
    full, owner = shingles(hashed, text, len(column), k)
    cuts = np.searchsorted(owner, np.arange(len(column) + 1)).tolist()
    full = np.ascontiguousarray(full)
    for a, b in zip(cuts, cuts[1:]):
        full[a:b].sort()
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (owner[1:] != owner[:-1])
    full, owner = full[new], owner[new]
    cuts = np.searchsorted(owner, np.arange(len(column) + 1)).tolist()
    return [full[a:b] for a, b in zip(cuts, cuts[1:])]
