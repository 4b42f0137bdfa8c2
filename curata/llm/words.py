"""Vectorised word splitting and hashing over Arrow string columns.

Works on the UTF-8 buffers of a whole batch at once.  Separators are ASCII only, so
splitting bytes is the same as splitting characters.  A word is identified by a 64-bit
hash of its bytes; two different words agree with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Separators of a "word" for shingles: space and the ASCII controls \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII upper case to lower case, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = U(0x9E3779B97F4A7C15)  # odd: it has an inverse modulo 2**64
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
#: A fixed random 64-bit value for each byte.
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS = {"up": np.ones(1, U), "down": np.ones(1, U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply): spreads every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, U)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


#: Bytes hashed at once: the powers of the base, which a worker keeps, and the prefix sums take 32 bytes a byte.
SLAB = 1 << 18


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of ``raw[start:end]`` for sorted, disjoint spans."""
    out = np.empty(len(starts), U)
    lo = 0
    while lo < len(starts):
        first = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, first + SLAB, side="right")))
        block = raw[first:int(ends[hi - 1])]
        up, down = _powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, U)
        np.cumsum(_BYTE[block] * up[:len(block)], out=sums[1:])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = (sums[e] - sums[s]) * down[s] + (e - s).astype(U)
        lo = hi
    return mix(out)


def split(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE):
    """(starts, ends, counts): byte spans of the words in order, words a text."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    inside = ~separator[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    first[edges] = inside[edges]  # a text starts anew, whatever stands before it
    starts = np.flatnonzero(first)
    after = np.append(~inside, True)  # a word ends before a separator, a new text or the end
    after[edges] = True
    stops = np.flatnonzero(after)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    bounds = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(bounds)


def shingles(word: np.ndarray, counts: np.ndarray, size: int):
    """Distinct hashed runs of ``size`` words for every text.

    A text of 1 to ``size - 1`` words has its whole sequence as its one shingle; a text
    without words has none.  Returns (hashes sorted within each text, shingles a text)."""
    at = np.concatenate([[0], np.cumsum(counts)])
    n = len(word)
    doc = np.repeat(np.arange(len(counts)), counts)
    run = np.zeros(n, U)
    for k in range(size):
        shifted = np.zeros(n, U)
        if n > k:
            shifted[:n - k] = word[k:]
        run = run * U(0xD6E8FEB86659FD93) + shifted
    keep = np.arange(n) + size <= at[doc + 1] if n else np.zeros(0, bool)
    hashes, owner = mix(run[keep]), doc[keep]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.zeros(len(short), U)
        for j, d in enumerate(short):
            h = U(0)
            for w in word[at[d]:at[d + 1]]:
                h = U((int(h) * 0xD6E8FEB86659FD93 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            whole[j] = h
        # another constant: a short text never equals a run of ``size`` words
        hashes = np.concatenate([hashes, mix(whole ^ U(0xA5A5A5A55A5A5A5A))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.bincount(owner, minlength=len(counts))
