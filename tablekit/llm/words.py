"""Words, shingles and their hashes for whole Arrow batches of texts, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text with A-Z lower-cased. A word's hash is a polynomial over
random 64-bit codes of its bytes, then mixed; a shingle's hash combines those of its words. Equal words have
equal hashes in every task, as all constants are fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are hashed in pieces of at most about so many bytes, whatever their length.
PIECE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_CODE[65:91] = _CODE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.array([0xA0761D6478BD642F], np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 4096)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return data[first:last], offsets - first


def _edges(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses a cut."""
    space = _SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[1:] = space
    before[0] = True
    before[cuts] = True
    starts = np.flatnonzero(~space & before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1] = space
    after[-1] = True
    after[cuts] = True
    return starts, np.flatnonzero(~space & after[1:]) + 1


def words(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple:
    """Of every word its hash, start and end; the offsets of the texts in these; a hash for each prefix length."""
    hashes, places, stops = [], [], []
    heads: list[list[np.ndarray]] = [[] for _ in prefixes]
    n, at = len(data), 0
    while at < n:
        end = _piece_end(data, offsets, at)
        part = data[at:end]
        low, high = np.searchsorted(offsets, [at, end])
        cuts = offsets[low : high + 1]
        starts, ends = _edges(part, cuts[cuts <= end] - at)
        forth, back = _powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_CODE[part] * forth[: len(part)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)))
        for k, head in zip(prefixes, heads):
            stop = np.minimum(starts + k, ends)
            head.append(mix((sums[stop] - sums[starts]) * back[starts] + U(1000 + k)))
        places.append(starts + at)
        stops.append(ends + at)
        at = end
    empty = np.zeros(0, np.int64)
    placed = np.concatenate([empty, *places])
    codes = [np.concatenate([empty.astype(np.uint64), *x]) for x in (hashes, *heads)]
    return codes[0], placed, np.concatenate([empty, *stops]), np.searchsorted(placed, offsets), codes[1:]


def _piece_end(data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """End of the piece that begins at a byte: a text's end or white space, so that no word is cut."""
    end = at + PIECE
    if end >= len(data):
        return len(data)
    stop = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
    if stop > at:
        return stop
    gaps = np.flatnonzero(_SPACE[data[at + PIECE // 2 : end]])
    if len(gaps):
        return at + PIECE // 2 + int(gaps[-1])
    following = int(offsets[np.searchsorted(offsets, at, side="right")])  # a very long word: take it whole
    gaps = np.flatnonzero(_SPACE[data[end:following]])
    return end + int(gaps[0]) if len(gaps) else following


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word shingle, and the offsets of the texts in them.

    A text with 1 to ``k - 1`` words has one shingle, its whole sequence; a text without words has none.
    """
    n = len(hashes)
    counts = np.diff(bounds)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(made)])
    if not n:
        return np.zeros(0, np.uint64), offsets
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        rolled[: n - j] += mix(hashes[j:] + _PLACE * U(2 * j + 1))
    rolled = mix(rolled + U(k))
    owner = np.repeat(np.arange(len(counts)), made)
    first = np.arange(len(owner)) - offsets[:-1][owner] + bounds[:-1][owner]
    out = rolled[first]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        own = hashes[bounds[d] : bounds[d + 1]]
        places = _PLACE * (2 * np.arange(len(own)) + 1).astype(np.uint64)
        whole = mix(own + places).sum(dtype=np.uint64, keepdims=True)
        out[offsets[d]] = mix(whole ^ mix(_PLACE + U(len(own))))[0]
    return out, offsets


def sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted."""
    for low, high in slices(column):
        hashes, _, _, bounds, _ = words(*texts(column.slice(low, high - low)))
        values, offsets = shingles(hashes, bounds, k)
        for d in range(high - low):
            yield np.unique(values[offsets[d] : offsets[d + 1]])


def slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes of text each, single rows where a text is longer."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield at, stop
        at = stop


def signature(values: np.ndarray) -> bytes:
    """16 bytes that stand for a set of hashes; equal sets have equal signatures."""
    one = mix(values + U(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    two = mix(values ^ U(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) ^ mix(_PLACE + U(len(values)))[0]
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")
