"""Words and shingles of whole texts as 64-bit hashes, on the UTF-8 bytes of Arrow columns.

A word is a run of bytes other than blank and tab to carriage return; A to Z
count as a to z. Both rules are about ASCII only, so they can be applied to
UTF-8 bytes. All functions work on whole texts; long ones are hashed slice by
slice, cut at white space, so that working memory is bounded by the slice (or
one word, where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ROLL = np.uint64(0xD1B54A32D192ED03)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers["up"]) < n:
        size = max(n, SLICE + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each one begins and ends; NULL is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def lower(b: np.ndarray) -> np.ndarray:
    """A to Z as a to z, in new bytes."""
    return b + (((b - np.uint8(65)) < 26).astype(np.uint8) << np.uint8(5))


def blank(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b - np.uint8(9)) <= 4)


def runs(classes: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal non-zero class; a run never crosses ``text_starts``."""
    n = len(classes)
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(classes[1:], classes[:-1], out=edge[1:n])
    edge[text_starts] = True
    cuts = np.flatnonzero(edge)
    keep = classes[cuts[:-1]] != 0
    return cuts[:-1][keep], cuts[1:][keep]


def run_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte run, from differences of one cumulative sum."""
    up, down = _grow(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_classes(b: np.ndarray) -> np.ndarray:
    return (~blank(b)).astype(np.uint8)


def token_classes(b: np.ndarray) -> np.ndarray:
    """0 blank, 1 letter or byte of a longer code, 2 digit, 3 other sign."""
    kind = np.full(len(b), 3, np.uint8)
    kind[((b | np.uint8(32)) - np.uint8(97)) < 26] = 1
    kind[b >= 128] = 1
    kind[(b - np.uint8(48)) < 10] = 2
    kind[blank(b)] = 0
    return kind


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a slice, cut between texts or, in longer texts, before white space."""
    begin, n = 0, len(data)
    while begin < n:
        end = begin + SLICE
        if end >= n:
            yield begin, n
            return
        after = np.searchsorted(offsets, end, "right") - 1
        cut = int(offsets[after])
        if cut <= begin:
            cut = end
            while cut < n and not bool(blank(data[cut : cut + 1])[0]):
                cut += 1
            cut = min(cut, int(offsets[after + 1])) if after + 1 < len(offsets) else cut
        yield begin, cut
        begin = cut


def hashed_runs(data: np.ndarray, offsets: np.ndarray, classes=word_classes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of all texts, and where those of each text begin and end."""
    (hashes,), bounds = prefixed_runs(data, offsets, classes, (None,))
    return hashes, bounds


def prefixed_runs(
    data: np.ndarray, offsets: np.ndarray, classes, prefixes: Sequence[int | None]
) -> tuple[list[np.ndarray], np.ndarray]:
    """As :func:`hashed_runs`, with hashes of the first bytes of each run for every length in ``prefixes`` (None: all)."""
    hashes: list[list[np.ndarray]] = [[] for _ in prefixes]
    places = []
    for begin, end in _slices(data, offsets):
        b = lower(data[begin:end])
        inside = offsets[(offsets > begin) & (offsets < end)] - begin
        starts, ends = runs(classes(b), inside)
        for own, length in zip(hashes, prefixes, strict=True):
            own.append(run_hashes(b, starts, ends if length is None else np.minimum(ends, starts + length)))
        places.append(starts + begin)
    if not places:
        return [np.zeros(0, np.uint64) for _ in prefixes], np.zeros(len(offsets), np.int64)
    place = np.concatenate(places)
    return [np.concatenate(own) for own in hashes], np.searchsorted(place, offsets, "left")


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; of fewer words, one hash of all; of none, nothing."""
    if len(words) == 0:
        return words
    width = min(k, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        total = total * _ROLL + words[i : len(words) - width + 1 + i]
    return mix(total)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingles, sorted."""
    return np.unique(shingles(words, k))
