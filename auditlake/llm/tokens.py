"""Words of Arrow text batches as 64-bit hashes, in numpy.

All separators are ASCII, so words are found on the UTF-8 bytes without decoding them.
A word's hash is a polynomial of its bytes, taken from running sums, and mixed. Batches
are worked off in pieces of about ``PIECE_BYTES``, so the arrays stay small however long
a text or a batch is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
# An odd base with an inverse modulo 2**64, and the constants of a common
# 64-bit finalizer.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# anything but ASCII white space
BY_SPACE = np.ones(256, bool)
BY_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# ASCII letters and digits, and all beyond ASCII
BY_ALNUM = np.zeros(256, bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    BY_ALNUM[ord(_low) : ord(_high) + 1] = True
BY_ALNUM[128:] = True

_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(33))) * MIX_1
    h = (h ^ (h >> np.uint64(33))) * MIX_2
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            steps = np.full(n, base)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def _pieces(word: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of bytes that cut no word; ``first`` marks the first byte of each text."""
    at, n = 0, len(word)
    while at < n:
        end = min(n, at + PIECE_BYTES)
        if end < n:
            # on to the next place where a word may end
            width = 256
            while end < n:
                ahead = np.flatnonzero(~word[end : end + width] | first[end : end + width])
                if len(ahead):
                    end += int(ahead[0])
                    break
                end = min(n, end + width)
                width *= 2
        yield at, end
        at = end


def hash_words(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, lower: bool = True, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Hashes of all words of texts that lie end to end, and where each text's words begin.

    ``offsets`` has one entry more than there are texts, from 0; so has the second result.
    For each of ``prefixes`` a further result has the hashes of the first so many bytes of
    each word, of all of a shorter one.
    """
    word = letters[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[:-1]
    hashes, places, starters = [], [], [[] for _ in prefixes]
    for low, high in _pieces(word, first):
        w, f = word[low:high], first[low:high]
        before = np.empty_like(w)
        before[0], before[1:] = False, w[:-1]
        starts = np.flatnonzero(w & (~before | f))
        after = np.empty_like(w)
        after[-1], after[:-1] = False, w[1:] & ~f[1:]
        ends = np.flatnonzero(w & ~after)
        up, down = _power_tables(high - low)
        piece = data[low:high]
        values = (LOWER[piece] if lower else piece).astype(np.uint64) + np.uint64(1)
        sums = np.cumsum(values * up, dtype=np.uint64)
        base = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        hashes.append(mix((sums[ends] - base) * down[starts]))
        for found, n in zip(starters, prefixes, strict=True):
            found.append(mix((sums[np.minimum(ends, starts + n - 1)] - base) * down[starts]))
        places.append(starts + low)
    if not hashes:
        none = np.empty(0, np.uint64)
        return none, np.zeros(len(offsets), np.int64), *([none] * len(prefixes))
    ends = np.searchsorted(np.concatenate(places), offsets)
    return np.concatenate(hashes), ends, *(np.concatenate(f) for f in starters)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(low, high, bytes, offsets)`` of runs of rows of some ``PIECE_BYTES``; NULL is empty."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE_BYTES, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, by the place of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * BASE + hashes[j : j + n]
    return mix(total + np.uint64(k))


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
