"""Words of whole texts as 64-bit hashes, found and hashed by array operations over blocks of bytes.

A word is a maximal run of bytes that a table marks as such, so a word never crosses a text. Its hash is a
polynomial over random byte values modulo 2**64 (prefix sums, shifted back by the inverse power), then mixed:
equal words have equal hashes wherever they stand, different ones collide as 64-bit hashes do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes worked on at a time; a longer text is cut between words
ROWS = 1024  # rows of a column that are copied at a time
_BASE = 0x9E3779B97F4A7C17 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    folded = mix((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    return folded


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def bounds(kinds: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``kinds``; no run crosses a position in ``edges``."""
    first, last = kinds.copy(), kinds.copy()
    first[1:] &= ~kinds[:-1]
    last[:-1] &= ~kinds[1:]
    inner = edges[(edges > 0) & (edges < len(kinds))]
    first[inner] = kinds[inner]
    last[inner - 1] = kinds[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes, A-Z counted as a-z."""
    size = max(BLOCK, 1 << max(0, int(len(data) - 1).bit_length()))
    powers, inverse = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * powers[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, text offsets) of a binary column, at most about ``BLOCK`` bytes at a time.

    Null texts are empty. A longer text is a block of its own.
    """
    for base in range(0, len(texts), ROWS):
        part = texts.slice(base, ROWS).cast(pa.large_binary()).fill_null(b"")
        _, places, buffer = part.buffers()
        offsets = np.frombuffer(places, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(part):
            stop = int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1
            stop = min(max(stop, at + 1), len(part))
            yield base + at, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
            at = stop


def _cuts(data: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a long block that end where no word goes on."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            free = np.flatnonzero(~is_word[data[end : end + BLOCK]])
            if len(free):
                end += int(free[0])
                break
            end = min(end + BLOCK, len(data))
        yield at, end
        at = end


def words(
    texts: pa.Array, is_word: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: (first text, one after the last, bytes, owner, starts, ends, hashes) of their words.

    ``owner`` is the text's place in the column; starts and ends are places in the block's bytes.
    """
    for at, data, offsets in blocks(texts):
        if len(data) <= 2 * BLOCK:
            starts, ends = bounds(is_word[data], offsets)
            hashes = hash_runs(data, starts, ends) if len(data) else np.empty(0, np.uint64)
        else:  # one long text
            parts = []
            for a, b in _cuts(data, is_word):
                s, e = bounds(is_word[data[a:b]], np.empty(0, np.int64))
                parts.append((s + a, e + a, hash_runs(data[a:b], s, e)))
            starts, ends, hashes = (np.concatenate(c) for c in zip(*parts))
        owner = at + np.searchsorted(offsets, starts, "right") - 1
        yield at, at + len(offsets) - 1, data, owner, starts, ends, hashes


def byte_kinds(outside: str | bytes) -> np.ndarray:
    """A table of 256 flags: False for the listed byte values, A-Z standing for a-z."""
    table = np.ones(256, bool)
    table[list(outside.encode("latin-1") if isinstance(outside, str) else outside)] = False
    return table[LOWER]


SPACES = bytes([0x20, 9, 10, 11, 12, 13])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
