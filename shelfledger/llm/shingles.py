"""Word shingles as 64-bit hashes, computed on the bytes of whole Arrow columns.

Words are runs of bytes other than space and 0x09-0x0D, after lower-casing A-Z; so words of UTF-8 texts are exact. A word's
hash takes eight bytes at a time and mixes after each, all words of a run at once; longer words than LONG_WORD are hashed one
by one. A shingle's hash mixes those of its words with their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SEED, ODD = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15)
LONG_WORD = 64
#: Masks for the lowest bytes of eight.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)
STEP = 0xD6E8FEB86659FD93
CHUNK_BYTES = 1 << 17

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a run of bytes."""
    size = len(data)
    padded = np.zeros(size + 8, np.uint8)
    padded[:size] = LOWER[data]
    inside = ~IS_SPACE[padded[:size]]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = ends - starts
    eights = np.ndarray(size + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    hashes = mixed(lengths.astype(np.uint64) + SEED)
    active = np.flatnonzero(lengths <= LONG_WORD)
    done = 0
    while len(active):
        left = lengths[active] - done
        part = eights[starts[active] + done]
        part = np.where(left < 8, part & LOW_BYTES[np.minimum(left, 7)], part)
        hashes[active] = mixed((hashes[active] ^ part) * ODD)
        done += 8
        active = active[left > 8]
    for at in np.flatnonzero(lengths > LONG_WORD).tolist():
        hashes[at] = xxhash.xxh3_64_intdigest(padded[starts[at] : ends[at]].tobytes(), seed=int(SEED) & 0xFFFFFFFF)
    return starts, hashes


def distinct(hashes: np.ndarray) -> np.ndarray:
    """In order; sorting beats hashing at the size of a text."""
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def _sets(words: np.ndarray, owner: np.ndarray, n_texts: int, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; with fewer words, the whole sequence is one."""
    counts = np.bincount(owner, minlength=n_texts)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = max(len(words) - size + 1, 0)
    hashes = np.zeros(total, np.uint64)
    for place in range(size):
        hashes = mixed(hashes + words[place : place + total] * np.uint64(pow(STEP, place, 1 << 64)))
    found = []
    for at in range(n_texts):
        begin, n = bounds[at], counts[at]
        if n >= size:
            found.append(distinct(hashes[begin : begin + n - size + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for place in range(n):
                whole = mixed(whole + words[begin + place : begin + place + 1] * np.uint64(pow(STEP, place, 1 << 64)))
            found.append(mixed(whole + np.uint64(n)))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def runs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of a column's texts in order, with where each text begins; a space after each keeps words apart.

    Texts are taken together up to 128 KB; a longer one alone, with memory in proportion to it. A null is empty.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        end = min(end, len(texts))
        lengths = np.diff(offsets[at : end + 1])
        run = np.full(int(offsets[end] - offsets[at]) + end - at, 0x20, np.uint8)
        begins = offsets[at:end] - offsets[at] + np.arange(end - at)
        for begin, start, length in zip(begins.tolist(), offsets[at:end].tolist(), lengths.tolist(), strict=True):
            run[begin : begin + length] = data[start : start + length]
        yield run, begins
        at = end


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of each text of a column, in order; an empty one for a null, empty or blank text."""
    for run, begins in runs(texts):
        starts, words = word_hashes(run)
        yield from _sets(words, np.searchsorted(begins, starts, "right") - 1, len(begins), size)


def signature(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    value = xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles) & 0xFFFF)
    return value - (1 << 64) if value >> 63 else value
