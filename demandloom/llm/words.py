"""Words and word shingles of Arrow string batches, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

M1 = np.uint64(0xBF58476D1CE4E5B9)
M2 = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def slices(texts: pa.Array, most: int):
    """(start, length) of runs of whole texts with about ``most`` bytes each, so that a
    batch of very long texts is not worked on at once."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i - start
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes) - start


def word_lists(texts: pa.Array, lower: bool = True):
    """Distinct words, the number of each word in the text's order, and where each text's
    words begin. A-Z are lower-cased; words are runs without space and \\t\\n\\v\\f\\r."""
    # taken into an array of its own: string kernels misread a slice of a larger one
    texts = pc.fill_null(texts, "").take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = split.values, split.offsets.to_numpy()
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    names = coded.dictionary.to_pylist()
    if "" in names:  # white space at an end of a text leaves an empty piece
        kept = codes != names.index("")
        before = np.concatenate(([0], np.cumsum(kept)))
        codes, offsets = codes[kept], before[offsets]
    return names, codes, offsets


def hashed_words(texts: pa.Array):
    """A 64-bit hash per word, and where each text's words begin."""
    names, codes, offsets = word_lists(texts)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in names), np.uint64, len(names))
    return table[codes] if len(names) else np.zeros(0, np.uint64), offsets


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A shingle is ``width`` words; a shorter text is one shingle of all its words, and a
    text without words has none.
    """
    words, offsets = hashed_words(texts)
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    if n >= width:
        full = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            full = mixed(full * STEP + words[j : n - width + 1 + j])
        rolled[: len(full)] = full
    sets = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)  # the length tells short sequences from full shingles
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = mixed(h * STEP + w + np.uint64(1))
            sets.append(np.array([h], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
