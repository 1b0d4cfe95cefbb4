"""Words of many texts at once: places, hashes, and counts by text."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from wakeline.llm.rolling import byte_values, mixed

_POWER = np.uint64(0xD6E8FEB86659FD93)
# Segments over so many bytes are hashed apart: different words of 1,024 letters can have
# one polynomial modulo 2**64, whatever its base.
_LONG = 256


@dataclass
class Words:
    """Words are runs of bytes other than the six white space characters of ASCII.

    ``first`` and ``end`` are byte places, ``bounds`` the number of words before
    each text.
    """

    first: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def space_mask(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def split_words(starts: np.ndarray, data: np.ndarray) -> Words:
    """The words of texts that lie one behind the other; ``starts`` has one more entry."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(starts), np.int64))
    inside = ~space_mask(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    before = np.concatenate([[False], inside[:-1]]) & ~cut[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~cut[1:]
    first = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(first, end, np.searchsorted(first, starts))


def segment_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each segment; segments are in order, apart and not empty."""
    if not len(first):
        return np.zeros(0, np.uint64)
    lengths = end - first
    hashes = np.empty(len(first), np.uint64)
    short = lengths <= _LONG
    hashes[short] = _short_hashes(data, first[short], lengths[short])
    for place in np.flatnonzero(~short).tolist():
        hashes[place] = xxhash.xxh3_64_intdigest(data[first[place] : end[place]].tobytes())
    return hashes


def _short_hashes(data: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(first):
        return np.zeros(0, np.uint64)
    head = np.cumsum(lengths) - lengths
    offset = np.arange(lengths.sum()) - np.repeat(head, lengths)
    places = np.repeat(first, lengths) + offset
    powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_LONG - 1, _POWER, np.uint64))])
    sums = np.add.reduceat(byte_values(1)[data[places]] * powers[offset], head)
    return mixed(sums + lengths.astype(np.uint64))


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each two bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_numbers(bounds: np.ndarray) -> np.ndarray:
    """The number of the text for each of its words."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def covered(first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a stretch, as far as it reaches into them.

    The stretches are apart; they may touch or be empty.
    """
    first, end = np.minimum(first, size), np.minimum(end, size)
    held = end > first
    change = np.zeros(size + 1, np.int8)
    change[first[held]] = 1
    change[end[held]] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).view(bool)


def distinct_words(words: Words, data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words only, and the word of each number."""
    letters = data[covered(words.first, words.end, len(data))]
    ends = np.concatenate([[0], np.cumsum(words.end - words.first)])
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(letters)]
    )
    found = column.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary
