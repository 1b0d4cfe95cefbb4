"""Periodic runs of words in each text, by an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends
with that period. Its last square, of which nothing can be rotated further right,
starts at a place i whose suffix shares exactly q words with the suffix at i + q: the
two lie in different children of one LCP interval of depth q. So the suffixes of the
smaller children look for their partners at i + depth and i - depth in the inverse
suffix array, and a partner inside the interval is a branching tandem repeat. Squares
are rotated left as far as they go and give the runs; multiples of a period give the
same stretch and merge into it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.tables import slices, utf8
from wakeline.llm.words import Words, covered, distinct_words, split_words, text_numbers

MIN_LENGTH, MIN_EXPONENT = 24, 3
_SLICE_BYTES = 4 << 20
# Suffixes of smaller children that are tested at a time.
_TESTED = 1 << 21


def suffix_order(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order of text and words, and ranks by their first 1, 2, 4, ... words.

    Two places have the same rank on level j when 2**j words from there are the same
    and end within the text. A rank is the first slot of its group in the order, so the
    last level is the inverse of the order. Only groups that are still tied are sorted.
    """
    text = text_numbers(bounds)
    ends = bounds[1:][text]
    key = (text << 32) | codes
    order = np.argsort(key, kind="stable")
    slots, places, key = np.arange(len(codes)), order, key[order]
    rank, levels, size = np.zeros(len(codes), np.int64), [], 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        rank[places] = np.maximum.accumulate(np.where(new, slots, 0))
        levels.append(rank.astype(np.int32))
        tied = ~new
        tied[:-1] |= ~new[1:]
        if not tied.any():
            return order, levels
        slots, places = slots[tied], places[tied]
        ahead = places + size
        follower = rank[np.minimum(ahead, len(rank) - 1)] + 1
        key = (rank[places] << 32) | np.where(ahead < ends[places], follower, 0)
        sort = np.argsort(key, kind="stable")
        places, key = places[sort], key[sort]
        order[slots] = places
        size *= 2


def shared_words(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at two different places of a text have in common."""
    size, last = np.zeros(len(a), np.int64), len(levels[0]) - 1
    for level in range(len(levels) - 1, -1, -1):
        x, y, rank = a + size, b + size, levels[level]
        same = (np.maximum(x, y) <= last) & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])
        size[same] += 1 << level
    return size


def previous_lower(values: np.ndarray, places: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each of the places the last one before it with a lower value; -1 without one.

    A tree of minima is climbed from all places at once until a subtree on the left has
    such a value, and then descended on the right where possible.
    """
    lower = np.less_equal if or_equal else np.less
    most = np.iinfo(values.dtype).max
    tree = [values]
    while len(tree[-1]) > 1:
        row = tree[-1]
        if len(row) % 2:
            row = tree[-1] = np.append(row, most)
        tree.append(np.minimum(row[::2], row[1::2]))
    found = np.full(len(places), -1)
    waiting = np.arange(len(places))
    for height in range(len(tree) - 1):
        at = places[waiting] >> height
        left = np.maximum(at - 1, 0)
        hit = (at % 2 == 1) & lower(tree[height][left], values[places[waiting]])
        who, node = waiting[hit], left[hit]
        for below in range(height - 1, -1, -1):
            right = 2 * node + 1
            node = np.where(lower(tree[below][right], values[places[who]]), right, right - 1)
        found[who] = node
        waiting = waiting[~hit]
    return found


def _smaller_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """LCP intervals cut in two at each slot of their depth: depth, small side, other side.

    At a slot the child before it meets all children behind it, so each two children of
    an interval meet once. Sides are slots, the first and the one behind the last.
    """
    cut = np.flatnonzero(lcp > 0)
    first = previous_lower(lcp, cut, or_equal=True)
    behind = len(lcp) - 1 - previous_lower(lcp[::-1].copy(), len(lcp) - 1 - cut, or_equal=False)
    before = cut - first <= behind - cut
    small = np.where(before, first, cut), np.where(before, cut, behind)
    other = np.where(before, cut, first), np.where(before, behind, cut)
    return lcp[cut], *small, *other


def tandem_repeats(order: np.ndarray, levels: list[np.ndarray], lcp: np.ndarray):
    """Start and period of each branching tandem repeat."""
    depth, low, high, other_low, other_high = _smaller_children(lcp)
    inverse, count = levels[-1], len(order)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    total = np.concatenate([[0], np.cumsum(high - low)])
    done = 0
    while done < len(depth):
        stop = max(int(np.searchsorted(total, total[done] + _TESTED, "right")) - 1, done + 1)
        node = np.repeat(np.arange(done, stop), (high - low)[done:stop])
        slot = low[node] + np.arange(len(node)) - (total[node] - total[done])
        place, period = order[slot], depth[node]
        for partner in (place + period, place - period):
            inside = (partner >= 0) & (partner < count)
            at = inverse[np.where(inside, partner, 0)]
            hit = inside & (at >= other_low[node]) & (at < other_high[node])
            starts.append(np.minimum(place, partner)[hit])
            periods.append(period[hit])
        done = stop
    return np.concatenate(starts), np.concatenate(periods)


def _shortest_repeat(min_length: int, min_exponent: int) -> int:
    """Words that the two suffixes a period apart at the start of a run share at least."""
    periods = range(1, min_length + 1)
    return min(max(min_length - q, (min_exponent - 1) * q) for q in periods)


def find_runs(
    codes: np.ndarray,
    bounds: np.ndarray,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of the runs of texts that lie one behind the other.

    In order of start and period; places count over all texts. ``min_exponent`` is two
    at least: shorter stretches hold no square.
    """
    none = np.zeros(0, np.int64)
    if not len(codes):
        return none, none, none
    order, levels = suffix_order(codes, bounds)
    # Texts in which no stretch of the needed length comes twice have no run.
    needed = max(_shortest_repeat(min_length, min_exponent), 1).bit_length() - 1
    if len(levels) <= needed:
        return none, none, none
    text = text_numbers(bounds)
    tied = levels[needed][order[1:]] == levels[needed][order[:-1]]
    repeating = np.zeros(len(bounds) - 1, bool)
    repeating[text[1:][tied]] = True
    # A text has the same slots as places, so one mask takes out both.
    kept = repeating[text]
    place_of, number = np.flatnonzero(kept), np.cumsum(kept) - 1
    order = number[order[kept]]
    levels = [number[level[kept]].astype(np.int32) for level in levels]
    text = text[kept]
    lcp = np.full(len(order), -1)
    inner = np.flatnonzero(text[1:] == text[:-1]) + 1
    lcp[inner] = shared_words(levels, order[inner - 1], order[inner])

    start, period = tandem_repeats(order, levels, lcp)
    end = start + 2 * period
    for level in range(len(levels) - 1, -1, -1):
        rank, earlier = levels[level], start - (1 << level)
        at = np.maximum(earlier, 0)
        same = (earlier >= 0) & (rank[at] == rank[np.maximum(earlier + period, 0)])
        start = np.where(same, earlier, start)
    long = end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[long], end[long], period[long]
    sort = np.lexsort((period, end, start))
    start, end, period = start[sort], end[sort], period[sort]
    multiple = np.zeros(len(start), bool)
    multiple[1:] = (start[1:] == start[:-1]) & (end[1:] == end[:-1])
    start, end, period = start[~multiple], end[~multiple], period[~multiple]
    sort = np.lexsort((period, start))
    start, end, period = start[sort], end[sort], period[sort]
    return place_of[start], place_of[end - 1] + 1, period


def _repeating(first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a stretch; stretches may overlap."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def _joined(words: Words, dropped: np.ndarray, data: np.ndarray, starts: np.ndarray):
    """Byte bounds and bytes of the words that stay, joined by one space in each text."""
    first, end = words.first[~dropped], words.end[~dropped]
    kept = covered(first, end, len(data))
    text = text_numbers(words.bounds)[~dropped]
    # The byte behind a word that another one follows is white space of its text.
    space = end[:-1][text[1:] == text[:-1]]
    data = data.copy()
    data[space] = 0x20
    kept[space] = True
    return np.concatenate([[0], np.cumsum(kept)])[starts], data[kept]


def _strings(bounds: np.ndarray, data: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    return pa.StringArray.from_buffers(len(bounds) - 1, buffers[1], buffers[2])


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    id_type: str = "long",
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and the text without repeated periods.

    Words are runs of characters other than the white space of ASCII, numbered from 0.
    Runs have ``min_length`` words and ``min_exponent`` periods at least and are in order
    of start and period. ``collapsed`` has the words that no run holds behind its first
    period, joined by one space. Missing, empty and blank texts have no words, no runs
    and an empty text. Every row gives one row, repeated or without doc_id too; other
    columns are not read. Texts are worked on whole, each in one task.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            starts, data = utf8(batch.column("text"))
            words = split_words(starts, data)
            codes, _ = distinct_words(words, data)
            start, end, period = find_runs(codes, words.bounds, min_length, min_exponent)
            dropped = _repeating(start + period, end, len(codes))
            text = np.searchsorted(words.bounds, start, "right") - 1
            run = pa.StructArray.from_arrays(
                [pa.array(start - words.bounds[text]), pa.array(end - start), pa.array(period)],
                ["start", "length", "period"],
            )
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            bounds, left = _joined(words, dropped, data, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(words.bounds)),
                    pa.ListArray.from_arrays(pa.array(ends), run),
                    _strings(bounds, left),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = (
        f"doc_id {id_type}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return docs.select("doc_id", "text").mapInArrow(found, schema)
