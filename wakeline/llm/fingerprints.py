"""Fingerprints of texts from their improbable features, and how alike two of them are.

Features are windows of bytes. Each gets the rank of its entropy class, the rarest class
of the corpus first. Of each row of consecutive windows the one of lowest rank is
popular once more; windows popular often enough are the text's features. They go into
a chain of Bloom filters, a fixed number to each. Two fingerprints are compared filter by
filter, by the bits they share beyond those that chance would give them.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.rolling import byte_values, mixed, sliding_minimum, window_hashes
from wakeline.llm.tables import slices, utf8
from wakeline.llm.words import covered, segment_hashes

# Bytes of a window, entropy classes from one repeated byte to WIDTH different ones.
WIDTH, CLASSES = 16, 1001
# Windows of a row, and how often a feature must be the lowest. A text with fewer than
# SHORT windows has rows a quarter as long, for more features.
ROW, POPULAR, SHORT = 32, 8, 256
# A text with fewer than FEW bytes also has all windows of NARROW bytes as features.
NARROW, FEW = 5, 128
# Bits of a filter, hashes of a feature, and features of a filter.
BITS, HASHES, FEATURES = 2048, 5, 160
# Standard deviations by which an overlap must pass that of two unrelated filters.
CHANCE = 3.0
_SLICE_BYTES = 1 << 20
# Overlaps of filters computed at a time.
_COMPARED = 1 << 14
# Stretches of documents for each partition, as several may meet in one.
_STRETCHES = 4

_UNIT = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)


def _entropy_steps() -> np.ndarray:
    """What a byte adds to the sum of count * log2(count), by how often it was there."""
    counts = np.arange(1, WIDTH + 1)
    terms = np.concatenate([[0], np.rint(counts * np.log2(counts) * _UNIT)]).astype(np.int64)
    return np.diff(terms)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The entropy class of each window, by its first byte.

    From window to window one byte comes and one goes. What that changes follows from
    how often the byte stands among those before and behind it, in whole numbers, so a
    window has the same class wherever it stands.
    """
    count = len(data) - WIDTH + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    earlier, later = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for distance in range(1, WIDTH):
        same = (data[distance:] == data[:-distance]).view(np.uint8)
        earlier[distance:] += same
        later[:-distance] += same
    steps = _entropy_steps()
    start = sum(int(steps[:c].sum()) for c in np.bincount(data[:WIDTH]).tolist())
    change = steps[earlier[WIDTH:]] - steps[later[: count - 1]]
    total = np.cumsum(np.concatenate([[start], change]))
    most = int(steps.sum())
    return (most - total) * (CLASSES - 1) // most


def _windows(starts: np.ndarray) -> np.ndarray:
    return np.maximum(np.diff(starts) - WIDTH + 1, 0)


def entropy_ranks(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy class, by how many windows of all texts have it.

    The classes are counted in the tasks and summed; only the sums reach the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in slices(batches, "text", _SLICE_BYTES):
            starts, data = utf8(batch.column("text"))
            classes = entropy_classes(data)
            inside = covered(starts[:-1], starts[:-1] + _windows(starts), len(classes))
            total += np.bincount(classes[inside], minlength=CLASSES)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(total[held])], ["class", "windows"]
        )

    sums = (
        docs.select("text")
        .mapInArrow(counted, "class long, windows long")
        .groupBy("class")
        .agg(F.sum("windows").alias("windows"))
    )
    windows = np.zeros(CLASSES, np.int64)
    for row in sums.collect():
        windows[row["class"]] = row["windows"]
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.argsort(windows, kind="stable")] = np.arange(CLASSES)
    return ranks


def _popularity(keys: np.ndarray, first: np.ndarray, windows: np.ndarray, row: int) -> np.ndarray:
    """How many rows of a text each window is the lowest of; one row at least in each text."""
    padded = np.concatenate([keys, np.full(row, ~np.uint64(0))])
    lowest = (sliding_minimum(padded, row)[: len(keys)] & _LOW).astype(np.int64)
    rows = np.where(windows > 0, np.maximum(windows - row, 0) + 1, 0)
    return np.bincount(lowest[covered(first, first + rows, len(keys))], minlength=len(keys))


def selected_features(
    starts: np.ndarray, data: np.ndarray, ranks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the features of texts that lie one behind the other.

    Each feature counts once in a text. Ties of rank go by hash and then by place. Where
    no window of a text is popular enough, those popular most are its features. Short
    texts add all narrow windows, and a text shorter than those is one feature.
    """
    first, sizes, windows = starts[:-1], np.diff(starts), _windows(starts)
    whole = np.flatnonzero((sizes > 0) & (sizes < NARROW))
    texts, features = [whole], [segment_hashes(data, first[whole], starts[1:][whole])]
    few = np.flatnonzero((sizes >= NARROW) & (sizes < FEW))
    if len(few):
        hashes = mixed(window_hashes(byte_values(1)[data], NARROW))
        ends = starts[1:][few] - NARROW + 1
        place = np.flatnonzero(covered(first[few], ends, len(hashes)))
        texts.append(np.searchsorted(starts, place, "right") - 1)
        features.append(hashes[place])
    classes = entropy_classes(data)
    if windows.any():
        hashes = mixed(window_hashes(byte_values()[data], WIDTH))
        # 10 bits of rank, 22 of hash, 32 of place; windows across two texts come last.
        keys = ranks[classes].astype(np.uint64) << np.uint64(54)
        keys |= hashes >> np.uint64(42) << np.uint64(32)
        keys |= np.arange(len(keys), dtype=np.uint64)
        keys[~covered(first, first + windows, len(keys))] |= ~_LOW
        short = windows < SHORT
        popularity = np.zeros(len(keys), np.int64)
        needed = np.zeros(len(windows), np.int64)
        for chosen, part in ((short, 4), (~short, 1)):
            chosen = np.flatnonzero(chosen & (windows > 0))
            popularity += _popularity(keys, first[chosen], windows[chosen], ROW // part)
            needed[chosen] = POPULAR // part
        held = np.flatnonzero(windows)
        most = np.maximum.reduceat(popularity, first[held])
        needed[held] = np.minimum(needed[held], most)
        place = np.flatnonzero(popularity)
        text = np.searchsorted(starts, place, "right") - 1
        taken = popularity[place] >= needed[text]
        texts.append(text[taken])
        features.append(hashes[place[taken]])
    text, feature = np.concatenate(texts), np.concatenate(features)
    return _in_order_once(text, feature)


def _in_order_once(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features by text in their order, each at its first place in the text only."""
    order = np.lexsort((feature, text))
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (feature[order][1:] != feature[order][:-1])
    first = np.sort(order[new])
    first = first[np.argsort(text[first], kind="stable")]
    return text[first], feature[first]


def filter_chains(text: np.ndarray, feature: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The filters of ``count`` texts, a row of 64-bit words each, and their bounds by text."""
    bounds = np.searchsorted(text, np.arange(count + 1))
    ends = np.concatenate([[0], np.cumsum(-(-np.diff(bounds) // FEATURES))])
    number = ends[text] + (np.arange(len(text)) - bounds[text]) // FEATURES
    bits = np.zeros((int(ends[-1]), BITS), bool)
    for i in range(HASHES):
        bits[number, (feature >> np.uint64(11 * i)) % np.uint64(BITS)] = True
    return np.packbits(bits, axis=1).view(np.uint64), ends


def likeness(
    filters: np.ndarray, bounds: np.ndarray, one: np.ndarray, other: np.ndarray
) -> np.ndarray:
    """How alike the chains ``one`` and ``other`` are, pair by pair, from 0 to 1.

    Each filter of the chain with fewer bits counts with its bits and by the filter of the
    other that shares most with it: 0 where they share no more than unrelated filters do,
    1 where one holds all bits of the other. Chains without a filter are alike.
    """
    size = np.diff(bounds)
    set_bits = np.bitwise_count(filters).sum(axis=1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(set_bits)])[bounds]
    weight = np.diff(total)
    swap = weight[one] > weight[other]
    one, other = np.where(swap, other, one), np.where(swap, one, other)
    pair = np.repeat(np.arange(len(one)), size[one])
    inside = np.arange(len(pair)) - np.repeat(np.cumsum(size[one]) - size[one], size[one])
    mine = bounds[one][pair] + inside
    best = np.zeros(len(pair))
    partners = size[other][pair]
    behind = np.concatenate([[0], np.cumsum(partners)])
    done = 0
    while done < len(pair):
        stop = max(int(np.searchsorted(behind, behind[done] + _COMPARED, "right")) - 1, done + 1)
        row = np.repeat(np.arange(done, stop), partners[done:stop])
        theirs = bounds[other][pair[row]] + np.arange(len(row)) - (behind[row] - behind[done])
        np.maximum.at(best, row, _overlap(filters, set_bits, mine[row], theirs))
        done = stop
    sums = np.bincount(pair, weights=best * set_bits[mine], minlength=len(one))
    alike = np.where(size[other] == 0, 1.0, 0.0)
    return np.divide(sums, weight[one], out=alike, where=weight[one] > 0)


def _overlap(filters, set_bits, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    shared = np.bitwise_count(filters[a] & filters[b]).sum(axis=1, dtype=np.int64)
    x, y = set_bits[a], set_bits[b]
    expected = x * y / BITS
    spread = np.sqrt(expected * (BITS - x) * (BITS - y) / (BITS * (BITS - 1)))
    most, floor = np.minimum(x, y), expected + CHANCE * spread
    above = np.maximum(shared - floor, 0.0)
    # Filters of few bits lie within chance unless all are shared.
    certain = (shared == most).astype(float)
    return np.divide(above, most - floor, out=certain, where=most > floor)


def _strings(filters: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The chains as text: the number of filters and their bytes in base 64."""
    rows = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return [f"{b - a}:{base64.b64encode(filters[a:b].tobytes()).decode()}" for a, b in rows]


def _heads(docs: DataFrame, stretches: int) -> np.ndarray:
    """The smallest doc_id of each stretch of documents in their order."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id")
    heads = (
        ids.repartitionByRange(stretches, "doc_id")
        .groupBy(F.spark_partition_id())
        .agg(F.min("doc_id").alias("head"))
    )
    return np.sort(np.array([row["head"] for row in heads.collect()], np.int64))


def _dealt(heads: np.ndarray, spread: int):
    """Rows with the number of their stretch; the head also follows the stretch before it.

    Rows without doc_id have no place in the order and go to stretches of their own.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, _ = utf8(batch.column("text"))
            missing = np.asarray(batch.column("doc_id").is_null())
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            stretch = np.searchsorted(heads, ids, "right") - 1
            lengths = mixed(np.diff(starts).astype(np.uint64)) % np.uint64(spread)
            stretch[missing] = -1 - lengths[missing].astype(np.int64)
            is_head = np.flatnonzero(np.isin(ids, heads) & ~missing)
            before = (stretch[is_head] - 1) % max(len(heads), 1)
            rows = np.concatenate([np.arange(len(ids)), is_head])
            again = np.arange(len(rows)) >= len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([stretch, before])),
                    pa.array(again),
                    batch.column("doc_id").take(pa.array(rows)),
                    batch.column("text").take(pa.array(rows)),
                ],
                ["stretch", "again", "doc_id", "text"],
            )

    return deal


def _compared(ranks: np.ndarray):
    """Rows in order of stretch: each with the next one, which decides its edited text."""

    def results(doc_ids: list, texts: list[str], again: list[bool]) -> pa.RecordBatch:
        # All rows but the last, which is there as the next of the one before it.
        rows = [i for i in range(len(texts) - 1) if not again[i]]
        placed = [doc_ids[i] is not None for i in rows]
        edited = []
        for i, has_next in zip(rows, placed, strict=True):
            cut = len(texts[i]) // 4
            edited.append(texts[i][: len(texts[i]) - cut] + (texts[i + 1][:cut] if has_next else ""))
        starts, data = utf8(pa.array(texts + edited, pa.large_string()))
        text, feature = selected_features(starts, data, ranks)
        filters, bounds = filter_chains(text, feature, len(starts) - 1)
        at = np.array(rows, np.int64)
        to_edited = likeness(filters, bounds, at, len(texts) + np.arange(len(at)))
        to_next = likeness(filters, bounds, at, at + 1)
        strings = _strings(filters, bounds)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([doc_ids[i] for i in rows], pa.int64()),
                pa.array([len(texts[i]) for i in rows], pa.int64()),
                pa.array([strings[i] for i in rows], pa.string()),
                pa.array(edited, pa.string()),
                pa.array(strings[len(texts) :], pa.string()),
                pa.array(to_edited),
                pa.array(to_next, mask=~np.array(placed, bool)),
            ],
            ["doc_id", "n_chars", "fingerprint", "edited", "edited_fingerprint",
             "near_edited", "near_next"],
        )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, texts, again = [], [], []
        for batch in slices(batches, "text", _SLICE_BYTES):
            doc_ids += batch.column("doc_id").to_pylist()
            texts += [text or "" for text in batch.column("text").to_pylist()]
            again += batch.column("again").to_pylist()
            if len(texts) > 1:
                yield results(doc_ids, texts, again)
            doc_ids, texts, again = doc_ids[-1:], texts[-1:], again[-1:]
        if texts and not again[0]:
            # Only a row without doc_id has nothing behind it.
            yield results([*doc_ids, None], [*texts, ""], [*again, True])

    return compared


def fingerprints(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """doc_id, n_chars, fingerprint, edited, edited_fingerprint, near_edited, near_next.

    ``edited`` is the text with its last quarter replaced by as many code points from the
    start of the next document, or by all of it, in order of doc_id and, where rows share
    one, of text; after the last row comes the first. ``near_edited`` and ``near_next``
    tell how alike the text's fingerprint is to that of the edited text and of the next
    document. Missing and empty texts have no features, and are alike. A row without
    doc_id has no next document: its edited text loses the last quarter and ``near_next``
    is null. Repeated rows each give one row; other columns are not read. ``doc_id`` is a
    long. ``ranks`` comes from ``entropy_ranks``; fingerprints compare under equal ranks.

    Documents move once, to stretches of their order; the first of each also goes to the
    stretch before it. The driver sees one doc_id for each stretch.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = _heads(docs, _STRETCHES * partitions)
    dealt = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _dealt(heads, _STRETCHES * partitions),
        "stretch long, again boolean, doc_id long, text string",
    )
    return (
        dealt.repartition(partitions, "stretch")
        .sortWithinPartitions("stretch", "again", "doc_id", "text")
        .mapInArrow(
            _compared(ranks),
            "doc_id long, n_chars long, fingerprint string, edited string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )
