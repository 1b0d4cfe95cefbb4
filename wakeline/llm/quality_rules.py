"""Quality rules: base counts, and a calibrated n-gram classifier in Arrow batches."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.rolling import byte_values, mixed, window_hashes
from wakeline.llm.tables import slices, utf8
from wakeline.llm.words import Words, per_text, segment_hashes, split_words, text_numbers

# Fixed values of the base rules.
LEAST_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

# Labelled rows the classifier is fitted on at most, and the part held out for calibration.
TRAINING_ROWS = 3000
HELD_OUT = 0.25
# A document stays when its calibrated probability of quality is at least this.
THRESHOLD = 0.3
CHAR_WIDTH = 4
BUCKET_BITS = 16
_ROUNDS = 80
_SLICE_BYTES = 2 << 20

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass
class Classifier:
    """Weights of hashed n-grams, and the line that calibrates the score."""

    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.offset, -30, 30)))


def _repeated(values: np.ndarray) -> np.ndarray:
    """Marks values that occur twice or more."""
    order = np.argsort(values, kind="stable")
    same = np.concatenate([[False], values[order][1:] == values[order][:-1], [False]])
    marks = np.empty(len(values), bool)
    marks[order] = same[1:] | same[:-1]
    return marks


def base_counts(starts: np.ndarray, data: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    hashes = segment_hashes(data, words.first, words.end)
    numbers = text_numbers(words.bounds)
    n_words = np.diff(words.bounds)

    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    space = np.ones(len(data) + 1, np.int64)
    np.add.at(space, words.first, -1)
    np.add.at(space, words.end, 1)
    in_word = np.cumsum(space - 1)[:-1] < 0

    # Windows of words within one text that occur twice or more there.
    windows = window_hashes(hashes, REPEAT_WINDOW)
    whole = numbers[: len(windows)] == numbers[REPEAT_WINDOW - 1 :][: len(windows)]
    at = np.flatnonzero(whole)
    key = mixed(windows[at] ^ mixed(numbers[at].astype(np.uint64) + np.uint64(1)))
    at = at[_repeated(key)]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + REPEAT_WINDOW, -1)

    # Lines with a word; equal to an earlier one is all but the first.
    ends = np.union1d(np.flatnonzero(data == 0x0A), starts[1:][np.diff(starts) > 0])
    line = np.searchsorted(ends, words.first, "right")
    line_text = np.stack([line, numbers])
    kept = np.flatnonzero(np.concatenate([[True], np.diff(line) > 0])) if len(line) else line
    line, owner = line_text[0][kept], line_text[1][kept]
    first = np.maximum(
        np.where(line > 0, ends[np.maximum(line - 1, 0)] if len(ends) else 0, 0),
        starts[owner],
    )
    newline = data[np.minimum(first, max(len(data) - 1, 0))] == 0x0A if len(first) else first
    first = first + (newline & (first < words.first[kept])) if len(first) else first
    lines = segment_hashes(data, first, ends[line]) if len(line) else np.zeros(0, np.uint64)
    key = mixed(lines ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    _, distinct = np.unique(key, return_index=True)
    again = np.ones(len(key), np.int64)
    again[distinct] = 0

    return {
        "n_words": n_words,
        "word_chars": per_text(in_word & ((data & 0xC0) != 0x80), starts),
        "n_symbols": per_text(table[data], starts),
        "n_dup_lines": np.bincount(owner, weights=again, minlength=len(n_words)).astype(
            np.int64
        ),
        "n_repeat_words": per_text(np.cumsum(cover)[:-1] > 0, words.bounds),
    }


def ngram_buckets(
    starts: np.ndarray, data: np.ndarray, words: Words
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of every word, pair of words and character n-gram."""
    numbers = text_numbers(words.bounds)
    hashes = segment_hashes(data, words.first, words.end)
    pairs = window_hashes(hashes, 2)
    inner = np.flatnonzero(numbers[:-1] == numbers[1:])
    chars = window_hashes(byte_values()[data], CHAR_WIDTH)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = np.flatnonzero(text[: len(chars)] == text[CHAR_WIDTH - 1 :][: len(chars)])
    found = [(hashes, numbers), (pairs[inner], numbers[inner]), (chars[whole], text[whole])]
    shift = np.uint64(64 - BUCKET_BITS)
    return [
        ((mixed(h) >> shift).astype(np.int64) + kind * (1 << BUCKET_BITS), n)
        for kind, (h, n) in enumerate(found)
    ]


def scores(classifier: Classifier, starts: np.ndarray, data: np.ndarray, words: Words):
    """Sum over the kinds of n-gram of their mean weight in each text."""
    total = np.zeros(len(starts) - 1)
    for buckets, numbers in ngram_buckets(starts, data, words):
        count = np.bincount(numbers, minlength=len(total))
        total += np.bincount(
            numbers, weights=classifier.weights[buckets], minlength=len(total)
        ) / np.maximum(count, 1)
    return total


def _frequencies(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and mean count, for every bucket that occurs in a text."""
    rows, columns, values = [], [], []
    batch, done = pa.RecordBatch.from_arrays([texts], ["text"]), 0
    for part in slices([batch], "text", _SLICE_BYTES):
        starts, data = utf8(part.column("text"))
        words = split_words(starts, data)
        for buckets, numbers in ngram_buckets(starts, data, words):
            key, count = np.unique(numbers << 20 | buckets, return_counts=True)
            total = np.bincount(numbers, minlength=part.num_rows)
            rows.append((done + (key >> 20)).astype(np.int32))
            columns.append((key & ((1 << 20) - 1)).astype(np.int32))
            values.append((count / total[key >> 20]).astype(np.float32))
        done += part.num_rows
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def fit(texts: pa.Array, quality: np.ndarray) -> Classifier | None:
    """Logistic regression over mean n-gram weights, calibrated on rows held out.

    None where the rows are of one class only.
    """
    held = np.arange(len(quality)) % round(1 / HELD_OUT) == 0
    if not len(quality) or len(np.unique(quality[~held])) < 2:
        return None
    row, column, value = _frequencies(texts)
    in_fit = ~held[row]
    size = 3 << BUCKET_BITS
    weights, momentum, spread = np.zeros(size), np.zeros(size), np.zeros(size)
    share = max(min(quality[~held].mean(), 0.99), 0.01)
    # Both classes weigh the same while fitting; calibration restores their shares.
    importance = np.where(quality == 1, 0.5 / share, 0.5 / (1 - share)) / (~held).sum()
    r, c, v = row[in_fit], column[in_fit], value[in_fit]
    for step in range(1, _ROUNDS + 1):
        score = np.bincount(r, weights=weights[c] * v, minlength=len(quality))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - quality) * importance
        slope = np.bincount(c, weights=error[r] * v, minlength=size) + 1e-8 * weights
        momentum = 0.9 * momentum + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        rate = 0.5 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * momentum / (np.sqrt(spread) + 1e-8)
    score = np.bincount(row, weights=weights[column] * value, minlength=len(quality))
    slope, offset = calibration(score[held], quality[held])
    return Classifier(weights.astype(np.float32), slope, offset)


def calibration(score: np.ndarray, quality: np.ndarray) -> tuple[float, float]:
    """The logistic line from scores to probabilities, by damped Newton steps.

    Targets are drawn in from 0 and 1, so a clean separation has a finite line.
    """
    good, bad = (quality == 1).sum(), (quality != 1).sum()
    target = np.where(quality == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    line = np.array([1.0, 0.0])
    points = np.stack([score, np.ones(len(score))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(line @ points, -30, 30)))
        slope = points @ (p - target)
        curve = (points * (p * (1 - p))) @ points.T + 1e-3 * np.eye(2)
        line = line - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return float(line[0]), float(line[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Classifier | None:
    """Fit on at most ``rows`` labelled documents, the first by a hash of their doc_id."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # The hint is safe: the limit bounds the rows.
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", "quality")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("text", "ascending")])
    )
    quality = (found.column("quality").to_numpy() > 0).astype(int)
    return fit(found.column("text").combine_chunks(), quality)


def quality_rules(
    docs: DataFrame,
    classifier: Classifier | None,
    threshold: float = THRESHOLD,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns of ``carry``, the base counts, base_failed, the probability of quality, and kept.

    Every row gives one row, repeated or without doc_id too. A missing text is empty:
    it has no words and fails the base rules. Without a classifier (no labels, or one
    class only) the probability is missing and the base rules decide. Other columns
    are not read.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            starts, data = utf8(batch.column("text"))
            words = split_words(starts, data)
            counts = base_counts(starts, data, words)
            probability = pa.nulls(batch.num_rows, pa.float64())
            if classifier is not None:
                probability = pa.array(
                    classifier.probability(scores(classifier, starts, data, words))
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carry),
                    *(pa.array(counts[c]) for c in _COUNTS),
                    probability,
                ],
                [*carry, *_COUNTS, "probability"],
            )

    chosen = docs.select(*carry, *({"text"} - set(carry)))
    schema = T.StructType(
        [
            *docs.select(*carry).schema.fields,
            *(T.StructField(c, T.LongType()) for c in _COUNTS),
            T.StructField("probability", T.DoubleType()),
        ]
    )
    repeats = 100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    good = F.coalesce(F.col("probability") >= threshold, F.lit(True))
    return (
        chosen.mapInArrow(judged, schema)
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeats)
        .withColumn("kept", ~F.col("base_failed") & good)
    )
