"""Quality by importance resampling: hashed n-gram models and Gumbel top-k."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.rolling import mixed, window_hashes
from wakeline.llm.tables import slices, utf8, written
from wakeline.llm.words import segment_hashes, split_words, text_numbers

BUCKETS = 1 << 16
# Labelled documents the target model is counted on at most.
TARGET_ROWS = 20_000
# Added to each bucket's count.
SMOOTHING = 1.0
SEED = 11
_SLICE_BYTES = 2 << 20
_DIGIT = 16


def ngrams(starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each word and each pair of neighbouring words.

    Letters A-Z count as lower case.
    """
    data = data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << np.uint8(5))
    words = split_words(starts, data)
    hashes = segment_hashes(data, words.first, words.end)
    numbers = text_numbers(words.bounds)
    inner = np.flatnonzero(numbers[:-1] == numbers[1:])
    found = np.concatenate([hashes, mixed(window_hashes(hashes, 2))[inner]])
    buckets = (found % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([numbers, numbers[inner]])


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences in each bucket over all texts; counted in the tasks, summed by bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text", _SLICE_BYTES):
            buckets, _ = ngrams(*utf8(batch.column("text")))
            total += np.bincount(buckets, minlength=BUCKETS)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled), pa.array(total[filled])], ["bucket", "count"]
        )

    # At most BUCKETS rows reach the driver.
    found = (
        docs.select("text")
        .mapInArrow(counted, "bucket long, count long")
        .groupBy("bucket")
        .agg(F.sum("count").alias("count"))
        .toArrow()
    )
    counts = np.zeros(BUCKETS, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("count").to_numpy()
    return counts


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm of its probability in the target over that in all text."""
    p, q = target + SMOOTHING, raw + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def target_documents(docs: DataFrame, labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """Documents labelled as of quality and not toxic, the first ``rows`` by a hash of doc_id."""
    chosen = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where("quality > 0 AND coalesce(toxic, 0) = 0")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # The hint is safe: the limit bounds the rows.
    return docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")


def quality_share(labels: DataFrame) -> float:
    """Share of the labelled rows that are of quality; 1 without labels."""
    good, known = labels.agg(
        F.count(F.when(F.col("quality") > 0, 1)), F.count("quality")
    ).first()
    return good / known if known else 1.0


def _weighed(docs: DataFrame, ratio: np.ndarray, seed: int, id_type: str) -> DataFrame:
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            buckets, numbers = ngrams(*utf8(batch.column("text")))
            # Counts of nothing are whole numbers, weights or not.
            weight = np.bincount(numbers, weights=ratio[buckets], minlength=batch.num_rows)
            weight = weight.astype(np.float64)
            uniform = batch.column("uniform").to_numpy()
            key = weight - np.log(-np.log(uniform))
            # Whole numbers in the order of the keys.
            bits = key.view(np.int64)
            order = bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(weight), pa.array(key), pa.array(order)],
                ["doc_id", "log_weight", "gumbel_key", "key_order"],
            )

    random = F.xxhash64("doc_id", F.lit(seed))
    uniform = (F.shiftrightunsigned(random, 11).cast("double") + 0.5) / float(1 << 53)
    return docs.select("doc_id", "text", uniform.alias("uniform")).mapInArrow(
        weighed,
        f"doc_id {id_type}, log_weight double, gumbel_key double, key_order long",
    )


def kth_largest(values: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest whole number of a column, found digit by digit.

    Each round counts the values of one prefix by their next 16 bits, so no task sorts
    or holds them. None where there are fewer than k.
    """
    if k < 1:
        return None
    prefix = F.lit(True)
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        digit = F.shiftright(F.col(column), shift)
        counts = values.where(prefix).groupBy(digit.alias("d")).count().collect()
        for row in sorted(counts, key=lambda r: -r["d"]):
            if k <= row["count"]:
                break
            k -= row["count"]
        else:
            return None
        prefix = digit == row["d"]
    return row["d"]


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    share: float,
    seed: int = SEED,
    id_type: str = "long",
) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected: a sample of ``share`` of the documents.

    The log weight of a document is the log likelihood ratio of its hashed words and
    word pairs between the target documents and all documents. With Gumbel noise from
    its doc_id added, the largest keys are a sample without replacement in proportion
    to the weights. Equal keys stay or go together. Every row gives one row; a missing
    or empty text has the log weight 0. Without target texts all buckets weigh alike
    up to their raw counts. Other columns are not read.
    """
    ratio = log_ratio(ngram_counts(target), ngram_counts(docs))
    weighed = written(_weighed(docs, ratio, seed, id_type), "weights")
    k = int(np.ceil(share * weighed.count()))
    least = kth_largest(weighed, "key_order", k)
    selected = F.lit(False) if least is None else F.col("key_order") >= F.lit(least)
    return weighed.withColumn("selected", selected).drop("key_order")
