"""Exact duplicates: runs of digests merged as a tree, with DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import written

# There are 64 runs at least, as many more as keep a run at some two million rows, and they
# meet in three rounds: of 2 ** 6 runs four at a time, of 2 ** 15 runs 32 at a time.
LEAST_RUN_BITS = 6
ROWS_PER_RUN = 1 << 20
ROUNDS = 3


def normalised(text: Column) -> Column:
    """White space runs of ASCII as one space; a missing text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, and the digest and length of the normalised text."""
    text = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    return text.select(
        "doc_id",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").cast("long").alias("size"),
    )


def run_bits_of(rows: int) -> int:
    """Bits of a run's number, so that a run of this many rows in all is a task's work."""
    return max(LEAST_RUN_BITS, (rows // ROWS_PER_RUN).bit_length())


def _merged(runs: DataFrame, n_runs: int) -> DataFrame:
    """Send each run to its own partition, sort it there and fold neighbours of one digest.

    The minimum of a pair cannot be kept in a hash table, so Spark folds the sorted
    rows as they stream by (tests look at the plan).
    """
    smallest = F.min(F.struct(F.col("keep_id").isNull().alias("missing"), "keep_id"))
    same = F.col("size") == F.col("largest")
    wrong = F.raise_error(F.lit("equal digests of different texts")).cast("long")
    return (
        runs.repartition(n_runs, "run")
        .groupBy("run", "digest")
        .agg(
            smallest.alias("smallest"),
            F.sum("group_size").alias("group_size"),
            F.min("size").alias("size"),
            F.max("size").alias("largest"),
        )
        .select(
            "run",
            "digest",
            F.col("smallest.keep_id").alias("keep_id"),
            "group_size",
            F.when(same, F.col("size")).otherwise(wrong).alias("size"),
        )
    )


def merged_runs(runs: DataFrame, run_bits: int = LEAST_RUN_BITS) -> DataFrame:
    """Groups of equal digests: digest, keep_id, group_size.

    ``runs`` has a run number below 2 ** run_bits, digest, size, keep_id and
    group_size. First each run is sorted and folded. Then in each of the rounds a run
    exchanges with the runs whose numbers differ from its own in the next bits: it takes
    from them the digests that end in its bits, and gives them theirs. What arrives is
    merged in order of digests. After all rounds a run holds every entry of its digests.
    Equal digests fold to the smallest identifier at each level, so a group has at most
    one entry per run however many copies it has, and digests of another length of text
    end the job with an error.
    """
    tail = F.conv(F.right(F.hex("digest"), F.lit(8)), 16, 10).cast("long")
    n_runs = 1 << run_bits
    runs = _merged(runs, n_runs)
    step = -(-run_bits // ROUNDS)
    for low in range(0, run_bits, step):
        mask = ((1 << min(step, run_bits - low)) - 1) << low
        number = F.col("run").bitwiseAND(~mask) + tail.bitwiseAND(F.lit(mask))
        runs = _merged(runs.withColumn("run", number), n_runs)
    return runs


def exact_duplicates(docs: DataFrame, run_bits: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of the documents with equal normalised text the one with the smallest doc_id
    stays. Missing texts count as empty; empty texts are equal to each other.
    Repeated rows (same doc_id, equal text) count in group_size and give one row.
    Rows without doc_id come after all others; a group of only such rows has a
    missing keep_id and keeps one of them. An empty table gives an empty result; other columns are
    not read.
    """
    rows = written(digests(docs), "digests")
    run_bits = run_bits_of(rows.count()) if run_bits is None else run_bits
    members = rows.groupBy("doc_id", "digest", "size").agg(F.count("*").alias("group_size"))
    # The hash of doc_id deals copies to all runs; rows without one go by their text.
    number = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("digest"))), F.lit(1 << run_bits))
    runs = members.withColumn("run", number).withColumnRenamed("doc_id", "keep_id")
    groups = merged_runs(runs, run_bits).where(F.col("group_size") > 1)
    # Groups have no size bound, so they are merged, not broadcast; of a group with
    # many copies adaptive execution splits the documents' side.
    groups = groups.select("digest", "keep_id", "group_size").hint("merge")
    alone = F.col("group_size").isNull()
    return (
        members.withColumnRenamed("group_size", "own")
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", "own").alias("group_size"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    )
