"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact check."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.components import components
from wakeline.llm.rolling import mixed, window_hashes
from wakeline.llm.tables import slices, utf8, written
from wakeline.llm.words import segment_hashes, split_words

WIDTH = 5
PERCENT = 80
# At a similarity of 0.8 (0.85) a pair shares no band with probability 7e-6 (2e-8).
BANDS = 30
BAND_ROWS = 5
# Hashes compared at a time, and the probability at which pruning may miss a link.
BATCH = 30
MISS = 1e-6
# Documents of a cluster in one block, and of one that is not taken by its buckets.
BLOCK = 512
CLUSTER = 2048
_SLICE_BYTES = 2 << 20
_SHINGLES_AT_ONCE = 1 << 13

_HASHES = BANDS * BAND_ROWS
_MULTIPLIERS = (
    mixed(np.arange(1, _HASHES + 1, dtype=np.uint64)) >> np.uint64(32)
).astype(np.uint32) | np.uint32(1)


def shingle_sets(starts: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted.

    Letters A-Z count as lower case. A text with fewer words than a shingle has its
    whole sequence as the only one, a text without words none.
    """
    data = data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << np.uint8(5))
    words = split_words(starts, data)
    hashes = segment_hashes(data, words.first, words.end)
    windows = mixed(window_hashes(hashes, WIDTH))
    sets = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            sets.append(np.unique(windows[a : b - WIDTH + 1]))
        elif b > a:
            whole = window_hashes(hashes[a:b], b - a)
            sets.append(mixed(whole + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each of the hash functions."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(_HASHES, np.iinfo(np.uint32).max, np.uint32)
    for first in range(0, len(values), _SHINGLES_AT_ONCE):
        part = values[first : first + _SHINGLES_AT_ONCE]
        low = np.minimum(low, np.multiply.outer(_MULTIPLIERS, part).min(axis=1))
    return low


def signatures(docs: DataFrame, id_type: str = "long") -> DataFrame:
    """doc_id, n_shingles, two digests of the set, band keys, and a byte per hash."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_numbers = mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
        for batch in slices(batches, "text", _SLICE_BYTES):
            sets = shingle_sets(*utf8(batch.column("text")))
            low = np.stack([minhashes(s) for s in sets]).astype(np.uint64)
            keys = band_numbers[None, :].repeat(len(sets), 0)
            for row in range(BAND_ROWS):
                keys = mixed(keys ^ low[:, row::BAND_ROWS])
            sums = [
                [np.add.reduce(mixed(s ^ salt)) for s in sets]
                for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D))
            ]
            ends = np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32)
            codes = (mixed(low) & np.uint64(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in sums),
                    pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(keys.ravel().view(np.int64))
                    ),
                    pa.array([code.tobytes() for code in codes], pa.binary()),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "code"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        signed,
        f"doc_id {id_type}, n_shingles long, d1 long, d2 long, bands array<long>, code binary",
    )


@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float = MISS) -> tuple[int, ...]:
    """Matches a pair needs after each batch to be compared further.

    With a uniform prior on the similarity s, and hashes that match with probability
    s + (1 - s) / 256, fewer matches mean that the similarity reaches the threshold
    with posterior probability below ``miss``.
    """
    s = (np.arange(20000) + 0.5) / 20000
    p = s + (1 - s) / 256
    found = []
    for n in range(BATCH, _HASHES + 1, BATCH):
        for m in range(n + 1):
            weight = m * np.log(p) + (n - m) * np.log1p(-p)
            weight = np.exp(weight - weight.max())
            if weight[s >= percent / 100].sum() >= miss * weight.sum():
                break
        found.append(m)
    return tuple(found)


def likely(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of code rows that no batch prunes."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for step, least in enumerate(least_matches(percent)):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _codes(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), _HASHES)


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pruned(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and signature batches leave."""
    sides = [
        signed.select(
            F.col("doc_id").alias(x),
            F.col("n_shingles").alias(f"n_{x}"),
            F.col("code").alias(f"code_{x}"),
        ).hint("merge")
        for x in ("a", "b")
    ]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _codes(batch.column("code_a")), _codes(batch.column("code_b"))
            yield batch.select(["a", "b"]).take(pa.array(likely(left, right, percent)))

    return (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .where(_near_sizes(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b", "code_a", "code_b")
        .mapInArrow(compared, pairs.select("a", "b").schema)
    )


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", _SLICE_BYTES):
            left = shingle_sets(*utf8(batch.column("text_a")))
            right = shingle_sets(*utf8(batch.column("text_b")))
            keep = []
            for row, (x, y) in enumerate(zip(left, right, strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(row)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    sides = [
        texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")).hint("merge")
        for x in ("a", "b")
    ]
    return (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(exact, pairs.select("a", "b").schema)
    )


def _central_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central one.

    Central is who shares most buckets with most others: edits move a copy out of
    some buckets, the text they all stem from is in nearly all.
    """
    weight = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    centre = (
        members.join(weight.hint("merge"), "doc_id")
        .groupBy("key")
        .agg(F.max(F.struct("weight", -F.col("doc_id"))).alias("most"))
        .select("key", (-F.col("most.col2")).alias("b"))
        .hint("merge")
    )
    return (
        members.select("key", F.col("doc_id").alias("a"))
        .join(centre, "key")
        .where("a <> b")
        .select("a", "b")
        .distinct()
    )


def _cross_links(
    members: DataFrame, met: DataFrame, labels: DataFrame, signed: DataFrame,
    texts: DataFrame, percent: int,
) -> DataFrame:
    """Links between candidates that the links so far leave in different components.

    Documents that met, directly or over others, form a cluster. A cluster that is
    connected needs no more work. Members of another are cut into blocks, and a task
    compares two blocks: pairs that share a bucket, that signatures do not prune and
    that links found before do not connect are checked on their full sets. A cluster
    of more than CLUSTER documents is compared bucket by bucket instead, each pair
    in the first bucket it shares. Blocks meet with their signatures first; texts
    come to the members that have a pair left. Only links leave a task, at most one
    for each member of its blocks.
    """
    labels = labels.withColumnRenamed("node", "doc_id").hint("merge")
    clusters = components(met).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    nodes = clusters.join(labels, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    is_open = F.min("component") < F.max("component")
    sizes = nodes.groupBy("cluster").agg(F.count("*").alias("size"), is_open.alias("open"))
    nodes = written(nodes.join(sizes.where("open").hint("merge"), "cluster"), "clusters")
    small = nodes.where(F.col("size") <= CLUSTER).select(
        F.col("cluster").cast("long").alias("key"), F.lit(False).alias("by_key"),
        "doc_id", "component", "size",
    )
    large = nodes.where(F.col("size") > CLUSTER).select("doc_id", "component")
    in_keys = members.join(large.hint("merge"), "doc_id")
    open_keys = in_keys.groupBy("key").agg(is_open.alias("open")).where("open")
    rows = small.unionAll(
        in_keys.join(open_keys.select("key").hint("merge"), "key", "left_semi").select(
            "key", F.lit(True).alias("by_key"), "doc_id", "component", "size"
        )
    )
    last_block = F.floor((F.col("size") - 1) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), last_block + 1).cast("int")
    rows = (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last_block)))
        .join(signed.select("doc_id", "bands", "code", "n_shingles").hint("merge"), "doc_id")
        .select(
            "key", "by_key", F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"), "own", "doc_id", "component", "bands",
            "code", F.col("n_shingles").cast("long").alias("n_shingles"),
        )
    )
    pair_type = dict(members.dtypes)["doc_id"]

    def left(table: pa.Table, size: np.ndarray, label: np.ndarray):
        """Each row of the first block with those of the second that may be linked to it."""
        key, by_key, i, j = (table.column(c)[0].as_py() for c in ("key", "by_key", "i", "j"))
        own = table.column("own").to_numpy()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        codes = _codes(table.column("code").combine_chunks())
        for row in np.flatnonzero(own == i):
            rest = np.flatnonzero((own == j) & (label != label[row]))
            rest = rest[rest > row] if i == j else rest
            small, large = np.minimum(size[rest], size[row]), np.maximum(size[rest], size[row])
            rest = rest[100 * small >= percent * large]
            same = bands[rest] == bands[row]
            if by_key:
                rest = rest[bands[row][same.argmax(axis=1)] == key]
            else:
                rest = rest[same.any(axis=1)]
            alike = np.broadcast_to(codes[row], (len(rest), _HASHES))
            yield row, rest[likely(alike, codes[rest], percent)]

    def unpruned(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        size, label = (table.column(c).to_numpy() for c in ("n_shingles", "component"))
        stays = np.zeros(len(size), bool)
        for row, rest in left(table, size, label):
            stays[rest] = True
            stays[row] |= len(rest) > 0
        return table.filter(pa.array(stays))

    def crossed(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        ids, label = (table.column(c).to_numpy() for c in ("doc_id", "component"))
        sets = shingle_sets(*utf8(table.column("text").combine_chunks()))
        size = np.array([len(x) for x in sets])
        label, links = label.copy(), []
        for row, rest in left(table, size, label):
            for other in rest:
                if label[row] == label[other]:
                    continue
                both = len(np.intersect1d(sets[row], sets[other], assume_unique=True))
                if 100 * both >= percent * (size[row] + size[other] - both):
                    label[label == label[other]] = label[row]
                    links.append((ids[row], ids[other]))
        a, b = np.array(links, ids.dtype).reshape(-1, 2).T
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    blocks = ["key", "by_key", "i", "j"]
    kept = written(rows.groupBy(*blocks).applyInArrow(unpruned, rows.schema), "blocks")
    return (
        kept.join(texts.hint("merge"), "doc_id")
        .groupBy(*blocks)
        .applyInArrow(crossed, f"a {pair_type}, b {pair_type}")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked by similar shingle sets.

    Two documents are linked when 100 * intersection >= percent * union of their
    distinct word shingles. Documents with equal sets form a class, of which the
    smallest doc_id takes part. Candidates share a band of the signature. First each
    member of a bucket meets the most central one only; then pairs that are still
    unconnected meet. Signature batches prune pairs, full sets confirm them, so every
    link is right, and a component misses one only where hashing does (MISS, BANDS).

    Missing and empty texts have no shingles and are linked with nothing. Repeated
    rows give one row each, and rows that share a doc_id are one node. Rows without
    doc_id represent no class: their component_id is that of their class, or missing.
    Other columns are not read.
    """
    signed = written(signatures(docs), "signatures")
    sets = ["n_shingles", "d1", "d2"]
    classes = signed.where("n_shingles > 0").groupBy(*sets).agg(F.min("doc_id").alias("class_id"))
    distinct_sets = classes.select(F.col("class_id").alias("doc_id")).hint("merge")
    rows = signed.join(distinct_sets, "doc_id", "left_semi").select(
        "doc_id", F.explode("bands").alias("key")
    )
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(rows.join(sizes.hint("merge"), "key"), "members")

    met = written(_central_pairs(members), "pairs")
    taking_part = members.select("doc_id").distinct().hint("merge")
    texts = written(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
            taking_part, "doc_id", "left_semi"
        ),
        "texts",
    )
    links = written(_verified(_pruned(met, signed, percent), texts, percent), "links")
    labels = components(links)

    more_links = written(_cross_links(members, met, labels, signed, texts, percent), "links")
    labels = components(links.unionAll(more_links))

    labels = labels.withColumnRenamed("node", "class_id").hint("merge")
    return (
        signed.select("doc_id", *sets)
        .join(classes.hint("merge"), sets, "left")
        .join(labels, "class_id", "left")
        .withColumn("empty", F.col("n_shingles") == 0)
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("empty"), F.col("doc_id"))
            .otherwise(F.coalesce("component", "class_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
