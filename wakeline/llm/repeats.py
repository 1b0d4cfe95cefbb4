"""Long repeated strings across all documents, found by hashes at a cover of their positions.

Every string of LENGTH bytes holds at least one sampled position, and equal strings
hold it at the same place: the position whose KEY_WIDTH bytes have the smallest hash.
Consecutive strings with the same sampled position form a run. Runs are grouped by the
rank of the sample, which is its hash and no order of suffixes, and by a hash of the
whole run. Only where runs of one rank differ are single strings compared.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.rolling import byte_values, mixed, sliding_minimum, window_hashes
from wakeline.llm.tables import slices, utf8, written

LENGTH = 100
KEY_WIDTH = 32
# Runs a task folds before they are shuffled, and strings of one rank it compares.
FOLDED_RUNS = 1 << 18
COMPARED_STRINGS = 1 << 21
# An executor holds some twelve numbers of eight bytes for each byte, for each of its tasks.
_SLICE_BYTES = 1 << 18

_RUN = "rank long, content long, doc_id long, first long, size int, place int"
_JUDGED = "kind int, rank long, doc_id long, first long, size int, place int"
REPEATED, OPEN, SINGLE = 0, 1, 2
_PASSED_ON = -1


def _segments(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of overlapping segments, from prefix sums of a polynomial."""
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 1 << 64)
    powers = _powers(base, len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(byte_values(1)[data] * powers)])
    back = _powers(inverse, len(data))
    return mixed((sums[first + size] - sums[first]) * back[first] + size.astype(np.uint64))


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(max(count, 1), np.uint64(base), np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def sampled_runs(starts: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of texts that lie one behind the other: text, first, size, place, rank, content.

    ``first`` is the byte of the text at which the run's first string starts, ``size``
    the number of strings, ``place`` the distance from there to the sampled position.
    """
    none = np.zeros(0, np.int64)
    empty = dict.fromkeys(("text", "first", "size", "place"), none)
    if len(data) < LENGTH:
        return empty | {"rank": none.view(np.uint64), "content": none.view(np.uint64)}
    keys = mixed(window_hashes(byte_values()[data], KEY_WIDTH))
    low = np.uint64(0xFFFFFFFF)
    ordered = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    sampled = (sliding_minimum(ordered, LENGTH - KEY_WIDTH + 1) & low).astype(np.int64)
    text = np.searchsorted(starts, np.arange(len(sampled)), "right") - 1
    strings = np.flatnonzero(np.arange(len(sampled)) + LENGTH <= starts[text + 1])
    if not len(strings):
        return empty | {"rank": none.view(np.uint64), "content": none.view(np.uint64)}
    at = sampled[strings]
    new = np.concatenate([[True], (np.diff(at) != 0) | (np.diff(text[strings]) != 0)])
    head = np.flatnonzero(new)
    size = np.diff(np.concatenate([head, [len(strings)]]))
    first, at = strings[head], at[head]
    content = _segments(data, first, size + LENGTH - 1)
    return {
        "text": text[first],
        "first": first - starts[text[first]],
        "size": size,
        "place": at - first,
        "rank": keys[at],
        "content": mixed(content ^ mixed((at - first).astype(np.uint64) + np.uint64(1))),
    }


def _run_batch(rank, content, doc_id, first, size, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rank.view(np.int64)),
            pa.array(content.view(np.int64)),
            pa.array(doc_id),
            pa.array(first),
            pa.array(size.astype(np.int32)),
            pa.array(place.astype(np.int32)),
        ],
        ["rank", "content", "doc_id", "first", "size", "place"],
    )


def _merged(doc_id: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Runs that follow each other in a document as one; ordered by document and place."""
    order = np.lexsort((first, doc_id))
    doc_id, first, size = doc_id[order], first[order], size[order].astype(np.int64)
    if not len(doc_id):
        return doc_id, first, size
    joined = (doc_id[1:] == doc_id[:-1]) & (first[1:] == first[:-1] + size[:-1])
    head = np.flatnonzero(np.concatenate([[True], ~joined]))
    return doc_id[head], first[head], np.add.reduceat(size, head)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a task, equal ones only at their earliest place.

    The others repeat it whatever the rest of the table holds: they pass on as such.
    """
    held: list[dict[str, np.ndarray]] = []
    count = 0

    def fold() -> Iterator[pa.RecordBatch]:
        runs = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order = np.lexsort((runs["first"], runs["doc_id"], runs["content"], runs["rank"]))
        runs = {k: v[order] for k, v in runs.items()}
        rank, content, doc_id, first = (runs[k] for k in ("rank", "content", "doc_id", "first"))
        again = np.zeros(len(rank), bool)
        again[1:] = (rank[1:] == rank[:-1]) & (content[1:] == content[:-1])
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(rank))))
        same_place = (doc_id == doc_id[head]) & (first == first[head])
        repeated = again & ~same_place
        yield _run_batch(
            rank[~again], content[~again], doc_id[~again], first[~again],
            runs["size"][~again], runs["place"][~again],
        )
        doc_id, first, size = _merged(doc_id[repeated], first[repeated], runs["size"][repeated])
        spread = mixed(doc_id.astype(np.uint64) ^ mixed(first.astype(np.uint64)))
        yield _run_batch(spread, spread, doc_id, first, size, np.full(len(doc_id), _PASSED_ON))

    for batch in slices(batches, "text", _SLICE_BYTES):
        starts, data = utf8(batch.column("text"))
        runs = sampled_runs(starts, data)
        ids = batch.column("doc_id").to_numpy()
        runs["doc_id"] = ids[runs.pop("text")]
        held.append(runs)
        count += len(runs["rank"])
        if count > FOLDED_RUNS:
            yield from fold()
            held, count = [], 0
    if count:
        yield from fold()


def _judged_batch(kind: int, columns: dict[str, np.ndarray], rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(columns["rank"][rows]), kind, np.int32)),
            *(pa.array(columns[c][rows]) for c in ("rank", "doc_id", "first", "size", "place")),
        ],
        ["kind", "rank", "doc_id", "first", "size", "place"],
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in the order of rank, content, doc_id and first: repeated, or open.

    A run equal to one before it is repeated. The first of its content is open when
    its rank has other contents too. Of the rank at the end of a batch only the first
    run and the first run of the last content are kept, however many there are.
    """
    names = ["rank", "content", "doc_id", "first", "size", "place"]
    carried: dict[str, np.ndarray] | None = None
    told = np.zeros(0, bool)  # whether a carried run was reported as open
    for batch in batches:
        columns = {c: batch.column(c).to_numpy() for c in names}
        passed = columns["place"] == _PASSED_ON
        yield _judged_batch(REPEATED, columns, passed)
        columns = {c: v[~passed] for c, v in columns.items()}
        if not len(columns["rank"]):
            continue
        old = 0
        if carried is not None:
            old = len(told)
            columns = {c: np.concatenate([carried[c], v]) for c, v in columns.items()}
        count = len(columns["rank"])
        reported = np.concatenate([told, np.zeros(count - old, bool)])
        rank, content = columns["rank"], columns["content"]
        new_rank = np.concatenate([[True], rank[1:] != rank[:-1]])
        new_content = new_rank | np.concatenate([[True], content[1:] != content[:-1]])
        head = np.maximum.accumulate(np.where(new_content, np.arange(count), 0))
        same_place = (columns["doc_id"] == columns["doc_id"][head]) & (
            columns["first"] == columns["first"][head]
        )
        fresh = np.arange(count) >= old
        yield _judged_batch(REPEATED, columns, ~new_content & ~same_place & fresh)
        group = np.cumsum(new_rank) - 1
        contents = np.bincount(group, weights=new_content)
        differing = new_content & (contents[group] > 1)
        yield _judged_batch(OPEN, columns, differing & ~reported)
        reported |= differing
        keep = np.unique([np.flatnonzero(new_rank)[-1], head[-1]])
        carried, told = {c: v[keep] for c, v in columns.items()}, reported[keep]


def _compressed(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """doc_id, the compressed text and the carried columns, for shuffles of whole texts."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text", _SLICE_BYTES):
            starts, data = utf8(batch.column("text"))
            places = starts.tolist()
            texts = [
                packer.compress(data[a:b].tobytes())
                for a, b in zip(places, places[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(texts, pa.binary()),
                    *(batch.column(c) for c in carry),
                ],
                ["doc_id", "packed", *carry],
            )

    carried = docs.select(*carry).schema.fields
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("packed", T.BinaryType()), *carried]
    )
    return docs.select("doc_id", "text", *carry).mapInArrow(compress, schema)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open run of a document."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in range(batch.num_rows):
            text = unpacker.decompress(batch.column("packed")[row].as_py())
            runs = pa.RecordBatch.from_struct_array(batch.column("runs")[row].values)
            # Another row of the doc_id may have a shorter text than the run's own.
            room = len(text) - LENGTH + 1 - runs.column("first").to_numpy()
            size = np.minimum(runs.column("size").to_numpy(), room)
            runs, size = runs.filter(pa.array(size > 0)), size[size > 0].tolist()
            first = runs.column("first").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    runs.column("rank"),
                    pa.repeat(batch.column("doc_id")[row], runs.num_rows),
                    runs.column("first"),
                    pa.array(size, pa.int32()),
                    pa.array(
                        [text[f : f + s + LENGTH - 1] for f, s in zip(first, size, strict=True)],
                        pa.binary(),
                    ),
                ],
                ["rank", "doc_id", "first", "size", "context"],
            )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single strings of open runs, in the order of rank, doc_id and first: the repeated ones.

    Strings of the rank at the end of a batch are remembered for the next one, with
    their earliest place: rows that share a doc_id give the same place again. Beyond
    COMPARED_STRINGS of a rank, strings not among the remembered are passed on for a
    comparison that is spread by string.
    """
    open_rank, full = None, False
    # The keys of the open rank in order, and the earliest document and place of each.
    none = np.zeros(0, np.int64)
    known, known_doc, known_place = np.zeros(0, np.uint64), none, none
    for batch in slices(batches, "context", _SLICE_BYTES):
        ends, data = utf8(batch.column("context"))
        rank, doc_id, first = (
            batch.column(c).to_numpy() for c in ("rank", "doc_id", "first")
        )
        size = batch.column("size").to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        hashes = window_hashes(byte_values(1)[data], LENGTH, 1)[ends[:-1][row] + step]
        key = mixed(hashes ^ mixed(rank.view(np.uint64))[row])
        ids, place = doc_id[row], first[row] + step
        keys, head, group = np.unique(key, return_index=True, return_inverse=True)
        # Rows that share a doc_id may come in any order of their places.
        early_doc = ids[head]
        early_place = place[head].copy()
        same = ids == early_doc[group]
        np.minimum.at(early_place, group[same], place[same])
        of_open = rank[row[head]] == open_rank if open_rank is not None else np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        met = of_open & (known[at] == keys) if len(known) else np.zeros(len(keys), bool)
        at = at[met]
        overtaken = (known_doc[at] == early_doc[met]) & (known_place[at] > early_place[met])
        late_ids, late_places = known_doc[at[overtaken]], known_place[at[overtaken]]
        known_place[at[overtaken]] = early_place[met][overtaken]
        early_doc[met], early_place[met] = known_doc[at], known_place[at]
        repeated = (ids != early_doc[group]) | (place != early_place[group])
        # Also in the slice where the rank ends and others follow.
        spare = (full & of_open & ~met)[group] & ~repeated
        if rank[-1] != open_rank:
            open_rank, full = rank[-1], False
            known, known_doc, known_place = np.zeros(0, np.uint64), none, none
            met = np.zeros(len(keys), bool)
        if not full:
            new = (rank[row[head]] == open_rank) & ~met
            known = np.concatenate([known, keys[new]])
            order = np.argsort(known, kind="stable")
            known = known[order]
            known_doc = np.concatenate([known_doc, early_doc[new]])[order]
            known_place = np.concatenate([known_place, early_place[new]])[order]
            full = len(known) > COMPARED_STRINGS
        spare_key, spare_ids, spare_places = key[spare], ids[spare], place[spare]
        ids, places, sizes = _merged(
            np.concatenate([ids[repeated], late_ids]),
            np.concatenate([place[repeated], late_places]),
            np.ones(repeated.sum() + len(late_ids), np.int64),
        )
        yield _compared_batch(REPEATED, np.zeros(len(ids), np.int64), ids, places, sizes)
        yield _compared_batch(
            SINGLE, spare_key.view(np.int64), spare_ids, spare_places,
            np.ones(len(spare_key), np.int64),
        )


def _compared_batch(kind, rank, doc_id, first, size) -> pa.RecordBatch:
    columns = {"rank": rank, "doc_id": doc_id, "first": first, "size": size.astype(np.int32)}
    columns["place"] = np.zeros(len(rank), np.int32)
    return _judged_batch(kind, columns, np.ones(len(rank), bool))


def repeated_strings(docs: DataFrame, compressed: DataFrame) -> DataFrame:
    """doc_id, first, size: runs of strings of LENGTH bytes that also start earlier."""
    runs = docs.select("doc_id", "text").where("doc_id IS NOT NULL").mapInArrow(_folded, _RUN)
    judged = written(
        runs.repartition("rank")
        .sortWithinPartitions("rank", "content", "doc_id", "first")
        .mapInArrow(_judged, _JUDGED),
        "runs",
    )
    wanted = (
        judged.where(F.col("kind") == OPEN)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("rank", "first", "size")).alias("runs"))
    )
    compared = written(
        compressed.select("doc_id", "packed")
        .join(wanted, "doc_id")
        .mapInArrow(
            _contexts, "rank long, doc_id long, first long, size int, context binary"
        )
        .repartition("rank")
        .sortWithinPartitions("rank", "doc_id", "first")
        .mapInArrow(_compared, _JUDGED),
        "strings",
    )
    single = compared.where(F.col("kind") == SINGLE).select(
        "rank", F.struct("doc_id", "first").alias("at")
    )
    earliest = single.groupBy("rank").agg(F.min("at").alias("earliest"))
    late = (
        single.join(earliest.hint("merge"), "rank")
        .where("at > earliest")
        .select("at.doc_id", "at.first", F.lit(1).alias("size"))
    )
    found = [x.where(F.col("kind") == REPEATED) for x in (judged, compared)]
    columns = ["doc_id", "first", "size"]
    return found[0].select(*columns).unionAll(found[1].select(*columns)).unionAll(late)


def remove_repeats(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and kept (binary): what is left of each text.

    The columns of ``carry`` come along.

    A byte goes when a string of LENGTH bytes that covers it also starts earlier, in a
    document with a smaller doc_id or before it in the same one. Strings are judged on
    the input. What is left of a text need not be valid UTF-8. Missing texts count as
    empty, texts shorter than LENGTH stay whole. Rows without doc_id stay whole and
    are no earlier place for others. Rows that share a doc_id are not compared at the
    same place; with different texts the spans found for either hold for both. Other
    columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", *carry)
    compressed = _compressed(docs, carry)
    spans = (
        repeated_strings(docs, compressed)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("first", "size")).alias("spans"))
    )

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            counts, kept = [], []
            for row in range(batch.num_rows):
                text = unpacker.decompress(batch.column("packed")[row].as_py())
                found = batch.column("spans")[row].values
                stays = text
                cover = np.zeros(len(text) + 1, np.int64)
                if found is not None and len(found):
                    runs = pa.RecordBatch.from_struct_array(found)
                    first = runs.column("first").to_numpy()
                    end = np.minimum(first + runs.column("size").to_numpy() + LENGTH - 1, len(text))
                    np.add.at(cover, np.minimum(first, len(text)), 1)
                    np.add.at(cover, end, -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    stays = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    cover = np.diff(gone.astype(np.int8), prepend=0) == 1
                counts.append((len(text), len(text) - len(stays), int(cover.sum())))
                kept.append(stays)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(list(c), pa.int64()) for c in zip(*counts, strict=True)),
                    pa.array(kept, pa.binary()),
                    *(batch.column(c) for c in carry),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carry],
            )

    schema = T.StructType(
        [
            *(T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")),
            T.StructField("kept", T.BinaryType()),
            *docs.select(*carry).schema.fields,
        ]
    )
    return compressed.join(spans, "doc_id", "left").mapInArrow(removed, schema)
