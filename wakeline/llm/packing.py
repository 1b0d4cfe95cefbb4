"""Tokenised pieces of documents, and their packing into sequences by best fit."""

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.tables import slices, utf8, written
from wakeline.llm.words import distinct_words, split_words

CAPACITY = 4096
# Items packed together in one task at most, on average.
GROUP_ITEMS = 1 << 15
# Bytes of encoded words a worker remembers, and what an entry takes beside its bytes.
REMEMBERED_BYTES = 160 << 20
_ENTRY_BYTES = 180
END_ID = 1
_SLICE_BYTES = 2 << 20

# Letters of Latin-1, as their bytes in UTF-8, and a full stop or a comma behind them.
_LETTERS = re.compile(rb"((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([.,]?)")


class WordEncoder:
    """Encodes texts word by word; a word met before is not encoded again.

    For tokenizers that drop white space and merge within words only: the ids of a
    text are those of its words, cut at the white space of ASCII, one behind the
    other.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.size = 0
        self.ends = self._word_ends()

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a run of letters, where the tokenizer marks such ends and splits
        a full stop or a comma off; else None."""
        model = json.loads(self.tokenizer.to_str())["model"]
        split = self.tokenizer.pre_tokenizer
        if not model.get("end_of_word_suffix") or split is None:
            return None
        if [piece for piece, _ in split.pre_tokenize_str("ab. c,")] != ["ab", ".", "c", ","]:
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for piece, number in model["vocab"].items():
            ends[number] = piece.endswith(model["end_of_word_suffix"])
        return ends

    def _one_by_one(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(
            [word.decode("utf-8") for word in words], add_special_tokens=False
        )
        return [np.array(found.ids, "<u4").tobytes() for found in encoded]

    def _runs_of_letters(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each run, encoded as one text and cut behind the ids that end a run."""
        text = b" ".join(runs).decode("utf-8")
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(runs):
            return self._one_by_one(runs)
        whole, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [whole[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _learned(self, words: list[bytes]) -> list[bytes]:
        split = _LETTERS.fullmatch if self.ends is not None else lambda word: None
        matches = list(map(split, words))
        runs = list({match[1] for match in matches if match})
        ids = dict(zip(runs, self._runs_of_letters(runs), strict=True)) if runs else {}
        marks = [b"", b".", b","]
        ids |= zip(marks, self._one_by_one(marks), strict=True)
        other = iter(self._one_by_one([w for w, match in zip(words, matches) if not match]))
        found = [ids[match[1]] + ids[match[2]] if match else next(other) for match in matches]
        size = sum(map(len, words)) + sum(map(len, found)) + _ENTRY_BYTES * len(words)
        if self.size + size > REMEMBERED_BYTES:
            self.known.clear()
            self.size = 0
        self.size += size
        self.known.update(zip(words, found, strict=True))
        return found

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words as little-endian unsigned 32-bit numbers."""
        found = list(map(self.known.get, words))
        missing = [place for place, ids in enumerate(found) if ids is None]
        for place, ids in zip(missing, self._learned([words[p] for p in missing]), strict=True):
            found[place] = ids
        return found

    def encode(self, starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie one behind the other, and their bounds by text."""
        words = split_words(starts, data)
        codes, dictionary = distinct_words(words, data)
        found = self.word_ids(dictionary.to_pylist())
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(sizes) - sizes)[codes]
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        places = np.repeat(first - ends[:-1], sizes[codes]) + np.arange(ends[-1])
        return ids[places], ends[words.bounds]


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> WordEncoder:
    """One per worker, so that later tasks know the words of earlier ones."""
    return WordEncoder(tokenizer_file)


def token_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_type: str = "long"
) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, unsigned 32-bit) of every piece.

    A document is its ids and END_ID; only longer ones than ``capacity`` are cut. A
    missing or empty text is one piece of END_ID. Repeated rows and rows without
    doc_id give pieces of their own. Other columns are not read.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file)
        for batch in slices(batches, "text", _SLICE_BYTES):
            ids, bounds = encoder.encode(*utf8(batch.column("text")))
            ids = np.insert(ids, bounds[1:], END_ID)
            sizes = np.diff(bounds) + 1
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(batch.num_rows), count)
            piece = np.arange(len(row)) - (np.cumsum(count) - count)[row]
            start = piece * capacity
            lengths = np.minimum(sizes[row] - start, capacity)
            # Pieces follow each other as the ids do.
            edges = np.concatenate([[0], 4 * np.cumsum(lengths)])
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(lengths),
                    binary.cast(pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        pieces, f"doc_id {id_type}, piece int, start long, length long, ids binary"
    )


class OpenBins:
    """Bins by their remaining capacity, below a segment tree of which are open."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        if len(self.bins[room]) == 1:
            self._mark(room, 1)

    def _mark(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += change
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with the least room that holds ``need``, with its room; it is taken out."""
        node = self.leaves + need
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.open[2 * node])
        room = node - self.leaves
        number = self.bins[room].pop()
        if not self.bins[room]:
            self._mark(room, -1)
        return room, number


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items come longest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins, used = OpenBins(capacity), 0
    for place, length in enumerate(lengths.tolist()):
        found = open_bins.take(length)
        if found is None:
            found, used = (capacity, used), used + 1
        room, number = found
        bins[place], offsets[place] = number, capacity - room
        if room > length:
            open_bins.add(room - length, number)
    return bins, offsets


def pack(
    items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS
) -> DataFrame:
    """The items with sequence_id and offset: best-fit decreasing over ``length``.

    ``items`` has a column length from 1 to ``capacity``; its other columns are
    carried along and must not be named sequence_id, offset, item or group. Items
    are dealt evenly to groups that one task packs, however often rows repeat. In a
    group at most one sequence is no more than half full, so each costs less than
    one sequence over packing all at once.
    """
    items = written(items, "pieces")
    groups = max(1, -(-items.count() // group_items))
    numbered = items.withColumn("item", F.monotonically_increasing_id()).withColumn(
        "group", F.pmod("item", F.lit(groups))
    )
    names = items.columns
    schema = T.StructType(
        [*items.schema.fields, T.StructField("sequence_id", T.LongType()),
         T.StructField("offset", T.LongType())]
    )

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("item", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity)
        number = table.column("group")[0].as_py() << 32
        return (
            table.select(names)
            .append_column("sequence_id", pa.array(bins + number))
            .append_column("offset", pa.array(offsets))
        )

    return numbered.groupBy("group").applyInArrow(packed, schema)
