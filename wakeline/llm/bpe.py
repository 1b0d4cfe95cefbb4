"""Byte-level BPE of whole texts with content-defined chunks that are encoded once."""

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.rolling import byte_values, mixed, window_hashes
from wakeline.llm.tables import slices, utf8

# Bytes the rolling hash sees, and the mean length of a chunk as a power of two.
WINDOW = 32
CHUNK_BITS = 11
# Encoded chunks a task remembers, in tokens.
REMEMBERED_TOKENS = 20_000_000
_SLICE_BYTES = 4 << 20

# The pattern that splits a text before merges, and the special token.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = ("<|endoftext|>", 50256)


@lru_cache(maxsize=2)
def _encoding(rank_file: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        pairs = (line.split() for line in lines)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        "byte_bpe",
        pat_str=PATTERN,
        mergeable_ranks=ranks,
        special_tokens=dict([END_OF_TEXT]),
    )


@lru_cache(maxsize=2)
def _token_bytes(rank_file: str) -> np.ndarray:
    encoding = _encoding(rank_file)
    tokens = map(encoding.decode_single_token_bytes, range(encoding.n_vocab))
    return np.array(list(tokens), dtype=object)


def chunk_starts(data: np.ndarray) -> np.ndarray:
    """Positions at which the rolling hash of the bytes before them cuts a text."""
    hashes = mixed(window_hashes(byte_values()[data], WINDOW))
    low = np.uint64((1 << CHUNK_BITS) - 1)
    return np.flatnonzero(hashes & low == 0) + WINDOW


def certain_edges(data: np.ndarray) -> np.ndarray:
    """Positions where the split pattern ends a piece whatever stands around them.

    A space after a visible ASCII character: white space stands only at the start of
    a piece, so the piece before ends here, and scanning starts afresh.
    """
    visible = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
    return np.flatnonzero(visible & (data[1:] == 0x20)) + 1


class ChunkEncoder:
    """Encodes texts; chunks met before are not encoded again."""

    def __init__(self, rank_file: str):
        self.encoding = _encoding(rank_file)
        self.known: dict[bytes, np.ndarray] = {}
        self.size = 0

    def plain(self, data: bytes) -> np.ndarray:
        text = data.decode("utf-8")
        if END_OF_TEXT[0] in text:
            ids = self.encoding.encode(text, allowed_special="all")
            return np.array(ids, np.int32)
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def chunk(self, data: bytes) -> np.ndarray:
        ids = self.known.get(data)
        if ids is None:
            ids = self.plain(data)
            self.size += len(ids) + len(data) // 4
            if self.size > REMEMBERED_TOKENS:
                self.known.clear()
                self.size = len(ids) + len(data) // 4
            self.known[data] = ids
        return ids

    def encode(self, data: bytes, cuts: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Token ids of a text.

        The inside of a chunk, from its first to its last certain edge, has the same
        tokens in every text. At a join the stretch is widened on both sides to the
        next certain edge, where both sides agree with any longer encoding, and is
        encoded again. A chunk without two edges becomes part of the join.
        """
        parts, done = [], 0
        bounds = [0, *cuts.tolist(), len(data)]
        first = np.searchsorted(edges, bounds[:-1], "left")
        last = np.searchsorted(edges, bounds[1:], "right") - 1
        for low, high in zip(first.tolist(), last.tolist(), strict=True):
            if low >= high:
                continue
            start, end = int(edges[low]), int(edges[high])
            if done < start:
                parts.append(self.plain(data[done:start]))
            parts.append(self.chunk(data[start:end]))
            done = end
        if done < len(data):
            parts.append(self.plain(data[done:]))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _with_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest chunk hash of each text: texts that share chunks mostly share it."""
    for batch in slices(batches, "text", _SLICE_BYTES):
        starts, data = utf8(batch.column("text"))
        places = np.empty(batch.num_rows, np.int64)
        for row in range(batch.num_rows):
            text = data[starts[row] : starts[row + 1]]
            hashes = window_hashes(byte_values()[text], WINDOW)
            cuts = hashes[mixed(hashes) & np.uint64((1 << CHUNK_BITS) - 1) == 0]
            whole = mixed(byte_values()[text].sum(keepdims=True))
            places[row] = mixed(cuts if len(cuts) else whole).min().view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(places)],
            ["doc_id", "text", "place"],
        )


def encode_documents(docs: DataFrame, rank_file: str, id_type: str = "long") -> DataFrame:
    """doc_id, the token ids of the whole text, and the text decoded from them.

    Documents that share chunks are dealt to the same task, as far as the smallest
    chunk hash tells, and a task encodes each chunk once. Adaptive execution splits a
    place with too many documents. Missing and empty texts have no tokens; every row
    gives one row, repeated or without doc_id too; other columns are not read.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = ChunkEncoder(rank_file), _token_bytes(rank_file)
        for batch in slices(batches, "text", _SLICE_BYTES):
            starts, data = utf8(batch.column("text"))
            ids, texts = [], []
            for row in range(batch.num_rows):
                text = data[starts[row] : starts[row + 1]]
                found = encoder.encode(
                    text.tobytes(), chunk_starts(text), certain_edges(text)
                )
                ids.append(found)
                texts.append(b"".join(tokens[found]).decode("utf-8", "replace"))
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(texts, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    text = F.coalesce("text", F.lit("")).alias("text")
    placed = docs.select("doc_id", text).mapInArrow(
        _with_place, f"doc_id {id_type}, text string, place long"
    )
    return (
        placed.hint("rebalance", "place")
        .select("doc_id", "text")
        .mapInArrow(encoded, f"doc_id {id_type}, ids array<int>, decoded string")
    )


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
