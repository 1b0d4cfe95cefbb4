"""Token counts of a unigram vocabulary: best segmentation, of which only the size is kept."""

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.tables import slices

# The sign for a space, and what an unknown character costs below the least score.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# Bytes of segments a worker remembers, and what an entry takes beside its characters.
REMEMBERED_BYTES = 160 << 20
_ENTRY_BYTES = 160
_SLICE_BYTES = 2 << 20
_SEGMENT = re.compile(" +[^ ]*")


class SegmentCounter:
    """Counts the pieces of the best segmentation of a text.

    No piece holds a space sign behind another character, so a text falls into
    segments, each of spaces and what follows them, that are cut independently; a
    segment met before is not cut again.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} reaches over a space")
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}
        self.size = 0

    def cut(self, segment: str) -> int:
        """Pieces of the best segmentation of a segment.

        Scores add up from the left. Of equal scores the piece that starts first
        stays. A character that is no piece of its own can be unknown, and then
        counts as its bytes in UTF-8.
        """
        scores, counts = [0.0], [0]
        found = self.automaton.iter(segment)
        end, match = next(found, (-1, None))
        for place, character in enumerate(segment):
            best, count, single = None, 0, False
            while end == place and match is not None:
                length, score = match
                start = place + 1 - length
                total = scores[start] + score
                if best is None or total > best:
                    best, count = total, counts[start] + 1
                single = single or length == 1
                end, match = next(found, (-1, None))
            if not single:
                total = scores[place] + self.unknown
                if best is None or total > best:
                    best = total
                    count = counts[place] + len(character.encode("utf-8"))
            scores.append(best)
            counts.append(count)
        return counts[-1]

    def count(self, text: str) -> int:
        """Pieces of a text; a space is put before it, unless it is empty."""
        if not text:
            return 0
        known, total = self.known, 0
        for segment in _SEGMENT.findall(" " + text.replace(SPACE, " ")):
            size = known.get(segment)
            if size is None:
                # Characters outside Latin-1 take two bytes or four.
                self.size += 4 * len(segment) + _ENTRY_BYTES
                if self.size > REMEMBERED_BYTES:
                    known.clear()
                    self.size = 4 * len(segment) + _ENTRY_BYTES
                size = known[segment] = self.cut(segment.replace(" ", SPACE))
            total += size
        return total


def ordinary_pieces(model_file: str) -> list[tuple[str, float]]:
    """The pieces of a model file that stand for text, with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


@lru_cache(maxsize=2)
def _counter(model_file: str) -> SegmentCounter:
    """One per worker, so that later tasks know the segments of earlier ones."""
    return SegmentCounter(ordinary_pieces(model_file))


def token_counts(docs: DataFrame, model_file: str, id_type: str = "long") -> DataFrame:
    """doc_id and n_tokens of every document's whole text.

    Missing and empty texts have no tokens. Every row gives one row, repeated or
    without doc_id too. Other columns are not read.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in slices(batches, "text", _SLICE_BYTES):
            sizes = [counter.count(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"]
            )

    return docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {id_type}, n_tokens long")
