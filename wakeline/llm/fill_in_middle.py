"""Fill-in-middle forms of texts cut at lines, through a learned index of line ends.

The places where the lines of a text end are a growing function of their number. It is
fitted by straight pieces that stray from it by a bounded error, and each place keeps
its residual, one small number. A cut is predicted by the piece of its line number and
corrected by the residual, which gives the exact place.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import slices, utf8

# Residuals fit into a signed byte.
MAX_ERROR = 127
_SLICE_BYTES = 4 << 20

# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass
class RankIndex:
    """Places by rank for sequences that lie one behind the other, ranks counted over all.

    Piece i covers the ranks from ``rank[i]`` to before ``rank[i + 1]``; it rises from
    ``place[i]`` by ``rise[i]`` over ``run[i]`` ranks.
    """

    rank: np.ndarray
    place: np.ndarray
    rise: np.ndarray
    run: np.ndarray
    residual: np.ndarray

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.rank, ranks, "right") - 1
        return self.place[piece] + self.rise[piece] * (ranks - self.rank[piece]) // self.run[piece]

    def places(self, ranks: np.ndarray) -> np.ndarray:
        return self._predicted(ranks) + self.residual[ranks]


def learned_index(places: np.ndarray, bounds: np.ndarray, max_error: int = MAX_ERROR) -> RankIndex:
    """Fit the places of each sequence; ``bounds`` has one more entry and none is empty.

    A piece runs through its two ends and is halved while any place strays further than
    ``max_error``; two neighbours always fit. All pieces of a round are tried at once.
    """
    low, high = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64) - 1
    residual = np.zeros(len(places), np.int8 if max_error <= 127 else np.int64)
    fitted = []
    while len(low):
        rise, run = places[high] - places[low], np.maximum(high - low, 1)
        sizes = high - low + 1
        head = np.cumsum(sizes) - sizes
        inside = np.arange(sizes.sum()) - np.repeat(head, sizes)
        ranks = np.repeat(low, sizes) + inside
        line = np.repeat(places[low], sizes)
        line += np.repeat(rise, sizes) * inside // np.repeat(run, sizes)
        error = places[ranks] - line
        good = np.maximum.reduceat(np.abs(error), head) <= max_error
        held = np.repeat(good, sizes)
        residual[ranks[held]] = error[held]
        fitted.append((low[good], places[low[good]], rise[good], run[good]))
        low, high = low[~good], high[~good]
        middle = (low + high) // 2
        low, high = np.concatenate([low, middle + 1]), np.concatenate([middle, high])
    pieces = [np.concatenate(column) for column in zip(*fitted, strict=True)]
    order = np.argsort(pieces[0])
    return RankIndex(*(column[order] for column in pieces), residual)


def line_ends(starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start of each text and the end of each of its lines, and their bounds by text.

    A line ends behind its line break, or with the text.
    """
    behind = np.flatnonzero(data == 0x0A) + 1
    # The start of a text, the breaks inside it, and its end where no break is there.
    last = starts[1:][starts[1:] > starts[:-1]]
    open_ends = last[data[last - 1] != 0x0A]
    ends = np.sort(np.concatenate([behind, open_ends]))
    lines = np.searchsorted(ends, starts, "right")
    places = np.insert(ends, lines[:-1], starts[:-1])
    return places, lines + np.arange(len(starts))


def draws(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, text and h1 to h4, the first four 8-digit groups of the SHA-256 of
    ``seed:doc_id`` as whole numbers; a missing doc_id counts as no digits."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return (
        docs.select(
            "doc_id", "text", F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256).alias("digest")
        )
        .withColumns(
            {
                f"h{i + 1}": F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")
                for i in range(4)
            }
        )
        .drop("digest")
    )


def _with_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SLICE_BYTES):
        starts, data = utf8(batch.column("text"))
        ends, bounds = line_ends(starts, data)
        # Places count code points: all bytes but those that continue one.
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        places = characters[ends] - np.repeat(characters[starts[:-1]], np.diff(bounds))
        index = learned_index(places, bounds)
        n = np.diff(bounds) - 1
        one, two = (batch.column(h).to_numpy() % (n + 1) for h in ("h1", "h2"))
        first = index.places(bounds[:-1] + np.minimum(one, two))
        second = index.places(bounds[:-1] + np.maximum(one, two))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "text", "h3", "h4")),
                *(pa.array(c) for c in (n, first, second - first)),
            ],
            ["doc_id", "text", "h3", "h4", "n", "prefix_chars", "middle_chars"],
        )


def fill_in_middle(
    drawn: DataFrame, percent: int, spm_percent: int, id_type: str = "long"
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of each text with its draws.

    A text has n lines, each with its line break. The prefix ends after the smaller of
    h1 % (n + 1) and h2 % (n + 1) lines, the middle after the larger. A text stays plain
    where it is empty, holds one of the three marks, or h3 % 100 is ``percent`` or more;
    otherwise h4 % 100 below ``spm_percent`` puts the suffix first. Lengths of parts are
    code points, and null for plain texts. Missing texts are empty ones. Every row gives
    one row, repeated or without doc_id too; other columns are not read.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    cut = drawn.select("doc_id", text, "h1", "h2", "h3", "h4").mapInArrow(
        _with_cuts,
        f"doc_id {id_type}, text string, h3 long, h4 long, "
        "n long, prefix_chars long, middle_chars long",
    )
    text, prefix_end = F.col("text"), F.col("prefix_chars")
    middle_end = prefix_end + F.col("middle_chars")
    prefix = F.substr(text, F.lit(1), prefix_end.cast("int"))
    middle = F.substr(text, (prefix_end + 1).cast("int"), F.col("middle_chars").cast("int"))
    suffix = F.substr(text, (middle_end + 1).cast("int"))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("h3") % 100 >= percent)
    spm = F.col("h4") % 100 < spm_percent
    form = F.when(plain, "plain").when(spm, "spm").otherwise("psm")
    is_plain = F.col("form") == "plain"
    output = (
        F.when(is_plain, text)
        .when(
            F.col("form") == "spm",
            F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle),
        )
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    return cut.withColumn("form", form).select(
        "doc_id",
        "n",
        "form",
        F.when(~is_plain, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(~is_plain, F.col("middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored_text(output: Column, form: Column) -> Column:
    """The text an output was made of. One that is not plain holds each mark once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    # Nothing stands before the first mark, and the middle comes last in both forms.
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "plain", output)
        .when(form == "spm", F.concat(two, middle, one))
        .otherwise(F.concat(one, middle, two))
    )
