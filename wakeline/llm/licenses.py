"""Licences of files: TF-IDF cosine to templates, then inheritance from directories."""

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from types import MappingProxyType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.licence_forms import RESERVATION, all_forms, tagged
from wakeline.llm.tables import slices, written

# A run of terms or a whole file is a statement of the licence it is at least this similar to.
THRESHOLD = 0.6
# The same for the whole text of a licence, as licences share much of their wording.
TEXT_THRESHOLD = 0.8
_SLICE_BYTES = 4 << 20
# Terms a task counts before it passes them on, and rows of a batch of them.
_HELD_TERMS = 1 << 19
_TERM_ROWS = 1 << 16
_TERM = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")

# The short notices of common licences, by their identifiers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD 3-Clause license",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Proprietary": "All rights reserved",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}
# Names that mark a licence file.
FILE_NAMES = re.compile(r"(?i)(?:.*/)?(?:licen[cs]e|copying|unlicense)(?:[.-][^/]*)?")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Templates:
    """Template vectors over their own terms, weighted by the corpus."""

    def __init__(self, texts: Mapping[str, str], df: Mapping[str, int], count: int):
        self.names = sorted(texts)
        self.count = count
        words = sorted({w for t in texts.values() for w in terms(t)})
        self.names_of = words
        self.place = {word: i for i, word in enumerate(words)}
        self.idf = np.array([self.weight(df.get(w, 0)) for w in words])
        rows = np.zeros((len(self.names), len(words)))
        for row, name in enumerate(self.names):
            for word in terms(texts[name]):
                rows[row, self.place[word]] += 1
        self.lengths = rows.sum(axis=1).astype(np.int64)
        titles = [n for n, name in enumerate(self.names) if name.endswith("/title")]
        self.titles = {n: frozenset(terms(texts[self.names[n]])) for n in titles}
        self.runs = [n for n in range(len(self.names)) if n not in self.titles]
        rows *= self.idf
        self.rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)

    def weight(self, files: int) -> float:
        """The weight of a term that this many files hold."""
        return float(np.log((1 + self.count) / (1 + files)) + 1)

    def codes(self, words: list[str], others: Mapping[str, float] | None):
        """A number for each word, and its weight.

        Words of no template have the weight in ``others``, or that of a word that no
        file holds. Without ``others`` they weigh the least, as in every file.
        """
        held: dict[str, int] = {}
        at = np.array(
            [
                self.place[w] if w in self.place else len(self.idf) + held.setdefault(w, len(held))
                for w in words
            ],
            np.int64,
        )
        if others is None:
            rest = np.ones(len(held))
        else:
            none = self.weight(0)
            rest = np.array([others.get(w, none) for w in held])
        return at, np.concatenate([self.idf, rest])

    def cosines(self, words: list[str], others: Mapping[str, float] | None) -> np.ndarray:
        """The cosine of the words to each template."""
        at, weights = self.codes(words, others)
        vector = np.bincount(at, minlength=len(weights)) * weights
        norm = np.linalg.norm(vector)
        if not norm:
            return np.zeros(len(self.names))
        return np.round(self.rows @ vector[: len(self.idf)] / norm, 9)

    def best(
        self, words: list[str], others: Mapping[str, float] = MappingProxyType({})
    ) -> tuple[float, str | None]:
        """The most similar template, the first name of equals, and the cosine."""
        if not words:
            return 0.0, None
        cosines = self.cosines(words, others)
        return float(cosines.max()), self.names[int(cosines.argmax())]

    def thresholds(self, threshold: float) -> np.ndarray:
        """The least cosine of each template."""
        least = [TEXT_THRESHOLD if name.endswith("/text") else threshold for name in self.names]
        return np.maximum(threshold, least)

    def telling(self, threshold: float) -> list[frozenset[int]]:
        """For each template the terms of which a text needs one to reach its threshold.

        A text of the other terms only has at most the norm of the template over them
        as its cosine. The most frequent terms are left out as long as that stays
        below the threshold.
        """
        order = np.argsort(self.idf, kind="stable")
        found = []
        for row, least in zip(self.rows, self.thresholds(threshold), strict=True):
            norms = np.sqrt(np.cumsum(row[order] ** 2))
            needed = order[np.searchsorted(norms, least - 1e-9) :]
            found.append(frozenset(needed[row[needed] > 0].tolist()))
        return found

    def windows(
        self, words: list[str], others: Mapping[str, float] | None, chosen: Iterable[int]
    ) -> Iterator[tuple[int, np.ndarray]]:
        """For each chosen template the cosine of every run of as many words as it has.

        A shorter text is one run.
        """
        at, weights = self.codes(words, others)
        square = weights[at] ** 2
        known = at < len(self.idf)
        norms: dict[int, np.ndarray] = {}
        for row in chosen:
            size = min(int(self.lengths[row]), len(words))
            if size not in norms:
                norms[size] = _window_norms(at, square, size)
            part = np.zeros(len(words))
            part[known] = self.rows[row, at[known]] * self.idf[at[known]]
            sums = np.concatenate([[0.0], np.cumsum(part)])
            yield row, np.round((sums[size:] - sums[: len(sums) - size]) / norms[size], 9)


def _window_norms(at: np.ndarray, square: np.ndarray, size: int) -> np.ndarray:
    """The norm of each run of ``size`` words: the squared counts by the squared weights."""
    count = len(at)
    order = np.argsort(at, kind="stable")
    spread = at[order] * (count + 1) + order
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    # Words equal to each among it and the size - 1 before or behind it.
    before = place - np.searchsorted(spread, at * (count + 1) + np.arange(count) - size + 1) + 1
    behind = np.searchsorted(spread, at * (count + 1) + np.arange(count) + size) - place
    first = (np.bincount(at[:size]) ** 2 * _by_code(at[:size], square[:size])).sum()
    starts = np.arange(1, count - size + 1)
    change = square[starts + size - 1] * (2 * before[starts + size - 1] - 1)
    change -= square[starts - 1] * (2 * behind[starts - 1] - 1)
    return np.sqrt(np.maximum(np.concatenate([[first], first + np.cumsum(change)]), 1.0))


def _by_code(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.zeros(at.max() + 1)
    found[at] = values
    return found


def term_counts(files: DataFrame) -> DataFrame:
    """term, files: in how many files each term occurs; the empty term counts the files."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in slices(batches, "text", _SLICE_BYTES):
            found[""] += batch.num_rows
            for text in batch.column("text").to_pylist():
                found.update(set(terms(text or "")))
                if len(found) > _HELD_TERMS:
                    yield from as_batch(found)
                    found.clear()
        yield from as_batch(found)

    def as_batch(found: Counter[str]) -> Iterator[pa.RecordBatch]:
        names = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
        whole = pa.RecordBatch.from_arrays(names, ["term", "files"])
        for first in range(0, len(found), _TERM_ROWS):
            yield whole.slice(first, _TERM_ROWS)

    return (
        files.select("text")
        .mapInArrow(counted, "term string, files long")
        .groupBy("term")
        .agg(F.sum("files").alias("files"))
    )


_CANDIDATE = (
    "id long, path string, size long, whole array<string>, parts array<array<string>>,"
    " lines array<array<string>>, tag string"
)


def candidates(files: DataFrame, templates: Templates, threshold: float) -> DataFrame:
    """The files that may state a licence, each with the terms to compare.

    Terms of no template count with the least weight here, so nothing that reaches the
    threshold with the true weights is left out. ``whole`` has all terms when the whole
    text may be similar, ``parts`` the runs of terms in which a window may be.
    ``size`` is the number of all terms, ``lines`` has those of lines with a title, and
    ``tag`` is an SPDX expression.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling = templates.telling(threshold)
        least = templates.thresholds(threshold)
        runs_only = np.isin(np.arange(len(least)), templates.runs)
        needed = {templates.names_of[i] for i in frozenset().union(*telling)}
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", _SLICE_BYTES):
            rows, sizes, wholes, parts, titled, tags = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = terms(text or "")
                tag = tagged(text or "") if "spdx" in words else None
                if tag is None and needed.isdisjoint(words):
                    continue
                held = {templates.place[w] for w in needed.intersection(words)}
                chosen = [n for n in templates.runs if not telling[n].isdisjoint(held)]
                whole = (templates.cosines(words, None) >= least)[runs_only].any()
                near = np.zeros(len(words) + 1, np.int64)
                for n, cosines in templates.windows(words, None, chosen):
                    start = np.flatnonzero(cosines >= least[n])
                    np.add.at(near, start, 1)
                    np.add.at(near, start + min(int(templates.lengths[n]), len(words)), -1)
                inside = np.diff((np.cumsum(near) > 0).astype(np.int8), prepend=0)
                found = zip(np.flatnonzero(inside == 1), np.flatnonzero(inside == -1), strict=True)
                runs = [words[a:b] for a, b in found]
                lines = _titled(text or "", words, templates, threshold)
                if whole or runs or lines or tag:
                    rows.append(row)
                    sizes.append(len(words))
                    wholes.append(words if whole else None)
                    parts.append(runs)
                    titled.append(lines)
                    tags.append(tag)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + len(rows))),
                    batch.column("path").take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(wholes, pa.list_(pa.string())),
                    pa.array(parts, pa.list_(pa.list_(pa.string()))),
                    pa.array(titled, pa.list_(pa.list_(pa.string()))),
                    pa.array(tags, pa.string()),
                ],
                ["id", "path", "size", "whole", "parts", "lines", "tag"],
            )
            number += len(rows)

    return files.select("path", "text").mapInArrow(scanned, _CANDIDATE)


def _titled(text: str, words: list[str], templates: Templates, threshold: float):
    """The terms of the lines that have all terms of a title and may be similar to it."""
    held = set(words)
    wanted = [(n, title) for n, title in templates.titles.items() if title <= held]
    found = []
    for line in text.split("\n") if wanted else []:
        line_words = terms(line)
        if any(title.issubset(line_words) for _, title in wanted):
            cosines = templates.cosines(line_words, None)
            if any(cosines[n] >= threshold for n, title in wanted if title.issubset(line_words)):
                found.append(line_words)
    return found


def _statement(file: dict, templates: Templates, threshold: float):
    """The licence of a file, its score, and whether the whole text states it."""
    others = {x["term"]: templates.weight(x["files"]) for x in file["others"] or []}
    least = templates.thresholds(threshold)
    # (whether only rights are reserved, whether not the whole text, less the score, name)
    stated = []

    def state(n: int, score: float, whole: bool) -> None:
        if score >= least[n]:
            name = templates.names[n].split("/")[0]
            stated.append((name == RESERVATION, not whole, -score, name))

    if file["whole"]:
        cosines = templates.cosines(file["whole"], others)
        for n in templates.runs:
            state(n, float(cosines[n]), True)
    for line in file["lines"]:
        cosines = templates.cosines(line, others)
        for n, title in templates.titles.items():
            if title.issubset(line):
                state(n, float(cosines[n]), False)
    # A part shorter than the run of a template has none that counts.
    sizes = np.minimum(templates.lengths, file["size"])
    for part in file["parts"]:
        chosen = [n for n in templates.runs if sizes[n] <= len(part)]
        for n, cosines in templates.windows(part, others, chosen):
            state(n, float(cosines.max()), False)
    reserved, in_part, score, name = min(stated, default=(True, True, 0.0, None))
    whole = any(not x[1] for x in stated)
    if file["tag"]:
        return file["tag"], 1.0, whole and not reserved
    return name, -score, not in_part


def own_licenses(
    found: DataFrame, counts: DataFrame, templates: Templates, threshold: float
) -> DataFrame:
    """path, license, score and is_file of the files that state a licence themselves.

    An SPDX tag says the licence. Otherwise the whole text is compared first: then the
    file is a licence file. Otherwise the most similar run of as many terms as a
    template has, wherever its lines break, or line with a title decides, the first
    name of equals. Reserved rights count where nothing else is stated.
    """
    words = F.array_distinct(
        F.concat(
            F.coalesce("whole", F.array().cast("array<string>")),
            F.flatten("parts"),
            F.flatten("lines"),
        )
    )
    weighed = (
        found.select("id", F.explode(words).alias("term"))
        .join(counts.hint("merge"), "term")
        .groupBy("id")
        .agg(F.collect_list(F.struct("term", "files")).alias("others"))
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, scores, is_file = [], [], [], []
            for row, file in enumerate(batch.to_pylist()):
                name, score, whole = _statement(file, templates, threshold)
                if name is not None:
                    rows.append(row)
                    names.append(name)
                    scores.append(score)
                    is_file.append(whole or bool(FILE_NAMES.fullmatch(file["path"] or "")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("path").take(pa.array(rows, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(is_file, pa.bool_()),
                ],
                ["path", "license", "score", "is_file"],
            )

    return found.join(weighed.hint("merge"), "id", "left").mapInArrow(
        judged, "path string, license string, score double, is_file boolean"
    )


def _directory(path: str):
    return F.regexp_replace(path, r"/?[^/]*$", "")


def license_scan(
    files: DataFrame,
    texts: Mapping[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """path, license, score, found and licensed_by, one row per distinct path.

    ``found`` says where the licence stands: header (a part of the file), file (the
    file is a licence file), directory (the licence file licensed_by in the nearest
    directory above), or none. Of several statements of a path or licence files of a
    directory the most similar counts, then the first path. Missing texts are empty.
    A missing path is a path of its own, in no directory. Other columns are not read.
    """
    texts = all_forms(TEMPLATES) if texts is None else texts
    counts = written(term_counts(files), "terms")
    wanted = ["", *sorted({w for t in texts.values() for w in terms(t)})]
    # One row for each term of the templates reaches the driver.
    df = {term: int(number) for term, number in counts.where(F.col("term").isin(wanted)).collect()}
    templates = Templates(texts, df, df.pop("", 0))
    found = written(candidates(files, templates, threshold), "statements")
    own = written(own_licenses(found, counts, templates, threshold), "licences")
    best = own.groupBy("path").agg(
        F.max_by(
            F.struct("license", "score", "is_file"),
            F.struct("score", "is_file", "license"),
        ).alias("own")
    )
    holders = (
        own.where("is_file AND path IS NOT NULL")
        .groupBy(_directory("path").alias("above"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("holder"))
        .hint("merge")
    )
    paths = files.select("path").distinct().withColumn("directory", _directory("path"))
    parts = F.split("directory", "/")
    # Every directory once, with those above it: as many rows as it is deep.
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
    inherited = (
        paths.where("directory IS NOT NULL")
        .select("directory")
        .distinct()
        .select("directory", F.explode(F.array_distinct(above)).alias("above"))
        .join(holders, "above")
        .groupBy("directory")
        .agg(F.max_by("holder", F.length("above")).alias("holder"))
        .hint("merge")
    )
    has_own = F.col("own").isNotNull()
    return (
        paths.join(inherited, "directory", "left")
        .join(
            best.withColumnRenamed("path", "own_path").hint("merge"),
            F.col("path").eqNullSafe(F.col("own_path")),
            "left",
        )
        .select(
            "path",
            F.when(has_own, F.col("own.license"))
            .otherwise(F.col("holder.license"))
            .alias("license"),
            F.when(has_own, F.col("own.score")).otherwise(-F.col("holder.s")).alias("score"),
            F.when(F.col("own.is_file"), "file")
            .when(has_own, "header")
            .when(F.col("holder").isNotNull(), "directory")
            .otherwise("none")
            .alias("found"),
            F.when(has_own, F.col("path"))
            .otherwise(F.col("holder.path"))
            .alias("licensed_by"),
        )
    )
