"""Exact and near duplicates against brute force, and the cases the docstrings name."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from llm_rows import given_docs, llm_spark, make_docs, rows_of, tricky_rows  # noqa: F401
from pyspark.sql import functions as F

from pyspark.sql import functions as F

from wakeline.llm import near_dedup
from wakeline.llm.components import components
from wakeline.llm.exact_dedup import digests, exact_duplicates, merged_runs, run_bits_of
from wakeline.llm.near_dedup import least_matches, near_duplicates


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append(i)
    found = set()
    for i, t in rows:
        ids = [x for x in groups[normalised(t)] if x is not None]
        keep = min(ids) if ids else None
        digest = hashlib.sha256(normalised(t).encode()).hexdigest()
        found.add((i, keep, len(groups[normalised(t)]), digest, i == keep))
    return sorted(found, key=str)


@pytest.mark.parametrize("run_bits", [1, 3, 6])
def test_exact_equals_grouping(make_docs, run_bits):
    rows = tricky_rows()
    result = exact_duplicates(make_docs(rows), run_bits)
    assert result.columns == ["doc_id", "keep_id", "group_size", "text_sha256", "kept"]
    assert sorted((tuple(r) for r in result.collect()), key=str) == exact_by_hand(rows)


def test_exact_of_nothing(make_docs):
    assert exact_duplicates(make_docs([])).collect() == []


def test_large_group_is_folded_before_it_moves(make_docs):
    docs = make_docs([(i, "same text" if i % 3 else f"text {i}") for i in range(600)])
    sizes = Counter(r.group_size for r in exact_duplicates(docs).collect())
    assert sizes == {400: 400, 1: 200}


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_by_hand(rows, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            for x in sets[a]:
                for y in sets[b]:
                    if a < b and x & y and 100 * len(x & y) >= percent * len(x | y):
                        low, high = sorted((top(a), top(b)))
                        parent[high] = low
    by_set = {}
    for i in ids:
        for x in sets[i]:
            by_set.setdefault(x, top(i))
    found = []
    for i, t in rows:
        x = shingles(t)
        component = (top(i) if i is not None else by_set.get(x)) if x else i
        found.append((i, len(x), component, i == component))
    return sorted(found, key=str)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_equals_all_pairs(make_docs, given_docs, percent):
    rows = tricky_rows()
    for doc_id, text in given_docs.select("doc_id", "text").limit(80).collect():
        words = text.split()
        for copy, step in enumerate((17, 23, 31, 47)):
            edited = ["zz" if n % step == 3 else w for n, w in enumerate(words[:400])]
            rows.append((1000 + doc_id * 10 + copy, " ".join(edited)))
    result = near_duplicates(make_docs(rows), percent)
    assert sorted((tuple(r) for r in result.collect()), key=str) == near_by_hand(rows, percent)


def test_near_links_without_the_centre(make_docs):
    """Members that fail against the most central one still meet each other."""
    base = [f"w{n}" for n in range(200)]
    rows = []
    for n in range(40):
        # Neighbours are similar, ends of the chain are not.
        rows.append((n, " ".join(base[n * 4 : n * 4 + 200] + [f"x{m}" for m in range(n * 4)])))
    result = near_duplicates(make_docs(rows), 80)
    assert sorted((tuple(r) for r in result.collect()), key=str) == near_by_hand(rows, 80)


@pytest.mark.parametrize("cluster", [1, 2048])
def test_near_of_clusters_in_blocks_and_by_bucket(make_docs, monkeypatch, cluster):
    """A base with copies at many distances, compared in small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "CLUSTER", cluster)
    words = [f"w{n}" for n in range(150)]
    rows = [(50, " ".join(words))]
    for n in range(40):
        edited = [f"x{n % 13}" if m % 150 in range(n, 4 * n, 9) else w for m, w in enumerate(words)]
        rows.append((n, " ".join(edited)))
    result = near_duplicates(make_docs(rows), 85)
    assert sorted((tuple(r) for r in result.collect()), key=str) == near_by_hand(rows, 85)


def test_near_of_nothing(make_docs):
    assert near_duplicates(make_docs([])).collect() == []
    assert rows_of(near_duplicates(make_docs([(1, None), (2, "")]))) == [
        (1, 0, 1, True),
        (2, 0, 2, True),
    ]


def test_pruning_bounds_grow_and_stay_below_the_threshold():
    for percent in (80, 85):
        bounds = least_matches(percent)
        assert list(bounds) == sorted(bounds)
        assert all(m < (step + 1) * 30 * percent / 100 for step, m in enumerate(bounds))


def test_components_of_paths_stars_and_loops(llm_spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)]
    edges += [(200, 200), (300, 301), (301, 300), (300, 301), (None, 5)]
    found = dict(tuple(r) for r in components(llm_spark.createDataFrame(edges, "a long, b long")).collect())
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 130)}
    assert found == expected | {300: 300, 301: 300}


def test_runs_are_sorted_and_merged_without_hashing_digests(make_docs):
    """Each level sends runs by number, sorts them and folds the sorted rows."""
    groups = merged_runs(
        digests(make_docs([(1, "a"), (2, "a")]))
        .withColumnRenamed("doc_id", "keep_id")
        .withColumns({"run": F.pmod("keep_id", F.lit(64)), "group_size": F.lit(1).cast("long")})
    )
    plan = re.sub(r"#\d+L?", "", groups._jdf.queryExecution().executedPlan().toString())
    assert plan.count("Exchange hashpartitioning(run, 64), REPARTITION_BY_NUM") == 4
    assert plan.count("Exchange") == 4
    assert plan.count("Sort [run ASC NULLS FIRST, digest ASC NULLS FIRST], false") == 4
    assert "HashAggregate" not in plan
    assert [(r.keep_id, r.group_size) for r in groups.collect()] == [(1, 2)]
    assert [run_bits_of(n) for n in (0, 10**6, 10**9, 3 * 10**10)] == [6, 6, 10, 15]


def test_rows_without_doc_id_come_after_all_others(make_docs):
    rows = [(None, "x  y"), (9, "x y"), (None, "x y"), (None, None), (None, "")]
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(make_docs(rows)).collect()}
    assert found == {(9, 9, 3, True), (None, 9, 3, False), (None, None, 2, True)}
