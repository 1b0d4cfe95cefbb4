"""Periodic runs, fingerprints and fill-in-middle against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import given_docs, llm_spark, make_docs, tricky_rows  # noqa: F401
from pyspark.sql import functions as F

from wakeline.llm import fill_in_middle as middle
from wakeline.llm import fingerprints as prints
from wakeline.llm import queries
from wakeline.llm.periodic_runs import find_runs, periodic_runs, previous_lower
from wakeline.llm.tables import utf8

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


def runs_by_hand(words, min_length=24, min_exponent=3):
    """Each period's maximal stretches; the smallest period of a stretch counts."""
    best = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, min_exponent * q):
                best.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed_by_hand(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


pieces = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9))


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(pieces, max_size=8), min_size=1, max_size=4),
    st.sampled_from([(24, 3), (2, 2), (5, 2), (9, 3), (1, 4)]),
)
def test_runs_of_texts_that_lie_one_behind_the_other(texts, bounds):
    texts = [[w for unit, times in text for w in unit * times] for text in texts]
    starts = np.cumsum([0, *map(len, texts)])
    found = find_runs(np.array(sum(texts, []), np.int64), starts, *bounds)
    expected = [
        (start + s, start + s + length, q)
        for start, text in zip(starts.tolist(), texts, strict=False)
        for s, length, q in runs_by_hand(text, *bounds)
    ]
    assert list(zip(*(x.tolist() for x in found), strict=True)) == expected


@pytest.mark.parametrize("or_equal", [True, False])
def test_previous_lower(or_equal):
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 7, 64, 65, 200):
        values = rng.integers(0, 6, size)
        places = np.arange(size)
        expected = [
            max((p for p in range(k) if values[p] < values[k] + or_equal), default=-1)
            for k in range(size)
        ]
        assert previous_lower(values.copy(), places, or_equal).tolist() == expected


def tricky_with_runs():
    rng = random.Random(3)
    words = ["x", "Y", "日本", "z z", "é"]
    texts = ["a " * 30, " a\n" * 24 + "b", "a " * 23, "p q r " * 8 + "p q", "p q r " * 7]
    for _ in range(60):
        unit = [rng.choice(words) for _ in range(rng.randint(1, 9))]
        text = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(text + unit * rng.randint(2, 12) + text))
    return tricky_rows() + list(enumerate(texts, 100))


def test_periodic_runs_of_tricky_rows(make_docs):
    rows = tricky_with_runs()
    expected = []
    for i, t in rows:
        words = WORD.findall(t or "")
        runs = runs_by_hand(words) if len(words) < 5000 else []
        expected.append((i, len(words), runs, collapsed_by_hand(words, runs)))
    found = [
        (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in periodic_runs(make_docs(rows)).collect()
    ]
    assert as_sorted(found) == as_sorted(expected)
    assert sum(len(r[2]) for r in found) > 40


def test_runs_of_a_long_text_with_large_periods(make_docs):
    rng = random.Random(1)
    unit = [f"w{rng.randint(0, 300)}" for _ in range(4000)]
    words = ["start"] + unit * 3 + unit[:17] + ["end"] + ["x"] * 5000
    row = periodic_runs(make_docs([(1, " ".join(words))])).collect()[0]
    runs = [tuple(r) for r in row.runs]
    assert runs == [(1, 12_017, 4000), (12_019, 5000, 1)]
    assert row.collapsed == collapsed_by_hand(words, runs)


def test_the_query_of_periodic_runs(llm_spark, given_docs):
    expected = []
    for i, t in given_docs.select("doc_id", "text").collect():
        words = WORD.findall(t or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        if n > 2500:
            continue
        runs = runs_by_hand(words)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * top[1] // top[2] if runs else None
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected.append((i, len(runs), *top, milli, sha(lines), sha(collapsed_by_hand(words, runs))))
    found = queries.op11_periodic_runs(llm_spark, SF)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    ]
    found = {r.doc_id: tuple(r) for r in found.collect()}
    assert len(found) == given_docs.count()
    assert [found[r[0]] for r in expected] == expected
    assert sum(r[1] for r in expected) > 5


def test_entropy_classes_by_hand():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 9, 400).astype(np.uint8)
    data[100:140] = 7
    found = prints.entropy_classes(data)
    assert len(found) == 400 - prints.WIDTH + 1
    for i, value in enumerate(found.tolist()):
        share = np.bincount(data[i : i + prints.WIDTH]) / prints.WIDTH
        share = share[share > 0]
        entropy = -(share * np.log2(share)).sum() / np.log2(prints.WIDTH)
        assert abs(value - entropy * 1000) <= 1.01
    assert len(prints.entropy_classes(data[:15])) == 0


def test_entropy_ranks_count_every_window(make_docs, llm_spark):
    texts = [t for _, t in tricky_rows()]
    docs = make_docs(list(enumerate(texts))).repartition(3)
    total = np.zeros(prints.CLASSES, int)
    for t in texts:
        classes = prints.entropy_classes(np.frombuffer((t or "").encode(), np.uint8))
        total += np.bincount(classes, minlength=prints.CLASSES)
    ranks = prints.entropy_ranks(docs)
    assert sorted(ranks.tolist()) == list(range(prints.CLASSES))
    by_rank = total[np.argsort(ranks)]
    assert (np.diff(by_rank) >= 0).all() and by_rank[-1] > 1000


def features_by_hand(data, ranks):
    """Windows of one text, the lowest of each row, the popular ones in order."""
    values = np.frombuffer(data, np.uint8)
    hashes = prints.mixed(prints.window_hashes(prints.byte_values()[values], prints.WIDTH))
    classes = prints.entropy_classes(values)
    keys = [(int(ranks[c]), int(h) >> 42, i) for i, (c, h) in enumerate(zip(classes, hashes))]
    short = len(keys) < prints.SHORT
    row, needed = (prints.ROW // 4, prints.POPULAR // 4) if short else (prints.ROW, prints.POPULAR)
    votes = Counter(min(keys[i : i + row])[2] for i in range(max(len(keys) - row, 0) + 1) if keys)
    needed = min(needed, max(votes.values(), default=0))
    return list(dict.fromkeys(int(hashes[i]) for i in sorted(votes) if votes[i] >= needed))


def test_selected_features_by_hand(given_docs):
    texts = [r.text or "" for r in given_docs.limit(60).collect()]
    texts += ["", "a" * 2000, "ab" * 10, "abc", "日本" * 40, "x" * 15, "y" * 16, texts[0]]
    ranks = np.random.default_rng(1).permutation(prints.CLASSES)
    import pyarrow as pa

    starts, data = utf8(pa.array(texts))
    text, feature = prints.selected_features(starts, data, ranks)
    assert (np.diff(text) >= 0).all()
    for i, t in enumerate(texts):
        found = feature[text == i].tolist()
        if len(t.encode()) >= prints.FEW:
            assert found == features_by_hand(t.encode(), ranks)
        assert bool(found) == bool(t)
    assert feature[text == 0].tolist() == feature[text == len(texts) - 1].tolist()


def chains(rows):
    """Filters and bounds of chains given as lists of feature numbers."""
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = prints.mixed(np.array(sum(rows, []), np.uint64))
    return prints.filter_chains(text, feature, len(rows))


def test_likeness():
    full, half = list(range(1, 1001)), list(range(1, 501)) + list(range(5001, 5501))
    other, few = list(range(9001, 10_001)), [1, 2, 3]
    filters, bounds = chains([full, half, other, few, [], full])
    pairs = {(0, 5): 1, (0, 0): 1, (0, 1): 0.5, (0, 2): 0, (2, 3): 0, (3, 0): 1, (4, 4): 1, (4, 0): 0}
    one, two = (np.array(side) for side in zip(*pairs, strict=True))
    found = prints.likeness(filters, bounds, one, two)
    assert np.abs(found - list(pairs.values())).max() < 0.05
    assert prints.likeness(filters, bounds, two, one).tolist() == found.tolist()


@pytest.mark.parametrize("partitions", [1, 5])
def test_fingerprints_of_tricky_rows(make_docs, llm_spark, partitions):
    rows = tricky_rows()
    before = llm_spark.conf.get("spark.sql.shuffle.partitions")
    llm_spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        docs = make_docs(rows).repartition(4)
        found = prints.fingerprints(docs, prints.entropy_ranks(docs)).collect()
    finally:
        llm_spark.conf.set("spark.sql.shuffle.partitions", before)
    placed = sorted(((i, t or "") for i, t in rows if i is not None))
    expected = [
        (i, len(t), t[: len(t) - len(t) // 4] + placed[(k + 1) % len(placed)][1][: len(t) // 4])
        for k, (i, t) in enumerate(placed)
    ]
    expected += [(None, len(t or ""), (t or "")[: len(t or "") - len(t or "") // 4])
                 for i, t in rows if i is None]
    assert as_sorted((r.doc_id, r.n_chars, r.edited) for r in found) == as_sorted(expected)
    for r in found:
        assert (r.near_next is None) == (r.doc_id is None)
        assert 0 <= r.near_edited <= 1 and 0 <= (r.near_next or 0) <= 1
        count, _, body = r.fingerprint.partition(":")
        assert len(base64.b64decode(body)) == int(count) * prints.BITS // 8
    texts = dict(placed)
    assert len({r.fingerprint for r in found if texts.get(r.doc_id) == texts[1]}) == 1
    assert next(r.near_next for r in found if r.doc_id == 1) == 1.0
    assert next(r.near_next for r in found if r.doc_id == 13) > 0.95


def test_fingerprints_tell_edited_texts_from_other_ones(llm_spark, given_docs):
    found = queries.op12_fingerprints(llm_spark, SF).collect()
    assert len(found) == given_docs.count()
    longer = [r for r in found if r.n_chars >= 64]
    assert min(r.near_edited for r in longer) > 0.3
    assert sorted(r.near_next for r in longer)[int(0.95 * len(longer))] < 0.05


def test_one_document_and_none(make_docs):
    docs = make_docs([(7, "abcdefgh" * 40)])
    row = prints.fingerprints(docs, prints.entropy_ranks(docs)).collect()[0]
    assert row.near_next == 1.0 and row.edited == "abcdefgh" * 40
    docs = make_docs([])
    assert prints.fingerprints(docs, prints.entropy_ranks(docs)).collect() == []
    assert periodic_runs(docs).collect() == []
    assert middle.fill_in_middle(middle.draws(docs, 7), 100, 50).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5000), min_size=1, max_size=60), min_size=1, max_size=6),
       st.sampled_from([0, 1, 127, 10_000]))
def test_learned_index_gives_every_place(steps, max_error):
    sequences = [np.cumsum(s) for s in steps]
    places = np.concatenate(sequences)
    bounds = np.cumsum([0, *map(len, sequences)])
    index = middle.learned_index(places, bounds, max_error)
    assert index.places(np.arange(len(places))).tolist() == places.tolist()
    assert np.abs(index.residual.astype(int)).max() <= max_error


def test_learned_index_of_even_lines_is_one_piece():
    index = middle.learned_index(np.arange(0, 90_001, 90), np.array([0, 1001]))
    assert len(index.rank) == 1 and not index.residual.any()


def middle_by_hand(i, t, percent=100, spm_percent=50, seed=7):
    t = t or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    digest = sha(f"{seed}:{'' if i is None else i}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not t or re.search("<[PSM]>", t) or h[2] % 100 >= percent:
        return (i, n, "plain", None, None, t)
    sizes = len(prefix), len(mid)
    if h[3] % 100 < spm_percent:
        return (i, n, "spm", *sizes, f"<S>{suffix}<P>{prefix}<M>{mid}")
    return (i, n, "psm", *sizes, f"<P>{prefix}<S>{suffix}<M>{mid}")


@pytest.mark.parametrize("percent", [100, 60])
def test_fill_in_middle(make_docs, given_docs, percent):
    extra = ["\n", "\n\n\n", "a\n", "a\nb", "<P>\nx", "x<M>", "<p>\n<s>", "é\n日本\n👍\n" * 50, "\r\n\x85y\n"]
    rows = tricky_rows() + list(enumerate(extra, 200))
    rows += [(i, "l\n" * (i % 7) + "é" * i) for i in range(300, 380)]
    rows += [tuple(r) for r in given_docs.select("doc_id", "text").collect()]
    found = middle.fill_in_middle(middle.draws(make_docs(rows), 7), percent, 50)
    restored = middle.restored_text(F.col("output"), F.col("form"))
    found = found.withColumn("restored", restored).collect()
    assert as_sorted(tuple(r)[:6] for r in found) == as_sorted(
        middle_by_hand(i, t, percent) for i, t in rows
    )
    assert Counter(r.restored for r in found) == Counter(t or "" for _, t in rows)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
