"""Operators that look at the whole corpus, the pipeline, and the registration."""

import math
from collections import Counter

import numpy as np
import pytest
from llm_rows import given_docs, llm_spark, make_docs, rows_of, tricky_rows  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from wakeline.llm import resampling
from wakeline.llm.licenses import TEMPLATES, Templates, license_scan, terms
from wakeline.llm.queries import registered

SF = "/root/testdata/sf0.001"


def cosine_by_hand(text, template, df, count):
    idf = lambda w: math.log((1 + count) / (1 + df.get(w, 0))) + 1
    a, b = Counter(terms(text)), Counter(terms(template))
    dot = sum(a[w] * b[w] * idf(w) ** 2 for w in b)
    norm = lambda v: math.sqrt(sum((n * idf(w)) ** 2 for w, n in v.items()))
    return dot / (norm(a) * norm(b)) if a else 0.0


def test_cosine():
    df = {"the": 90, "license": 5, "version": 7, "mit": 3}
    templates = Templates(TEMPLATES, df, 100)
    for text in ("released under the MIT License.", "the license of the version", "none", "the"):
        score, name = templates.best(terms(text))
        by_hand = {n: cosine_by_hand(text, t, df, 100) for n, t in TEMPLATES.items()}
        assert score == pytest.approx(max(by_hand.values()), abs=1e-8)
        assert by_hand[name] == pytest.approx(score, abs=1e-8)


def test_license_scan(llm_spark):
    prose = "Words of a text that has nothing to say of its terms. " * 5
    rows = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/x.txt", prose), ("a/b/y.txt", prose), ("a/b/c/z.txt", prose + "\nAll rights reserved."),
        ("a/b/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/d/e/f/deep.txt", prose), ("q/none.txt", prose), ("q/none.txt", prose),
        ("q/empty.txt", None), (None, "Licensed under CC BY-NC 4.0."), ("ab/x.txt", ""),
        ("top.txt", prose.replace(". ", ".\n") + "Licensed under the Apache License, Version 2.0."),
    ]
    files = llm_spark.createDataFrame([(*r, "x", "y") for r in rows], "path string, text string, license string, directory string")
    found = {r.path: (r.license, r.found, r.licensed_by) for r in license_scan(files).collect()}
    assert found == {
        "a/LICENSE": ("MIT", "file", "a/LICENSE"),
        "a/x.txt": ("MIT", "directory", "a/LICENSE"),
        "a/b/y.txt": ("MIT", "directory", "a/LICENSE"),
        "a/b/c/z.txt": ("Proprietary", "header", "a/b/c/z.txt"),
        "a/b/d/COPYING": ("GPL-3.0", "file", "a/b/d/COPYING"),
        "a/b/d/e/f/deep.txt": ("GPL-3.0", "directory", "a/b/d/COPYING"),
        "q/none.txt": (None, "none", None),
        "q/empty.txt": (None, "none", None),
        None: ("CC-BY-NC-4.0", "file", None),
        "ab/x.txt": (None, "none", None),
        "top.txt": ("Apache-2.0", "header", "top.txt"),
    }
    assert license_scan(files.limit(0)).collect() == []


def test_license_lines_of_the_given_documents(llm_spark):
    found = registered()["op1_license_scan"](llm_spark, SF)
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    notice = r"(?m)^(Licensed under |This work is licensed|Released under the|All rights reserved)"
    stated = {r.doc_id for r in docs.where(F.col("text").rlike(notice)).collect()}
    assert {r.doc_id for r in found.collect() if r.found in ("header", "file")} == stated
    assert found.count() == docs.count()


def test_importance_weights(make_docs, given_docs):
    target = given_docs.where("doc_id % 3 = 0")
    rows = tricky_rows() + [tuple(r) for r in given_docs.select("doc_id", "text").collect()]
    docs = make_docs(rows)

    def grams(text):
        words = (text or "").encode().lower().split()
        return Counter(words) + Counter(zip(words, words[1:], strict=False))

    # Bucket numbers come from the operator; counts and sums are made anew.
    def counts(texts):
        total = np.zeros(resampling.BUCKETS, np.int64)
        for text in texts:
            buckets, _ = resampling.ngrams(*_utf8([text]))
            assert len(buckets) == sum(grams(text).values())
            np.add.at(total, buckets, 1)
        return total

    raw = counts(t for _, t in rows)
    wanted = counts(r.text for r in target.collect())
    ratio = resampling.log_ratio(wanted, raw)
    found = resampling.importance_sample(docs, target, 0.4).collect()
    expected = sorted(ratio[resampling.ngrams(*_utf8([t]))[0]].sum() for _, t in rows)
    assert sorted(r.log_weight for r in found) == pytest.approx(expected, abs=1e-6)
    keys = sorted((r.gumbel_key for r in found), reverse=True)
    least = keys[math.ceil(0.4 * len(rows)) - 1]
    assert all(r.selected == (r.gumbel_key >= least) for r in found)


def _utf8(texts):
    import pyarrow as pa

    from wakeline.llm.tables import utf8

    return utf8(pa.array(texts, pa.string()))


def test_importance_sample_without_target_or_rows(make_docs, given_docs):
    empty = make_docs([])
    assert resampling.importance_sample(empty, empty, 0.5).collect() == []
    found = resampling.importance_sample(make_docs(tricky_rows()), empty, 0.0).collect()
    assert len(found) == len(tricky_rows()) and not any(r.selected for r in found)


def test_kth_largest(llm_spark):
    values = [5, -3, 2**62, 5, -(2**63), 2**63 - 1, 0, 5, -1]
    table = llm_spark.createDataFrame([(v,) for v in values], "v long")
    for k, value in enumerate(sorted(values, reverse=True), 1):
        assert resampling.kth_largest(table, "v", k) == value
    assert resampling.kth_largest(table, "v", 0) is None
    assert resampling.kth_largest(table, "v", 10) is None


def test_pipeline_stages(make_docs, llm_spark):
    docs = make_docs(tricky_rows())
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(llm_spark, docs, SF)
        if name != "best-fit packing":
            assert docs.columns == before.columns
        assert docs.count() <= before.count() or name == "best-fit packing"
    assert docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm_spark, make_docs([]), SF).collect() == []


def test_pipeline_equals_its_stages_by_hand(llm_spark):
    from test_llm_exact_near import exact_by_hand, near_by_hand
    from test_llm_texts import by_hand_removed, tokenizer

    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    judged = registered()["op8_quality_rules"](llm_spark, SF).where("kept")
    good = {r.doc_id for r in judged.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    keep = {r[0] for r in exact_by_hand(rows) if r[4]}
    rows = [r for r in rows if r[0] in keep]
    keep = {r[0] for r in near_by_hand(rows, corpus_pipeline.NEAR_PERCENT) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    library, expected = tokenizer("word_bpe_49k.json"), []
    for doc_id, data, gone in by_hand_removed(rows):
        text = np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        size = len(library.encode(text, add_special_tokens=False).ids) + 1
        expected += [
            (doc_id, n, n * 4096, min(4096, size - n * 4096)) for n in range(-(-size // 4096))
        ]
    found = corpus_pipeline.pipeline(llm_spark, SF)
    assert rows_of(found.select("doc_id", "piece", "start", "length")) == sorted(expected)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for number in range(1, 11):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and "op3_exact_dedup" in __spark_entry__.oracle_sql()
