"""The near-duplicate stage of the pipeline: five words, a similarity of 0.8 or more."""

import os
import random

import corpus_pipeline
import plain
import pytest

from mergewell.llm import near

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def stays(rows, width, percent):
    """Ids that stay, by comparing all pairs of (doc_id, text) rows."""
    sets = [plain.shingles(text, width) for _, text in rows]
    low = {doc: doc for doc, _ in rows}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(a), root(rows[j][0])))
                low[y] = x
    return sorted(doc for doc, _ in rows if root(doc) == doc)


def test_near_duplicate_stage_drops_copies_with_a_fifth_appended_inserted_or_cut(spark):
    random.seed(11)
    rows = []
    for i in range(30):
        base = [f"b{i}w{k}" for k in range(200)]
        more = [f"b{i}x{k}" for k in range(44)]
        copy = (base + more, base[:90] + more + base[90:], base[:166], base + more + more)[i % 4]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    want = stays(rows, 5, 80)
    assert len(want) < len(stays(rows, 3, 85))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOCUMENTS)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted(r["doc_id"] for r in got.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_near_duplicate_stage_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())
    assert got == stays([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)


def test_signatures_follow_the_threshold():
    assert [near.chunks_for(p) for p in (100, 85, 80)] == [8, 8, 12]
    assert near.chunks_for(75) > near.chunks_for(80)
    with pytest.raises(ValueError):
        near.chunks_for(50)
