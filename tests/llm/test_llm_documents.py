"""Document operators against plain Python, on hard cases and on the small tables."""

import hashlib
import os
from collections import Counter

import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mergewell.llm import bpe, mixing, near, quality, spans, toxicity
from mergewell.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def table_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def check_spans(got, rows):
    want = plain.kept_spans(pairs(rows))
    expected = Counter((rows[i][0], *w[:3]) for i, w in want.items())
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == expected


def test_substring_dedup_on_hard_rows(hard_documents, hard_rows):
    got = spans.dedup_spans(hard_documents.withColumn("factors", F.lit(1))).collect()
    check_spans(got, hard_rows)
    for r in got:
        assert plain.words(r["kept_text"]) == plain.words(r["text"]) if not r["n_removed"] else (
            len(plain.words(r["kept_text"])) == r["n_words"] - r["n_removed"])
        for f in r["factors"] or ():
            assert f["length"] >= 50 and f["ref"] < r["doc_id"]
    assert sum(r["n_removed"] > 0 for r in got) > 10


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_substring_dedup_on_documents(spark):
    check_spans(QUERIES["op9_substring_dedup"](spark, SMALL).collect(), table_rows(spark))


def test_factors_follow_the_reference():
    found = [{"start": 0, "windows": 3, "ref": 1, "at": 10}, {"start": 3, "windows": 2, "ref": 1, "at": 13},
             {"start": 5, "windows": 1, "ref": 2, "at": 0}]
    assert spans.factors_of(found, 50) == [
        {"start": 0, "length": 54, "ref": 1, "at": 10}, {"start": 5, "length": 50, "ref": 2, "at": 0}]


def check_near(got, rows):
    want = plain.near_components(pairs(rows))
    expected = Counter((doc, n, doc if not n else low) for (doc, *_), (n, low) in zip(rows, want))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_near_duplicates_on_hard_rows(hard_documents, hard_rows):
    check_near(near.components(hard_documents).collect(), hard_rows)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_near_duplicates_on_documents(spark):
    check_near(QUERIES["op8_near_duplicates"](spark, SMALL).collect(), table_rows(spark))


def test_chain_of_near_copies_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(12):  # neighbours are linked, far ones are not
        rows.append((step, " ".join(words)))
        for k in range(4):
            words[(step * 16 + k * 4) % 200] = f"new{step}x{k}"
    check_near(near.components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_bucket_blocks_find_links_that_leaders_miss(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "GROUP", 2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(25):
        copy = list(base)
        for k in range(i % 6):
            copy[(i * 31 + k * 13) % 150] = f"x{i}y{k}"
        rows.append((i, " ".join(copy)))
    check_near(near.components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def check_statistics(got, rows):
    expected = Counter((r[0], *plain.statistics(r[1])) for r in rows)
    assert Counter((r["doc_id"], *[r[s] for s in quality.STATISTICS]) for r in got) == expected
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_on_hard_rows(hard_documents, hard_rows):
    got = quality.quality_rules(hard_documents.withColumn("distance", F.lit("x"))).collect()
    check_statistics(got, hard_rows)
    assert Counter((r["doc_id"], r["kept"]) for r in got) == Counter(
        (r["doc_id"], r["kept"]) for r in quality.quality_rules(hard_documents, drop_text=True).collect())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_quality_on_documents(spark):
    check_statistics(QUERIES["op10_quality"](spark, SMALL).collect(), table_rows(spark))


def test_outliers_are_rejected_and_plain_texts_kept(spark):
    import random

    random.seed(1)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(random.randint(30, 200))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "***" for _ in range(60)), "en", "s") for i in range(40)]
    rows += [(2000 + i, " ".join(word() * 9 for _ in range(60)), "en", "s") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(frame).collect()}
    assert all(kept[i] for i in range(300))
    assert not any(kept[i] for i in kept if i >= 1000)


def test_bpe_equals_the_library(hard_documents):
    library = Tokenizer.from_file(VOCABULARY)
    more = ["<|endoftext|>it's <|startoftext|>", "<|endoftext", "ΟΔΟΣ ς", "a\x1cb 12½", "  ", "naïve e\u0301", "I'll DON'T 've"]
    frame = hard_documents.select("text").union(
        hard_documents.sparkSession.createDataFrame([(t,) for t in more], "text string"))
    for r in bpe.encode_decode(frame.withColumn("ids", F.lit("clash")), VOCABULARY).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_every_code_point_is_classed_as_the_library_does():
    """Letters, numbers and lower case are the library's, whatever Python's Unicode version."""
    encoder = bpe.WordBpe(open(VOCABULARY, "rb").read())
    library = Tokenizer.from_file(VOCABULARY)
    points = [*range(0x20, 0xD800), *range(0xE000, 0x20000, 1), *range(0x20000, 0x110000, 5003), *range(0x1C, 0x20)]
    for start in range(0, len(points), 40):
        text = "".join(f"a{chr(p)}b {chr(p)} 1" for p in points[start:start + 40])
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(points[start])


def test_every_token_spells_itself():
    encoder = bpe.WordBpe(open(VOCABULARY, "rb").read())
    library = Tokenizer.from_file(VOCABULARY)
    texts = [t.removesuffix("</w>") for t in library.get_vocab()][::7]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_mixing_on_hard_rows(hard_documents, hard_rows):
    mixed = mixing.mix(hard_documents.withColumn("copies", F.lit("x"))).cache()
    got = mixed.collect()
    assert len(got) == len(hard_rows)
    sizes = Counter()
    for r in hard_rows:
        sizes[r[3]] += len(plain.words(r[1]))
    targets = {r["source"]: r["target"] for r in got}
    assert {r["source"]: r["source_size"] for r in got} == dict(sizes)
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6
    for r in got:
        assert r["size"] == len(plain.words(r["text"])) and 0 <= r["copies"] <= 3
        rate = r["target"] / r["source_size"]
        assert int(rate) <= r["copies"] <= int(rate) + 1
    again = mixing.mix(hard_documents.repartition(3)).collect()
    assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in got)
    assert mixing.repeated(mixed).count() == sum(r["copies"] for r in got)


def test_mixing_reshares_what_exceeds_three_times_a_source(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), ("d", 1), (None, 5)]
    got = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    # a and d (weight 5) and the missing source (weight 2) stop; b and c share the rest 2 : 1.
    assert got["a"] == 30.0 and got["d"] == 3.0 and got[None] == 15.0
    assert abs(got["b"] - 2 * got["c"]) < 1e-9 and abs(got["b"] + got["c"] - (2016 - 48)) < 1e-9


def test_toxicity_orders_grades_and_holds_on_unseen_texts(spark):
    import random

    random.seed(2)
    plain_words = [f"word{i}" for i in range(600)]
    bad = ["awful", "nasty", "vile", "horrid"]

    def text(hits):
        w = [random.choice(plain_words) for _ in range(random.randint(20, 120))]
        return " ".join(w + [random.choice(bad) for _ in range(hits)])

    rows = [(i, text(0 if i % 4 else random.randint(2, 9)), int(i % 4 == 0)) for i in range(1200)]
    rows += [(None, text(3), 1), (5000, None, 0), (5001, "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_severity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert list(model.thresholds) == sorted(model.thresholds)
    unseen = [(i, text(0 if i % 2 else 2 + i % 8), int(i % 2 == 0)) for i in range(300)] + [(-1, None, 0), (-2, "", 0)]
    scored = toxicity.score_severity(
        spark.createDataFrame(unseen, "doc_id long, text string, toxic int").withColumn("truth", F.col("toxic")), model)
    got = scored.collect()
    assert sum(r["toxic"] == bool(r["truth"]) for r in got) >= 0.97 * len(got)
    assert all(0 <= r["severity"] <= toxicity.GRADES for r in got)
    strong = toxicity.score_severity(spark.createDataFrame(
        [(1, "word1 awful"), (2, "word1 " + "awful nasty vile horrid " * 6)], "doc_id long, text string"), model)
    weak, strong = [r["severity"] for r in strong.orderBy("doc_id").collect()]
    assert weak < strong


def test_one_kind_of_label_gives_one_answer(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit_severity(frame, frame.select("doc_id", F.lit(0).alias("toxic")))
    assert {r["toxic"] for r in toxicity.score_severity(frame, model).collect()} == {False}


def test_empty_tables(no_documents):
    assert spans.dedup_spans(no_documents).count() == 0
    assert near.components(no_documents).count() == 0
    assert near.drop_near_duplicates(no_documents).count() == 0
    assert quality.quality_rules(no_documents).count() == 0
    assert mixing.repeated(mixing.mix(no_documents)).count() == 0
    assert bpe.encode_decode(no_documents, VOCABULARY).count() == 0
    model = toxicity.fit_severity(no_documents, no_documents.withColumn("toxic", F.lit(1)))
    assert toxicity.score_severity(no_documents, model).count() == 0
