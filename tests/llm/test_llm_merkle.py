"""Document fingerprints against plain Python."""

import hashlib
import random
from collections import defaultdict

import plain
from pyspark.sql import functions as F

from mergewell.llm import merkle


def wanted(rows):
    """{(doc_id, text): result} by (doc_id, text) rows without rows that share an id but not the text."""
    order = sorted({(d is None, d or 0, t or "") for d, t in rows})
    out = {}
    for i, (missing, doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][2]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        found = None
        if plain.root(text) != plain.root(edited):
            a, b = plain.paragraphs(text), plain.paragraphs(edited)
            same = next((k for k in range(max(len(a), len(b))) if a[k:k + 1] != b[k:k + 1]))
            found = sum(map(len, a[:same]))
        out[None if missing else doc] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), plain.root(text), plain.root(edited),
            plain.likeness(text, edited), plain.likeness(text, following), found)
    return out


def check(df, rows):
    got = [tuple(r) for r in df.collect()]
    want = wanted(rows)
    assert len(got) == len(rows)
    for doc, *result in got:
        assert tuple(result) == want[doc], doc


def test_equals_plain_python(spark):
    random.seed(8)
    word = lambda: random.choice(["ab", "c.", "dé", "e!", "日本", "x" * 9, "f"])

    def text():
        space = [" ", " ", " ", "\n", "\n\n", "\t", "  "]
        return "".join(word() + random.choice(space) for _ in range(random.choice([0, 1, 3, 30, 200])))

    rows = [(i * 7 % 101, text()) for i in range(90)]
    rows += [(500, None), (501, ""), (502, " \n\n "), (503, "\n"), (504, "word " * 60_000), (505, "y" * 150_000),
             (506, "a" * 99 + ". " * 4000), (None, "no id " * 20)]
    rows += [(600 + i, "same text. of these\nrows") for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit("x")).withColumn(
        "mark", F.lit(1))
    check(merkle.fingerprints(frame.repartition(6)), rows)
    check(merkle.fingerprints(frame), rows)


def test_repeated_rows_and_few_rows(spark):
    schema = "doc_id long, text string"
    rows = [(1, "one two three four five six seven.\neight"), (2, "nine ten " * 30)] + [(1, "one two three four five six seven.\neight")] * 4
    check(merkle.fingerprints(spark.createDataFrame(rows, schema)), rows)
    check(merkle.fingerprints(spark.createDataFrame(rows[:1], schema)), rows[:1])
    assert merkle.fingerprints(spark.createDataFrame([], schema)).count() == 0
    two_texts = [(7, "first text of the id"), (7, "second text of the id"), (8, "third")]
    assert merkle.fingerprints(spark.createDataFrame(two_texts, schema)).count() == 3


def test_roots_are_those_of_plain_python_and_branches_locate_edits(spark):
    random.seed(9)
    rows = []
    for i in range(40):
        lines = [" ".join(f"w{random.randrange(500)}" for _ in range(12)) + "\n" for _ in range(random.randint(1, 40))]
        changed = list(lines)
        for _ in range(i % 4):
            at = random.randrange(len(changed))
            changed[at:at + 1] = random.choice([[], ["new line %d\n" % i], [changed[at], "put in %d\n" % i]])
        rows.append((i, "".join(lines), "".join(changed)))
    rows += [(90, None, ""), (91, None, "x\n"), (92, "a\nb\n", "b\na\n")]
    frame = spark.createDataFrame(rows, "k long, a string, b string")
    for r in frame.withColumn("root", merkle.tree(F.col("a"))["root"]).collect():
        assert r["root"] == plain.root(r["a"])
    found = defaultdict(set)
    for r in merkle.differing_branches(frame, "k", "a", "b").collect():
        found[r["k"], r["side"]].add((r["paragraph"], r["digest"], r["length"], r["section"]))
    for k, a, b in rows:
        mine, others = plain.paragraphs(a), plain.paragraphs(b)
        digests = lambda x: {hashlib.sha256(p.encode()).hexdigest() for p in x}
        got = {d for _, d, _, _ in found[k, "before"]}
        assert digests(mine) - digests(others) <= got <= digests(mine)
        if sorted(mine) == sorted(others) and mine == others:
            assert not found[k, "before"] and not found[k, "after"]
        for _, d, length, _ in found[k, "before"]:
            assert any(hashlib.sha256(p.encode()).hexdigest() == d and len(p) == length for p in mine)
        assert digests(others) - digests(mine) <= {d for _, d, _, _ in found[k, "after"]}


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    made = merkle.fingerprints(frame)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_are_shuffled_once(spark, tmp_path):
    """The shuffle of the texts is read by both joins."""
    spark.createDataFrame([(i, f"text {i} " * 50) for i in range(200)], "doc_id long, text string").write.parquet(
        str(tmp_path / "d"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = merkle.fingerprints(spark.read.parquet(str(tmp_path / "d")))
        made.collect()
        assert "ReusedExchange" in made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
