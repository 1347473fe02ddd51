"""Pages, vectors, conversations and the pipeline."""

import gzip
import hashlib
import os
import subprocess
import sys

import numpy as np
import plain
import public_tokenizers
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mergewell.llm import blocks, chat, html_text, mixing, neighbours, quality, warc
from mergewell.llm.queries import ORACLES, QUERIES
from mergewell.llm.scratch import Scratch

SMALL = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) == ""


# --- pages -------------------------------------------------------------------------------

def test_blocks_of_broken_pages():
    found = blocks.blocks_of(
        "<!DOCTYPE html><p>a&amp;b <b>c<br>d<p class='x y-z'>e&nbsp;&lt;<script>no <p></script> f"
        "<!-- <p>no --><ul><li>g<li><a href='>'>h</a> i</ul></div><td>&copy j<style>x")
    assert [b.text for b in found] == ["a&b c d", "e <", "f", "g", "h i", "© j"]
    assert found[1].path == ("p", ".x", ".y", ".z") and found[4].path == ("ul", "li")
    assert blocks.blocks_of(None) == [] and blocks.blocks_of("") == [] and blocks.blocks_of("<p") == []


@pytest.fixture(scope="module")
def labeller(spark):
    return html_text.fit_labeller(spark.read.parquet(f"{SMALL}/pages.parquet"))


@tables
def test_articles_of_pages_are_found_whole(spark, labeller):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").withColumn("text", F.lit("clash"))
    for r in html_text.extract_text(pages, labeller).collect():
        found = blocks.blocks_of(r["html"])
        assert r["text"] == "\n\n".join(b.text for b in found if "article" in b.path)
        assert r["n_chars"] == len(r["text"])


@tables
def test_unseen_layouts_are_labelled(labeller):
    random = np.random.default_rng(77)
    right = total = 0
    features = html_text.Features()
    for k in range(60):
        main = [f"Word{i} of line {k} " * int(random.integers(1, 9)) for i in range(random.integers(3, 12))]
        found = blocks.blocks_of(html_text.layout(random, main, [f"item {i}" for i in range(6)]))
        x, mask, _ = html_text.padded([(features.page(found), ())])
        guess = labeller.scores(x, mask)[0][:len(found)] > 0
        right += int((guess == np.array([b.label == "main" for b in found])).sum())
        total += len(found)
    assert right >= 0.97 * total


RIVERS = "The committee published its yearly report on rivers and lakes, and the water is cleaner than before. " * 2
TOWNS = "Several towns along the coast have closed their old plants, and new ones with better filters follow. " * 2
#: Hand-made pages that no layout of the training is like, with their article.
HELD_OUT = [
    ("<article><p>a &lt;b&gt; &amp;amp; c</p><p>x y z</p></article>", ["a <b> &amp; c", "x y z"]),
    ("<article><p>if a < b then c</p><p>5 <6 and more</p></article>", ["if a < b then c", "5 <6 and more"]),
    (f'<html><body><div class="x1"><p>{RIVERS}</p><p>{TOWNS}</p></div></body></html>', [RIVERS, TOWNS]),
    (f'<body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul></nav><div class="x1"><p>{RIVERS}</p>'
     f'<p>{TOWNS}</p></div><footer>Copyright 2020</footer></body>', [RIVERS, TOWNS]),
    ("<html><body><article><p>One.</p></article></body></html>", ["One."]),
    ('<body><nav><a href="/">Home</a></nav><main><h1>Title here</h1><p>Short text.</p></main><footer>Legal</footer></body>',
     ["Title here", "Short text."]),
    (f"<p>{RIVERS}</p>", [RIVERS]),
    (f'<article><p>{RIVERS}</p></article><section class="comments"><p>nice one</p></section>', [RIVERS]),
]


@tables
def test_short_bare_and_unnamed_pages_come_out_whole(labeller):
    """All but one at least: trained on the smallest table, a bare page in an unnamed container
    may lose a paragraph."""
    features = html_text.Features()
    whole = [html_text.main_text([page], labeller, features) == ["\n\n".join(x.strip() for x in article)]
             for page, article in HELD_OUT]
    assert sum(whole) >= len(HELD_OUT) - 1


@tables
def test_missing_empty_and_long_pages(spark, labeller):
    rows = [(1, None), (2, ""), (3, "<html><body></body></html>"), (4, "<article>" + "<p>word</p>" * 20_000 + "</article>"),
            (5, "<article><p>a</p></article>"), (5, "<article><p>a</p></article>"), (None, "no tags")]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, html string"), labeller).collect()
    by = {(r["page_id"], r["html"]): r["text"] for r in got}
    assert len(got) == len(rows)
    assert by[1, None] == by[2, ""] == by[3, rows[2][1]] == ""
    assert by[4, rows[3][1]].count("word") >= 19_990  # far longer than any page of the training
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract_text(empty, html_text.fit_labeller(empty)).count() == 0


# --- archives ----------------------------------------------------------------------------

def test_archives_round_trip_and_are_the_same_again(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 2_000)
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    long = "<p>" + "é€x" * 60_000 + "</p>"
    rows = [(i, f"http://a/{i}", "same page " * 40 if i % 3 == 0 else f"page {i} " * 30) for i in range(60)]
    rows += [(70, None, None), (71, "http://b/\r\n c", ""), (72, "u", "small"), (73, "u", "small"), (74, "u", long),
             (75, "u", long), (3, "http://a/3", "same page " * 40), (None, "n", "same page " * 40), (None, "n", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    scratch = Scratch(spark)
    contents = []
    for parts in (1, 4):
        folder = scratch.path("archives")
        manifest = warc.write_archives(warc.payloads(frame.repartition(parts)), folder, scratch)
        files = {r["name"]: r["sha256"] for r in manifest.collect()}
        base = folder.removeprefix("file:")
        for name, digest in files.items():
            data = open(f"{base}/{name}", "rb").read()
            assert hashlib.sha256(data).hexdigest() == digest and gzip.decompress(data).startswith(b"WARC/1.1")
        contents.append(files)
        got = warc.read_archives(manifest, folder).collect()
        assert len(got) == len(rows) and all(r["intact"] for r in got)
        for r in got:
            html = [h or "" for p, _, h in rows if p == r["page_id"]]
            payload = next(h.encode() for h in html if hashlib.sha256(h.encode()).hexdigest() == r["payload_digest"])
            equal = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
            to = min(equal) if len(payload) >= 100 and equal and min(equal) != r["page_id"] else None
            assert (r["payload_bytes"], r["refers_to"]) == (len(payload), to)
            assert r["record_type"] == ("response" if to is None else "revisit")
    assert contents[0] == contents[1] and len(contents[0]) > 3


def test_no_pages_make_no_archives(spark):
    scratch = Scratch(spark)
    folder = scratch.path("archives")
    pages = warc.payloads(spark.createDataFrame([], "page_id long, url string, html string"))
    manifest = warc.write_archives(pages, folder, scratch)
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0


# --- vectors -----------------------------------------------------------------------------

def exact(rows, k=20, every=20):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        other = ids != ids[i]
        scores = (matrix[other] * matrix[i]).sum(1)
        order = np.lexsort((ids[other], -scores))[:k]
        out[int(ids[i])] = [int(x) for x in ids[other][order]]
    return out


def test_neighbours_reach_their_recall(spark):
    random = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in random.normal(0, 1 + i % 3, 12)]) for i in range(3000)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = exact(rows)
    assert set(got) == set(want) and all(sorted(g) == list(range(1, 21)) for g in got.values())
    found = sum(len(set(g.values()) & set(want[q])) for q, g in got.items())
    assert found >= 0.9 * 20 * len(want)


def test_equal_unusable_and_few_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(200)] + [(300 + i, [0.0, float(i + 1)]) for i in range(5)]
    odd = [(400, None), (420, [0.0, 0.0]), (440, [1.0, None]), (460, [float("nan"), 1.0]), (480, [float("inf"), 1.0]),
           (500, [1.0]), (520, []), (None, [1.0, 1.0]), (0, [1.0, 0.5])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = {}
    for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == exact(rows)  # ties to the smaller id, with whole results
    few = neighbours.nearest(frame.filter("vec_id in (0, 1, 302)")).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in few] == [(0, 302, 1.5), (0, 1, 1.25)]
    assert neighbours.nearest(frame.limit(0)).count() == 0


# --- conversations -----------------------------------------------------------------------

def test_chat_is_read_back(spark):
    rows = [(1, 0, "user", "a \\ <s> [INST] \\5c; </s>"), (1, 1, "assistant", " [/INST] <<SYS>> x<"),
            (2, 0, "system", None), (2, 1, "user", ""), (2, 2, "assistant", "fine"), (2, 2, "assistant", "fine"),
            (3, 0, "tool", "[:] x [/ROLE]"), (3, 1, None, "y"), (4, None, "user", "first"), (4, 0, "assistant", "b" * 300_000),
            (None, 0, "user", "alone"), (None, 1, "assistant", "alone too"), (5, 0, "[ROLE] odd [:]", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    got = chat.read_back(chat.format_conversations(frame.repartition(4))).collect()
    conversations = {}
    for i, (conv, _, role, text) in enumerate(rows):
        conversations.setdefault(conv if conv is not None else ("alone", i), []).append((role or "", text or ""))
    want = []
    for key, turns in conversations.items():
        spoken = "".join(t for r, t in turns if r == "assistant")
        want.append((key if isinstance(key, int) else None, len(turns),
                     hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                     len(spoken), hashlib.sha256(spoken.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r["conv_id"], r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])) for r in got)
    assert {r["conv_id"]: r["valid"] for r in got if r["conv_id"]} == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_segments_out_of_order_are_refused(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {c} {t}") for c in range(4) for t in range(6)]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    with pytest.raises(Exception, match="order in which they were made"):
        chat.read_back(made.repartition(5, "text")).collect()


def test_control_strings_stand_only_where_the_template_puts_them():
    formatter = chat.Formatter(chat.Template())
    for text in ("</s>", "<<SYS>><</SYS>>", "[[INST]", "\\[/INST]", "<", "[:][ROLE]"):
        escaped = formatter.escape(text)
        assert formatter.unescape(escaped) == text
        assert not any(c in escaped for c in formatter.template.controls())


def test_templates_are_validated():
    with pytest.raises(ValueError):
        chat.Template(turns={"user": ("[U]", " [/U]")})


# --- pipeline ----------------------------------------------------------------------------

def plain_pipeline(spark, docs):
    """All stages but the outlier verdict and the mixing draw, which are the operators' own."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    kept = [r for r in quality.quality_rules(docs).collect() if r["kept"]]
    groups = plain.near_components([(r["doc_id"], r["text"]) for r in kept], percent=80, width=5)
    kept = [r for r, (n, low) in zip(kept, groups) if not n or r["doc_id"] == low]
    cut = plain.kept_spans([(r["doc_id"], r["text"]) for r in kept])
    rest = [(r["doc_id"], r["source"], cut[i][3], r["text"] if not cut[i][1] else None)
            for i, r in enumerate(kept) if not cut[i][1] or cut[i][3]]
    frame = spark.createDataFrame(
        [(d, s, " ".join(w)) for d, s, w, _ in rest], "doc_id long, source string, text string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(frame).collect()}
    out = []
    for doc, _, w, _ in rest:
        ids = library.encode(" ".join(w), add_special_tokens=False).ids
        out += [(doc, ids)] * copies[doc]
    return sorted(out)


@tables
def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted((r["doc_id"], r["ids"]) for r in QUERIES["pipeline"](spark, SMALL).collect())
    assert got == plain_pipeline(spark, docs)


def test_stages_keep_columns_and_bear_hard_rows(spark, hard_documents, no_documents):
    extra = hard_documents.withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(7)).withColumn(
        "a.b", F.lit(1)).withColumn("copies", F.lit(None).cast("string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, "")
        assert out.columns == extra.columns and out.schema["n_words"].dataType == extra.schema["n_words"].dataType
        assert {r["n_words"] for r in out.select("n_words").collect()} <= {"mine"}
        assert stage(spark, no_documents, "").count() == 0
    assert corpus_pipeline.encoding_stage(spark, extra, "").count() == hard_documents.count()


def test_letter_classes_take_little_memory():
    """The driver asks the library for them, beside all else it holds."""
    code = ("import resource as r, hashlib; from mergewell.llm.bpe import classes; peak = lambda: r.getrusage(r.RUSAGE_SELF).ru_maxrss;"
            "before = peak(); found = classes(); print(peak() - before, len(found.lower))")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                          cwd=os.path.dirname(os.path.abspath(corpus_pipeline.__file__)))
    kilobytes, lower = map(int, done.stdout.split())
    assert kilobytes < 100_000 and lower
