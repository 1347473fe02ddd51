"""Document fingerprints: a Merkle tree over paragraphs and sections, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mergewell.llm.scratch import Scratch

#: A paragraph is a line with the line breaks that end it; joined, paragraphs are the text.
PARAGRAPH = r"[^\n]*\n+|[^\n]+"
#: Up to six words of one line, fewer where a sentence ends.
PHRASE = (r"(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\x09\x0B-\x0D]+){0,5}[^\x20\x09-\x0D]+")
#: A section ends with a paragraph whose digest begins so: one in four, wherever it stands.
SECTION_END = ("0", "1", "2", "3")


def tree(text: Column) -> Column:
    """struct(root, sections) of a text; sections hold digest and paragraphs, those digest and
    length (code points).

    A paragraph's digest is that of its text, a section's that of its paragraphs' digests, the
    root that of the sections'.  Where sections end depends on their own paragraphs only, so an
    edit changes the branch it is in and leaves the others.  A missing text has the tree of an
    empty one: no sections.
    """
    lines = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    leaves = F.transform(lines, lambda p: F.struct(
        F.sha2(p, 256).alias("digest"), F.length(p).cast("long").alias("length")))

    def ends(leaves):
        """Places (from 1) of the paragraphs that end a section."""
        return F.filter(F.transform(leaves, lambda p, i: F.when(
            (i + 1 == F.size(leaves)) | F.substring(p["digest"], 1, 1).isin(*SECTION_END), i + 1)),
            lambda i: i.isNotNull())

    def rooted(leaves):
        return _with(ends(leaves), lambda ends: _rooted(F.transform(ends, lambda end, k: _section(
            F.slice(leaves, _before(ends, k) + 1, end - _before(ends, k))))))

    return _with(leaves, rooted)


def _with(value: Column, use) -> Column:
    """use(value), with the value computed once: as the element of an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(ends: Column, k: Column) -> Column:
    return F.when(k == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(k, F.lit(1))))


def _section(paragraphs: Column) -> Column:
    digest = F.sha2(F.array_join(F.transform(paragraphs, lambda p: p["digest"]), ""), 256)
    return F.struct(digest.alias("digest"), paragraphs.alias("paragraphs"))


def _rooted(sections: Column) -> Column:
    return _with(sections, lambda s: F.struct(
        F.sha2(F.array_join(F.transform(s, lambda x: x["digest"]), ""), 256).alias("root"), s.alias("sections")))


def phrases(text: Column) -> Column:
    """Distinct 32-bit hashes of a text's phrases: what equal parts of differing paragraphs share."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PHRASE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.hash(x)))


def likeness(root: Column, marks: Column, other_root: Column, other_marks: Column) -> Column:
    """1 for equal roots, else the Dice coefficient of the phrases, 0 if both have none."""
    both = F.size(F.array_intersect(marks, other_marks))
    all_ = F.size(marks) + F.size(other_marks)
    return F.when(root == other_root, 1.0).when(all_ == 0, 0.0).otherwise(2.0 * both / all_)


def first_edit(a: Column, b: Column) -> Column:
    """Code points of tree a before the first paragraph in which tree b differs from it; null for
    equal roots.  From the root the first differing section is entered, there the first differing
    paragraph; a whole branch is passed over by its digest."""
    def same(x, y):
        return F.coalesce(F.array_position(F.transform(
            F.arrays_zip(F.transform(x, lambda s: s["digest"]).alias("x"), F.transform(y, lambda s: s["digest"]).alias("y")),
            lambda z: F.coalesce(z["x"] == z["y"], F.lit(False))), F.lit(False)), F.lit(0)).cast("int")

    def chars(paragraphs):
        return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda n, p: n + p["length"])

    none = F.array().cast("array<struct<digest:string,length:bigint>>")
    section = same(a["sections"], b["sections"])  # from 1
    before = F.aggregate(F.slice(a["sections"], 1, section - 1), F.lit(0).cast("long"),
                         lambda n, s: n + chars(s["paragraphs"]))
    inside = F.coalesce(F.get(a["sections"], section - 1)["paragraphs"], none)
    other = F.coalesce(F.get(b["sections"], section - 1)["paragraphs"], none)
    paragraph = same(inside, other)
    return F.when(a["root"] != b["root"], before + chars(F.slice(inside, 1, F.greatest(paragraph - 1, F.lit(0)))))


def paragraphs_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section, paragraph, section_digest, digest, length): the leaves of all trees, one row
    each, with their section's digest; places count from 0."""
    made = df.select(F.col(key).alias(key), tree(F.col(text))["sections"].alias("sections"))
    sections = made.select(key, F.posexplode("sections").alias("section", "s"))
    return sections.select(key, "section", F.col("s.digest").alias("section_digest"),
                           F.posexplode("s.paragraphs").alias("paragraph", "p")).select(
        key, "section", "paragraph", "section_digest", "p.digest", "p.length")


def differing_branches(df: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """Paragraphs of either of two texts per row that the other lacks: where the edits are.

    (key, side, section, paragraph, digest, length), side `before` or `after`.  Sections that both
    have drop out by their digests, paragraphs of the others by theirs.  Missing texts have no
    paragraphs; rows that repeat a key are taken together; equal texts give no rows.
    """
    def lacking(mine, others):
        open_ = mine.join(others.select(key, "section_digest").distinct(), [key, "section_digest"], "left_anti")
        closed = others.join(mine.select(key, "section_digest").distinct(), [key, "section_digest"], "left_anti")
        return open_.join(closed.select(key, "digest").distinct(), [key, "digest"], "left_anti")

    a, b = paragraphs_of(df, key, before), paragraphs_of(df, key, after)
    columns = ["section", "paragraph", "digest", "length"]
    return lacking(a, b).select(key, F.lit("before").alias("side"), *columns).unionByName(
        lacking(b, a).select(key, F.lit("after").alias("side"), *columns))


def _neighbours(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(id0, missing, mark, n_chars, next_id0, next_missing, next_mark): each document and the one
    after it, the first after the last.  Only ids, hashes and lengths are sorted."""
    order = ["missing", "id0", "mark"]
    placed = scratch.write(
        rows.select("id0", "missing", "mark", "n_chars").distinct().repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "order")
    part = F.shiftright("__id", 33)  # the partition, below it the row
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    # One line per partition.
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
                           F.sum("__n").over(W.orderBy("__part").rowsBetween(
                               W.unboundedPreceding, W.unboundedFollowing)).alias("__total"))
    place = F.col("__offset") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = scratch.write(placed.withColumn("__part", part).join(offsets, "__part").select(
        "id0", "missing", "mark", "n_chars", place.alias("place"), "__total"), "places")
    after = numbered.select(
        "place", *[F.col(c).alias(f"next_{c}") for c in ("id0", "missing", "mark")])
    first = numbered.withColumn("place", (F.col("place") + 1) % F.col("__total"))
    return first.join(after, "place").drop("place", "__total")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edit_found): the Merkle root of every text and of its edited form, in which the last quarter
    is replaced by the beginning of the next document (by id; after the last comes the first).

    near_edited and near_next are likenesses to the edited text and to the next document;
    edit_found is where the trees first differ (see first_edit).

    A document's own text is shuffled once and that shuffle is read twice: its beginning, as long
    as the document before needs, goes to that document, with its root and phrase hashes.

    A missing text is an empty one.  Missing ids come last; documents with one id follow each
    other in the order of a hash of their texts; repeated rows are one document and get the same
    values.  A single document is its own next one.  Texts are never cut; columns of other names
    are ignored; an empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession)
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        value.alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id0"),
        F.col(doc_id).isNull().alias("missing"), F.xxhash64(value).alias("mark"),
        F.length(value).cast("long").alias("n_chars"))
    keys = ["id0", "missing", "mark"]
    order = scratch.write(_neighbours(rows, scratch), "neighbours")

    whole = rows.select(*keys, "text")  # the same columns in both uses, so that one shuffle serves them
    wanted = order.select(
        *[F.col(f"next_{c}").alias(c) for c in keys], *[F.col(c).alias(f"to_{c}") for c in keys],
        F.expr("CAST(n_chars div 4 AS INT)").alias("cut"))
    sent = whole.join(wanted, keys).select(
        *[F.col(f"to_{c}").alias(c) for c in keys], F.expr("substring(text, 1, cut)").alias("beginning"),
        F.unhex(tree(F.col("text"))["root"]).alias("next_root"), phrases(F.col("text")).alias("next_marks"))
    # Repeated rows send the same thing several times.
    sent = sent.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("beginning", "next_root", "next_marks")])
    both = whole.join(sent, keys)
    length = F.length("text")
    kept = F.expr("substring(text, 1, CAST(length(text) - length(text) div 4 AS INT))")
    both = both.select(
        F.when(~F.col("missing"), F.col("id0")).alias("doc_id"), "text", length.cast("long").alias("n_chars"), F.concat(kept, F.col("beginning")).alias("edited"),
        "next_root", "next_marks")
    both = both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("a"),
        tree(F.col("edited")).alias("b"), phrases(F.col("text")).alias("m"), phrases(F.col("edited")).alias("e"),
        "next_root", "next_marks")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", F.col("a.root").alias("fingerprint"),
        F.col("b.root").alias("edited_fingerprint"),
        likeness(F.col("a.root"), F.col("m"), F.col("b.root"), F.col("e")).alias("near_edited"),
        likeness(F.unhex("a.root"), F.col("m"), F.col("next_root"), F.col("next_marks")).alias("near_next"),
        first_edit(F.col("a"), F.col("b")).alias("edit_found"))
