"""Substring dedup: relative Lempel-Ziv parsing against blocks of all other documents."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.rows import SLICE, with_computed
from mergewell.llm.scratch import Scratch
from mergewell.llm.words import WordHashes, Windows, words_of

SPAN = 50  # words of the shortest duplicate
GRAM = 20  # words of an anchor; every window of SPAN words holds SPAN - GRAM + 1 of them


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` grams the place of its smallest, the first one of equals."""
    count = len(grams) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(grams, width).argmin(1) + np.arange(count)


def blocks_of(hashes: np.ndarray, span: int, gram: int):
    """(anchor hash, content hash, first window, windows) of each block of a text.

    A block is a run of windows with the same anchor.  Equal windows have equal anchors, so
    a window can only occur in blocks with its anchor's hash, in whatever document.
    """
    windows = Windows(hashes)
    grams = windows.of(gram)
    anchor = anchors(grams, span - gram + 1)
    if not len(anchor):
        return None
    starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    counts = np.diff(np.concatenate((starts, [len(anchor)])))
    content = windows.spans(starts, counts + span - 1)
    # Where in the block its anchor lies belongs to its content.
    content = content ^ (anchor[starts] - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return grams[anchor[starts]], content, starts, counts


_BLOCK = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("content", T.LongType()),
    T.StructField("doc", T.LongType()), T.StructField("version", T.LongType()),
    T.StructField("start", T.IntegerType()), T.StructField("windows", T.IntegerType())])
_WINDOW = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("content", T.LongType()),
    T.StructField("window", T.LongType()), T.StructField("place", T.IntegerType()),
    T.StructField("doc", T.LongType()), T.StructField("at", T.IntegerType())])


def _rows(kind: T.StructType, columns: list) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "int": pa.int32()}
    arrays = [pa.array(np.ascontiguousarray(c).view(np.int64) if f.dataType.simpleString() == "bigint"
                       else c.astype(np.int32), types[f.dataType.simpleString()])
              for c, f in zip(columns, kind)]
    return pa.RecordBatch.from_arrays(arrays, names=kind.names)


def index_blocks(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """All blocks of all texts; texts: doc, version, text."""

    def work(batches):
        known = WordHashes()
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                out = []
                for doc, version, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                    found = blocks_of(known.of(words_of(text)), span, gram)
                    if found is None:
                        continue
                    anchor, content, starts, counts = found
                    n = len(starts)
                    out.append((anchor, content, np.full(n, doc), np.full(n, version), starts, counts))
                if out:
                    yield _rows(_BLOCK, [np.concatenate(c) for c in zip(*out)])

    return texts.select("doc", "version", "text").mapInArrow(work, _BLOCK)


def windows_of(wanted: DataFrame, span: int = SPAN) -> DataFrame:
    """All windows of the wanted blocks; wanted: doc, text, blocks(anchor, content, start, windows)."""

    def work(batches):
        known = WordHashes()
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE // 8):
                batch = whole.slice(first, SLICE // 8)
                out = []
                for doc, text, blocks in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                    hashes = Windows(known.of(words_of(text))).of(span)
                    anchor, content, start, count = (
                        np.array([b[k] for b in blocks], np.int64)
                        for k in ("anchor", "content", "start", "windows"))
                    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.repeat(start, count) + place
                    out.append((np.repeat(anchor, count), np.repeat(content, count), hashes[at],
                                place, np.full(len(at), doc), at))
                if out:
                    yield _rows(_WINDOW, [np.concatenate(c) for c in zip(*out)])

    return wanted.select("doc", "text", "blocks").mapInArrow(work, _WINDOW)


def duplicate_factors(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM,
) -> DataFrame:
    """(doc, version, factors) of the documents that repeat a window of `span` words that
    starts in a document with a smaller id; factors: array of (start, length, ref, at) in words.

    Relative Lempel-Ziv parsing on all documents at once.  The reference is every document,
    cut into content-defined blocks: runs of windows with the same anchor, the smallest hash
    of a shorter gram.  The index holds, for each block content, its first place (smallest
    id, then position).  A document is parsed greedily into the longest factors of blocks
    that follow each other in their reference too.  Blocks whose content is new are checked
    window by window, at the factor boundaries, against all blocks with the same anchor.
    What survives the first look at the anchors (found in more than one document) is in
    proportion to the repeated text; nothing pairs documents with each other.
    """
    texts = df.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("version"),
        F.col(text).alias("text"))
    scratch = Scratch(df.sparkSession)
    every = scratch.write(index_blocks(texts, span, gram), "blocks")
    shared = scratch.write(every.groupBy("anchor").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("anchor"))
    blocks = scratch.write(every.join(shared, "anchor", "left_semi"), "shared")
    scratch.drop(every, shared)

    # The index: the first place of each block content.
    index = scratch.write(blocks.groupBy("anchor", "content").agg(
        F.min(F.struct("doc", "start", "version", "windows")).alias("first")), "index")
    placed = scratch.write(blocks.join(index, ["anchor", "content"]).select(
        *blocks.columns, F.col("first.doc").alias("ref"), F.col("first.start").alias("at")), "placed")
    scratch.drop(blocks)
    seen = placed.filter("ref < doc").select("doc", "version", "start", "windows", "ref", "at")

    # Boundaries: contents that are new where they first occur, under anchors with several.
    several = index.groupBy("anchor").agg(
        F.min("content").alias("a"), F.max("content").alias("b")).filter("a < b").select("anchor")
    doubtful = index.join(several, "anchor", "left_semi").select("anchor", "content", "first.*")
    lists = scratch.write(doubtful.groupBy("doc", "version").agg(
        F.collect_list(F.struct("anchor", "content", "start", "windows")).alias("blocks")), "lists")
    wanted = texts.join(lists, ["doc", "version"])
    windows = scratch.write(windows_of(wanted, span).distinct(), "windows")
    earliest = scratch.write(windows.groupBy("anchor", "window").agg(
        F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last"))
        .filter("first.doc < last").select("anchor", "window", "first"), "earliest")
    again = windows.join(earliest, ["anchor", "window"]).filter("first.doc < doc").select(
        "anchor", "content", "place", F.col("first.doc").alias("ref"), F.col("first.at").alias("at"))
    # A content's windows are judged where it first occurs; its later places are seen anyway.
    # Places in other versions of that same id are judged like it.
    edges = placed.filter("ref = doc").select(
        "anchor", "content", "doc", "version", "start").join(again, ["anchor", "content"]).select(
        "doc", "version", (F.col("start") + F.col("place")).alias("start"),
        F.lit(1).alias("windows"), "ref", "at")
    found = seen.unionByName(edges).groupBy("doc", "version").agg(
        F.collect_list(F.struct("start", "windows", "ref", "at")).alias("found"))
    out = scratch.write(with_computed(
        found, ["found"], [T.StructField("factors", T.ArrayType(_FACTOR))],
        lambda: lambda rows: (factors_of(rows, span),)).drop("found"), "factors")
    scratch.drop(index, placed, lists, windows, earliest)
    return out


_FACTOR = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()),
    T.StructField("ref", T.LongType()), T.StructField("at", T.IntegerType())])


def factors_of(found: list[dict], span: int) -> list[dict]:
    """Longest factors: pieces that go on where the one before ends, here and in the reference."""
    out: list[dict] = []
    for piece in sorted(found, key=lambda r: (r["start"], -r["windows"], r["ref"], r["at"])):
        start, count, ref, at = piece["start"], piece["windows"], piece["ref"], piece["at"]
        last = out[-1] if out else None
        if last is not None and last["ref"] == ref and at - start == last["at"] - last["start"] \
                and start <= last["start"] + last["length"] - span + 1:
            last["length"] = max(last["length"], start + count + span - 1 - last["start"])
        else:
            out.append({"start": start, "length": count + span - 1, "ref": ref, "at": at})
    return out


def dedup_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN,
) -> DataFrame:
    """df with n_words, n_removed, kept_sha256, factors and kept_text.

    Every word is removed that lies in a window of `span` words which also starts in a
    document with a smaller id.  kept_text is the text without the removed words and the
    white space before them; a text that loses nothing stays as it is.  kept_sha256 is that
    of the kept words joined by one blank.  A missing text has no words and stays missing; rows without id
    neither lose words nor serve as reference; rows with the same id do not remove each
    other's words; an empty table stays empty; a column that is named like a result is replaced.
    """
    df = df.drop("n_words", "n_removed", "kept_sha256", "factors", "kept_text")
    found = duplicate_factors(df, doc_id, text, span).select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), "factors")
    joined = df.join(found, (F.col(doc_id).cast("long") == F.col("__doc"))
                     & (F.xxhash64(text) == F.col("__version")), "left").drop("__doc", "__version")
    fields = [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())]
    return with_computed(joined, [text, "factors"], fields, lambda: cut_out)


def cut_out(text: str | None, factors: list[dict] | None):
    """(n_words, n_removed, digest of the kept words, kept text) of one text."""
    words = words_of(text)
    gone = np.zeros(len(words) + 1, np.int64)
    for factor in factors or ():
        gone[factor["start"]] += 1
        gone[factor["start"] + factor["length"]] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    removed = int(gone.sum())
    kept = [w for w, g in zip(words, gone) if not g] if removed else words
    digest = hashlib.sha256(b" ".join(kept)).hexdigest()
    if not removed:
        return len(words), 0, digest, text
    raw, place, pieces = text.encode("utf-8", "surrogatepass"), 0, []
    for word, g in zip(words, gone):
        start = raw.index(word, place)
        end = start + len(word)
        if not g:
            pieces.append(raw[place:end])
        place = end
    pieces.append(raw[place:])
    rest = b"".join(pieces).decode("utf-8", "surrogatepass")
    return len(words), removed, digest, rest.strip() if not kept else rest.lstrip("\n ") if gone[0] else rest
