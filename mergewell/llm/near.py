"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures."""

from __future__ import annotations

import functools
import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.rows import SLICE, with_computed
from mergewell.llm.scratch import Scratch
from mergewell.llm.words import WordHashes, Windows, mixed, words_of
from mergewell.operators.redundancy import connected_components

CHUNK = 4  # positions of a signature in a chunk
BITS = 16  # kept of each minimum
ERRORS = 1  # allowed in a chunk
LEAST_CHUNKS = 8
MISSED = 4e-6  # of the pairs just at the threshold, at most
GROUP = 512  # members that one leader is compared with in one place
REMOVED_BITS = 1024  # of the sketch of the shingles that a member lacks of its leader's
BLOCK = 256  # members of a bucket that are compared in one place
BATCH = 4096  # lines of blocks that a task looks at together
PAIRS_AT_ONCE = 1 << 19
PAIRS_OF_A_TASK = 20_000_000
EDGES_OF_A_TASK = 1_000_000


def radius(chunks: int) -> int:
    """By pigeonhole, signatures that differ in at most this many positions share a key."""
    return chunks * (ERRORS + 1) - 1


@functools.cache
def chunks_for(percent: int) -> int:
    """Chunks of a signature so that sets with a similarity of `percent` differ in more than
    radius() positions with a probability of MISSED at most: 8 for 85, 12 for 80."""
    differ, chunks = 1 - percent / 100, LEAST_CHUNKS
    # Unless the expected share of errors is below that of the radius, more chunks do not help.
    if CHUNK * differ >= ERRORS + 1:
        raise ValueError(f"percent {percent}: signatures find similarities above 50 only")
    while True:
        n = chunks * CHUNK
        beyond = sum(comb(n, k) * differ**k * (1 - differ)**(n - k) for k in range(radius(chunks) + 1, n + 1))
        if beyond <= MISSED:
            return chunks
        chunks += 1


@functools.cache
def _hashes(chunks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Constants of the hash functions of a signature: flips, factors and weights of the keys."""
    random = np.random.default_rng(85)
    draw = lambda shape: random.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2)
    flip, factor, weight = draw(chunks * CHUNK), draw(chunks * CHUNK), draw((chunks, CHUNK))
    return flip, factor + np.uint64(1), weight + np.uint64(1)


def shingle_set(text: str | None, known: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of `width` words, A-Z in lower case."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    windows = Windows(known.of([w.lower() for w in words]))
    if len(words) < width:
        return windows.spans(np.zeros(1, np.int64), np.array([len(words)]))
    return np.unique(windows.of(width))


def signature(shingles: np.ndarray, chunks: int) -> np.ndarray:
    """Low bits of the minima of CHUNK * chunks hash functions over a set."""
    flip, factor, _ = _hashes(chunks)
    low = None
    for start in range(0, len(shingles), 4096):
        part = ((shingles[None, start:start + 4096] ^ flip[:, None]) * factor[:, None]).min(1)
        low = part if low is None else np.minimum(low, part)
    return (mixed(low) >> np.uint64(64 - BITS)).astype(np.uint16)


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """One key for every chunk and every position in it that may be wrong."""
    values = signature.reshape(-1, CHUNK).astype(np.uint64) + np.uint64(1)
    spread = mixed(values * _hashes(len(values))[2])
    left_out = spread.sum(1, dtype=np.uint64)[:, None] - spread
    place = np.arange(left_out.size, dtype=np.uint64).reshape(left_out.shape)
    return mixed(left_out + place * np.uint64(0x9E3779B97F4A7C15)).ravel()


def shingled(df: DataFrame, text: str, width: int, chunks: int) -> DataFrame:
    """df with n_shingles, set_a and set_b (128-bit identity of the set) and signature."""
    fields = [
        T.StructField("n_shingles", T.LongType()), T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()), T.StructField("signature", T.BinaryType())]

    def make():
        known = WordHashes()

        def compute(value):
            shingles = shingle_set(value, known, width)
            if not len(shingles):
                return 0, None, None, None
            digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
            a, b = np.frombuffer(digest, np.int64).tolist()
            return len(shingles), a, b, signature(shingles, chunks).tobytes()
        return compute

    return with_computed(df, [text], fields, make)


def _keys(sets: DataFrame) -> DataFrame:
    """(node, slot, key): all keys of all signatures, slot counts chunks and left-out places."""
    made = with_computed(
        sets.select("node", "signature"), ["signature"],
        [T.StructField("keys", T.ArrayType(T.LongType()))],
        lambda: lambda s: (chunk_keys(np.frombuffer(s, np.uint16)).view(np.int64),))
    return made.select("node", F.posexplode("keys").alias("slot", "key"))


_CHECKED = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("linked", T.BooleanType()), T.StructField("added", T.ArrayType(T.LongType())),
    T.StructField("removed", T.BinaryType())])


def _checked(pairs: DataFrame, alone: DataFrame | None, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (leader a, member b) with linked, whether their full sets overlap enough.

    Members meet their leader in groups of at most about GROUP: a leader with many members is
    sent to several groups, so that texts are moved once and no group is large.
    With `alone`, further nodes without leader, added holds the shingles of b that a lacks,
    removed is a bitmap of those of a that b lacks, and one more line per leader or lone node
    (b missing) holds its whole set.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    members = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), "parts").alias("part"), F.lit(1).alias("role"), F.col("b").alias("node"))
    every = sizes if alone is None else sizes.unionByName(
        alone.select(F.col("node").alias("a"), F.lit(1).cast("long").alias("parts")))
    leaders = every.select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("role"), F.col("a").alias("node"))
    rows = members.unionByName(leaders).join(texts, "node").select("a", "part", "role", "node", "text")
    differences = alone is not None

    def work(batches):
        known = WordHashes()
        leader, whole = None, None
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                out = []
                for a, role, node, text in zip(*[
                        batch.column(i).slice(first, SLICE).to_pylist() for i in (0, 2, 3, 4)]):
                    shingles = shingle_set(text, known, width)
                    if role == 0:
                        leader, whole = a, shingles
                        if differences:
                            out.append((a, None, False, shingles.view(np.int64), None))
                    elif leader == a:
                        place = np.minimum(np.searchsorted(whole, shingles), len(whole) - 1)
                        inside = whole[place] == shingles
                        both = int(inside.sum())
                        linked = 100 * both >= percent * (len(shingles) + len(whole) - both)
                        out.append((a, node, linked, *(
                            (shingles[~inside].view(np.int64), _bitmap(whole, place[inside]))
                            if differences else (None, None))))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.binary()))], names=_CHECKED.names)

    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "role").mapInArrow(work, _CHECKED)


def _bitmap(whole: np.ndarray, present: np.ndarray) -> bytes:
    """Bits of the shingles in `whole` that are not present: as many as are set are missing at
    least, and so for the union of two bitmaps."""
    gone = np.ones(len(whole), bool)
    gone[present] = False
    bits = np.zeros(REMOVED_BITS, bool)
    bits[(whole[gone] >> np.uint64(40)) % np.uint64(REMOVED_BITS)] = True
    return np.packbits(bits).tobytes()


def _own_shingles(checked: DataFrame) -> DataFrame:
    """(node, own): at least so many shingles of a member no other node has.

    A shingle of any node is among what it adds to its leader, or belongs to a leader further
    up; so one that is added once and belongs to no leader's or lone node's set is unique.
    """
    added = checked.select(F.col("b").alias("node"), F.explode("added").alias("shingle"))
    once = added.groupBy("shingle").agg(
        F.sum(F.when(F.col("node").isNull(), 2).otherwise(1)).alias("n"), F.min("node").alias("node"))
    return once.filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_SIDE = ["key", "block", "role", "slot", "node", "component", "minor", "size", "shared", "leader", "leader_size",
         "spare", "removed", "signature"]


def _block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components within radius() that may be linked, from buckets
    in blocks.

    rows: key, slot, n (members of the bucket), minors (those outside its commonest component,
    so that every pair of components holds one), minor, node, component, size, shared (shingles
    that another node may have), leader, leader_size, spare (shingles that the leader lacks and
    another node may have), removed, signature.

    Members stay in one of their bucket's blocks of about BLOCK; only minor ones go to all blocks
    and meet the members there, so rows grow with n plus the minors of a block.  A task goes
    through its blocks in order and compares all pairs of a batch at once.  A pair counts in the
    first of its buckets only.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    members = rows.withColumns({"block": F.pmod(F.xxhash64("node"), blocks), "role": F.lit(0)})
    probes = rows.filter("minor").withColumns({
        "block": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)), "role": F.lit(1)})
    placed = members.select(*_SIDE).unionByName(probes.select(*_SIDE))
    buckets = rows.groupBy("key").agg(F.first("n").alias("n"), F.first("minors").alias("minors"))
    work_load = buckets.agg(F.sum(F.col("n") * F.col("minors")).alias("n")).first()["n"] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(100_000, max(least, work_load // PAIRS_OF_A_TASK))

    def work(batches):
        held = None  # members of the block that the last batch ended in
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                new = _columns(whole.slice(start, BATCH))
                held, found = _compared(held, new, percent)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.min(1)), pa.array(found.max(1))], names=_LINK.names)

    ordered = placed.repartition(parts, "key", "block").sortWithinPartitions("key", "block", "role")
    return ordered.mapInArrow(work, _LINK).distinct()


def _columns(batch) -> dict:
    out = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if name in ("removed", "signature"):
            raw, kind = b"".join(column.to_pylist()), np.uint64 if name == "removed" else np.uint16
            out[name] = np.frombuffer(raw, kind).reshape(batch.num_rows, -1)
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def _compared(held: dict | None, new: dict, percent: int) -> tuple[dict | None, np.ndarray]:
    """Members of the last block so far, and the (probe, member) pairs of the new lines."""
    x = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
    fresh = 0 if held is None else len(held["node"])
    lines = len(x["node"])
    start = np.ones(lines, bool)
    start[1:] = (x["key"][1:] != x["key"][:-1]) | (x["block"][1:] != x["block"][:-1])
    opened = np.maximum.accumulate(np.where(start, np.arange(lines), 0))  # the block's first line
    member = x["role"] == 0
    count = np.cumsum(member)  # members come before probes
    low = count[opened] - member[opened]
    place = np.flatnonzero(member)
    found = []
    probes = np.flatnonzero(~member)
    probes = probes[probes >= fresh]
    sizes = count[probes] - low[probes]
    ends = np.cumsum(sizes)
    first = 0
    while first < len(probes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS_AT_ONCE, "right")))
        k = np.repeat(probes[first:last], sizes[first:last])
        begun = np.repeat(ends[first:last] - sizes[first:last], sizes[first:last]) - (ends[first - 1] if first else 0)
        h = place[low[k] + np.arange(len(k)) - begun] if len(k) else k
        found.append(_possible(x, k, h, percent))
        first = last
    rest = np.flatnonzero(member & (opened == opened[-1])) if lines else np.zeros(0, np.int64)
    return {c: v[rest] for c, v in x.items()} if len(rest) else None, np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _possible(x: dict, k: np.ndarray, h: np.ndarray, percent: int) -> np.ndarray:
    """The pairs of lines k and h that no bound rules out, as nodes."""
    # Of two minor nodes the later one is left to the first.
    keep = (x["component"][k] != x["component"][h]) & (~x["minor"][h] | (x["node"][k] < x["node"][h]))
    k, h = k[keep], h[keep]
    both_sizes = x["size"][k] + x["size"][h]
    most = np.minimum(x["shared"][k], x["shared"][h])
    keep = 100 * most >= percent * (both_sizes - most)
    k, h, both_sizes = k[keep], h[keep], both_sizes[keep]
    wrong = x["signature"][k] != x["signature"][h]
    keep = wrong.sum(1) <= radius(wrong.shape[1] // CHUNK)
    k, h, both_sizes, wrong = k[keep], h[keep], both_sizes[keep], wrong[keep]
    if len(k):
        keep = _first_slot(wrong) == x["slot"][k]
        k, h, both_sizes = k[keep], h[keep], both_sizes[keep]
    # Two members of one leader share at most what neither lacks of it, and the smaller of their
    # spare shingles.
    lacking = np.bitwise_count(x["removed"][k] | x["removed"][h]).sum(1, dtype=np.int64)
    both = x["leader_size"][k] - lacking + np.minimum(x["spare"][k], x["spare"][h])
    keep = (x["leader"][k] != x["leader"][h]) | (100 * both >= percent * (both_sizes - both))
    return np.stack([x["node"][k[keep]], x["node"][h[keep]]], 1)


def _first_slot(wrong: np.ndarray) -> np.ndarray:
    """The first slot whose key two signatures share, from the places in which they differ."""
    chunks = wrong.reshape(len(wrong), -1, CHUNK)
    errors = chunks.sum(2)
    chunk = (errors <= ERRORS).argmax(1)
    line = np.arange(len(wrong))
    place = np.where(errors[line, chunk] == 0, 0, chunks[line, chunk].argmax(1))
    return chunk * chunks.shape[2] + place


def components(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85,
) -> DataFrame:
    """(doc_id, version, n_shingles, component_id, kept): one line per row of df.

    Rows are linked when 100 * shared >= percent * all of their distinct shingles of `width`
    words; component_id is the smallest doc_id that links reach.

    1. Rows with equal sets become one node, with the smallest id among them.
    2. Nodes meet in the buckets of the multi-index: one key per chunk of the signature and
       per position of it that may be wrong, so that no pair within radius() is missed.
    3. Every node is checked on full sets against the leader that most of its buckets name: a
       bucket's leader is the member that meets most others in all its buckets.
    4. Where a bucket still holds several components, its signatures are compared in blocks.
       Pairs of different components within radius() are checked on full sets as well, unless
       the shingles that one of them shares with no other node already rule a link out.

    A missing or blank text has no shingles and is linked with nothing: its component is its
    own id.  A missing id counts as larger than any other; component_id is missing only if
    all ids of the component are, and such rows are kept.  Repeated rows get equal values; of
    rows with the same smallest id all are kept.  An empty table gives an empty result.  Whole
    texts are shingled, whatever their length; other columns of df are not looked at, so their
    names cannot clash.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = scratch.write(shingled(
        df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"),
                  F.col(text).alias("text")), "text", width, chunks_for(percent)).drop("text"), "rows")
    sets = scratch.write(
        rows.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("low"), F.min("version").alias("version"),
            F.first("signature").alias("signature"), F.first("n_shingles").alias("size"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")

    keys = scratch.write(_keys(sets), "keys")
    buckets = scratch.write(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    shared = scratch.write(keys.join(buckets, "key"), "shared")
    scratch.drop(keys, buckets)
    degrees = scratch.write(shared.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    wanted = degrees.join(sets, "node").select("node", F.col("version").alias("text_version"))
    versions = df.select(F.xxhash64(text).alias("text_version"), F.col(text).alias("text"))
    texts = scratch.write(versions.join(wanted, "text_version").groupBy("node").agg(
        F.first("text").alias("text")), "texts")

    # Leaders come first in the order of falling degree, then node: no circle is possible.
    first = F.struct("degree", (-F.col("node")).alias("minus"))
    ranked = scratch.write(shared.select("key", "node").join(degrees, "node"), "ranked")
    leaders = scratch.write(ranked.groupBy("key").agg(F.max(first).alias("leader")), "leaders")
    votes = ranked.join(leaders, "key").filter(first < F.col("leader")).groupBy("node", "leader").agg(
        F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("node").agg(F.max(F.struct("votes", "leader")).alias("best"))
    pairs = scratch.write(best.select((-F.col("best.leader.minus")).alias("a"), F.col("node").alias("b")), "pairs")
    alone = degrees.select("node").join(pairs, degrees["node"] == pairs["b"], "left_anti").join(
        pairs.select("a").distinct(), F.col("node") == F.col("a"), "left_anti")
    checked = scratch.write(_checked(pairs, alone, texts, width, percent), "checked")
    links = checked.filter("linked").select("a", "b")
    members = scratch.write(_roots(links, sets, scratch), "members")
    scratch.drop(ranked, leaders)

    follows = checked.filter("b is not null").select(
        F.col("b").alias("node"), F.col("a").alias("leader"), F.size("added").alias("added"), "removed")
    leading_sizes = sets.select(F.col("node").alias("leader"), F.col("size").alias("leader_size"))
    follows = follows.join(leading_sizes, "leader")
    leading = pairs.select(F.col("a").alias("node")).distinct().withColumn("leads", F.lit(True))
    possible = scratch.write(
        degrees.select("node").join(members, "node").join(sets.select("node", "size", "signature"), "node")
        .join(_own_shingles(checked), "node", "left").join(leading, "node", "left").join(follows, "node", "left")
        .withColumn("spare", F.coalesce(F.col("added"), F.lit(0)) - F.when(F.col("leads"), 0).otherwise(
            F.coalesce("own", F.lit(0))))
        .withColumn("leader", F.coalesce("leader", "node"))
        .withColumn("leader_size", F.coalesce("leader_size", "size"))
        .withColumn("removed", F.coalesce("removed", F.lit(bytes(REMOVED_BITS // 8))))
        .withColumn("shared", F.col("size") - F.when(F.col("leads"), 0).otherwise(F.coalesce("own", F.lit(0))))
        .filter(100 * F.col("shared") >= percent * F.col("size"))
        .select("node", "component", "size", "shared", "leader", "leader_size", "spare", "removed", "signature"),
        "possible")
    places = scratch.write(shared.select("key", "slot", "node").join(
        possible.select("node", "component"), "node"), "places")
    held = places.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed_up = held.groupBy("key").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts")).filter(
        "parts > 1").select("key", "n", (F.col("n") - F.col("most.n")).alias("minors"),
                            F.col("most.component").alias("commonest"))
    rest = places.drop("component").join(mixed_up, "key").join(possible, "node").withColumn(
        "minor", F.col("component") != F.col("commonest"))
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = scratch.write(_block_pairs(rest, percent).join(tried, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        again = scratch.write(_checked(more, None, texts, width, percent).filter("linked").select("a", "b"), "again")
        if not again.isEmpty():
            members = scratch.write(_joined(again, members, scratch), "members")
    scratch.drop(shared, texts, pairs, checked, possible, places)

    lowest = sets.join(members, "node").groupBy("component").agg(F.min("low").alias("component_id"))
    labelled = scratch.write(sets.join(members, "node").join(lowest, "component").select(
        "set_a", "set_b", "component_id"), "labels")
    out = rows.join(labelled, ["set_a", "set_b"], "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "version", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _roots(links: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of all nodes when every node b is linked to one leader a at most:
    each node looks its leader's leader up until the top is reached."""
    up = links.select(F.col("b").alias("component"), F.col("a").alias("above"))
    now = scratch.write(links.select(F.col("b").alias("node"), F.col("a").alias("component")), "roots")
    while True:
        higher = now.join(up, "component", "left").select(
            "node", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved"))
        before, now = now, scratch.write(higher, "roots")
        scratch.drop(before)
        if now.filter("moved").isEmpty():
            return sets.select("node").join(now, "node", "left").select(
                "node", F.coalesce("component", "node").alias("component"))


def _forest(edges: DataFrame, count: int) -> DataFrame:
    """Edges (a, b) with the same components, fewer of them: each task keeps those of its
    EDGES_OF_A_TASK edges that join two sets for the first time, less than it has nodes."""

    def work(batches):
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            kept = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    kept.append((a, b))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*kept)], names=_LINK.names)

    return edges.repartition(max(8, -(-count // EDGES_OF_A_TASK))).mapInArrow(work, _LINK)


def _joined(links: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """members after links between nodes of different components."""
    a = members.select(F.col("node").alias("a"), F.col("component").alias("x"))
    b = members.select(F.col("node").alias("b"), F.col("component").alias("y"))
    edges = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    edges = scratch.write(edges, "edges")
    merged = connected_components(_forest(edges, edges.count())).select(
        F.col("node").alias("component"), F.col("component").alias("whole"))
    return members.join(merged, "component", "left").select(
        "node", F.coalesce("whole", "component").alias("component"))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of df that stay: those of each component with its smallest id."""
    kept = components(df, doc_id, text, **how).filter("kept").select(
        F.col("doc_id").alias("__doc"), F.col("version").alias("__version")).distinct()
    return df.join(kept, F.col(doc_id).cast("long").eqNullSafe(F.col("__doc"))
                   & F.xxhash64(text).eqNullSafe(F.col("__version")), "left_semi")
