"""Approximate nearest neighbours: hierarchical k-means tree, best bin first."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from mergewell.llm.scratch import Scratch

FIT_ROWS = 20_000  # vectors, chosen by hash, that the tree is fitted on
CALIBRATION_QUERIES = 200  # chosen by hash, searched against all rows
RECALL = 0.95  # that the calibration queries must reach
BRANCHES = 16
LEAF_ROWS = 16  # fitted vectors in a leaf at most
BLOCK_ROWS = 20_000  # vectors of one branch that are compared in one place
SEARCHES = 256  # queries whose leaves one task looks up
ROUNDING = 1e-9  # products within this of the last one kept are computed exactly


class Tree:
    """Nodes as arrays: children of node i are first[i] ... first[i] + count[i] - 1."""

    def __init__(self, sample: np.ndarray, seed: int = 2):
        self.centers, self.first, self.count, self.branch = [sample.mean(0) if len(sample) else None], [0], [0], [-1]
        random = np.random.default_rng(seed)
        todo = [(0, sample)]
        while todo:
            node, rows = todo.pop(0)
            if len(rows) <= LEAF_ROWS:
                continue
            centers, nearest = k_means(rows, BRANCHES, random)
            if len(centers) < 2:
                continue
            self.first[node], self.count[node] = len(self.centers), len(centers)
            for j, center in enumerate(centers):
                child = len(self.centers)
                self.centers.append(center)
                self.first.append(0)
                self.count.append(0)
                self.branch.append(j if node == 0 else self.branch[node])
                todo.append((child, rows[nearest == j]))
        self.matrix = np.array(self.centers) if len(sample) else np.zeros((1, 1))
        self.norms = (self.matrix ** 2).sum(1)
        del self.centers

    def children(self, node: int) -> slice:
        return slice(self.first[node], self.first[node] + self.count[node])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: nearest child from the root on."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.count[node] or not len(rows):
                out[rows] = node
                continue
            part = self.children(node)
            nearest = (self.norms[part] - 2 * vectors[rows] @ self.matrix[part].T).argmin(1)
            todo += [(self.first[node] + j, rows[nearest == j]) for j in range(self.count[node])]
        return out

    def visits(self, query: np.ndarray):
        """Leaves from the most to the least promising: the queue always opens the node whose
        center is nearest to the query."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.count[node]:
                yield node
                continue
            part = self.children(node)
            for j, distance in enumerate((self.norms[part] - 2 * self.matrix[part] @ query).tolist()):
                heapq.heappush(queue, (distance, self.first[node] + j))


def k_means(rows: np.ndarray, k: int, random, rounds: int = 8):
    """Centers and the place of each row's center; empty centers are left out."""
    distinct = np.unique(rows, axis=0)
    centers = distinct[random.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = ((centers ** 2).sum(1) - 2 * rows @ centers.T).argmin(1)
        used = np.unique(nearest)
        moved = np.array([rows[nearest == j].mean(0) for j in used])
        if len(moved) == len(centers) and np.allclose(moved, centers):
            break
        centers = moved
    nearest = ((centers ** 2).sum(1) - 2 * rows @ centers.T).argmin(1)
    used, nearest = np.unique(nearest, return_inverse=True)
    return centers[used], nearest


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more component makes all vectors equally long: then the nearest one to a query
    has the largest inner product."""
    rest = np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0.0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of rows that take part: an id, no missing or non-finite component, not
    zero, and as many components as most rows have (the larger number of equally many)."""
    value = F.col("vector")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).filter(
        F.col("vec_id").isNotNull() & value.isNotNull() & (F.size(value) > 0))
    rows = rows.filter(fine).filter(F.exists(value, lambda x: x != 0))
    common = rows.groupBy(F.size(value).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size(value) == (common["n"] if common else 0))


def _best(products: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, k: int):
    """The k largest exact products with their ids; ties to the smaller id."""
    if len(products) > k:
        last = np.partition(products, len(products) - k)[len(products) - k]
        near = np.flatnonzero(products >= last - ROUNDING * max(1.0, abs(last)))
    else:
        near = np.arange(len(products))
    exact = [(-math.fsum((vectors[i] * query).tolist()), int(ids[i])) for i in near]
    return [(-score, number) for score, number in sorted(exact)[:k]]


_HIT = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
    T.StructField("score", T.DoubleType())])


def _hits(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], names=_HIT.names)


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def exact_neighbours(queries: list[tuple[int, np.ndarray]], rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of all rows for a bounded list of queries, by blocks of rows."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            out = []
            for query_id, query in shared.value:
                other = ids != query_id
                out += [(query_id, i, s) for s, i in _best(
                    vectors[other] @ query, ids[other], vectors[other], query, k)]
            if out:
                yield _hits(out)

    return _top(rows.select("vec_id", "vector").mapInArrow(work, _HIT), k)


def nearest(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by `every`, the k other
    rows with the largest inner product in double precision, ties to the smaller id.

    The tree is fitted on FIT_ROWS vectors, then every row is put in its leaf.  Calibration
    queries are searched exhaustively; the number of leaves that a search opens grows until
    their neighbours are found with the given recall, and beyond it where the opened leaves
    hold fewer than k rows.  Queries meet the rows of a branch in blocks of about BLOCK_ROWS;
    each block returns its k best, which are ranked at the end.

    Of equal vectors only the k + 1 with the smallest ids can be among anyone's k nearest, so
    the others are left out before the search.  Rows that usable() rejects take no part;
    repeated rows count once; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = usable(df, vec_id, vector).distinct()
    copies = W.partitionBy("vector").orderBy("vec_id")
    first = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy")
    queried = (F.col("vec_id") % every == 0)
    index = scratch.write(first, "vectors")
    asked = scratch.write(rows.filter(queried), "asked")

    n, longest = index.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()
    if not n:
        return spark.createDataFrame([], T.StructType([
            _HIT[0], T.StructField("rank", T.IntegerType()), _HIT[1], _HIT[2]]))
    sample = _chosen(index, n, FIT_ROWS)
    tree = Tree(_lifted(np.array([v for _, v in sample]), longest))
    shared = spark.sparkContext.broadcast(tree)

    def placed(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.leaves(_lifted(_matrix(batch.column(1)), longest))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(leaf)], names=["vec_id", "vector", "leaf"])

    leaves = scratch.write(index.select("vec_id", "vector").mapInArrow(
        placed, T.StructType([*index.schema.fields, T.StructField("leaf", T.LongType())])), "leaves")
    sizes = {r["leaf"]: r["count"] for r in leaves.groupBy("leaf").count().collect()}  # as many as the tree's leaves

    total = asked.count()
    trial = _chosen(asked, total, CALIBRATION_QUERIES)
    found = exact_neighbours(trial, index, k).join(
        leaves.select("vec_id", "leaf").distinct(), "vec_id").select("query_id", "leaf").collect()
    opened = calibrate(tree, trial, found, recall)

    vectors = _blocks(leaves, tree)
    blocks = scratch.write(vectors.groupBy("branch").agg(F.max("block").alias("last")), "blocks")
    spread = asked.repartition(max(1, -(-total // SEARCHES)))
    wanted = _visits(spread, shared, opened, sizes, k).join(blocks, "branch").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")
    return _top(_search(vectors, wanted, k), k)


def _chosen(rows: DataFrame, n: int, most: int) -> list[tuple[int, np.ndarray]]:
    """At most about `most` rows, chosen by hash and in order of their ids; if the hashes of few
    rows fall into the sample, a larger share of them is taken."""
    every = max(1, -(-n // most))
    while True:
        picked = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).orderBy("vec_id", "vector").collect()
        if every == 1 or len(picked) >= min(n, most) // 4 + 1:
            return [(r["vec_id"], np.array(r["vector"], np.float64)) for r in picked]
        every = max(1, every // 2)


def calibrate(tree: Tree, queries, found, recall: float) -> int:
    """Leaves to open so that the given part of the true neighbours lies in them."""
    of = {}
    for row in found:
        of.setdefault(row["query_id"], []).append(row["leaf"])
    places = []
    for query_id, query in queries:
        rank = {leaf: i for i, leaf in enumerate(tree.visits(np.append(query, 0.0)))}
        places += [rank[leaf] for leaf in of.get(query_id, ())]
    if not places:
        return 1
    return int(sorted(places)[min(len(places) - 1, math.ceil(recall * len(places)) - 1)]) + 1


def _blocks(leaves: DataFrame, tree: Tree) -> DataFrame:
    """Rows with the first branch of their leaf and a block of that branch."""
    table = leaves.sparkSession.createDataFrame(
        [(i, b) for i, b in enumerate(tree.branch) if not tree.count[i]], "leaf long, branch int")
    branched = leaves.join(F.broadcast(table), "leaf")  # as many lines as the tree has leaves
    counts = branched.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    return branched.join(F.broadcast(counts), "branch").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), "blocks")).drop("blocks")


def _visits(asked: DataFrame, shared, opened: int, sizes: dict[int, int], k: int) -> DataFrame:
    """One line per query and branch with the leaves of that branch that the search opens."""
    schema = T.StructType([*asked.schema.fields, T.StructField("branch", T.IntegerType()),
                           T.StructField("opened", T.ArrayType(T.LongType()))])

    def work(batches):
        tree = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, branches, lists = [], [], []
            for i, query in enumerate(_matrix(batch.column(1))):
                by_branch, count = {}, 0
                for number, leaf in enumerate(tree.visits(np.append(query, 0.0))):
                    if number >= opened and count > k:
                        break
                    count += sizes.get(leaf, 0)
                    by_branch.setdefault(tree.branch[leaf], []).append(leaf)
                for branch, leaves in by_branch.items():
                    rows.append(i)
                    branches.append(branch)
                    lists.append(leaves)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(branches, pa.int32()),
                 pa.array(lists, pa.list_(pa.int64()))], names=schema.names)

    return asked.select("vec_id", "vector").mapInArrow(work, schema)


def _search(vectors: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The k best of each block for each query that comes to it."""
    rows = vectors.select("branch", "block", F.lit(0).alias("kind"), "vec_id", "vector",
                          F.array("leaf").alias("leaves")).unionByName(
        wanted.select("branch", "block", F.lit(1).alias("kind"), "vec_id", "vector",
                      F.col("opened").alias("leaves")))
    ordered = rows.repartition("branch", "block").sortWithinPartitions("branch", "block", "kind")

    def work(batches):
        block, held, leaves = None, [], {}
        for batch in batches:
            key = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            cuts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if key[begin][:2] != block:
                    block, held, leaves = key[begin][:2], [], {}
                ids, matrix = part.column(3).to_numpy(), _matrix(part.column(4))
                lists = part.column(5).to_pylist()
                if key[begin][2] == 0:
                    held.append((ids, matrix, np.array([x[0] for x in lists])))
                    continue
                if held:
                    leaves, held = _by_leaf(held), []
                out = []
                for query_id, query, opened in zip(ids.tolist(), matrix, lists):
                    parts = [leaves[x] for x in opened if x in leaves]
                    if not parts:
                        continue
                    numbers = np.concatenate([p[0] for p in parts])
                    others = np.concatenate([p[1] for p in parts])
                    keep = numbers != query_id
                    out += [(query_id, i, s) for s, i in _best(
                        others[keep] @ query, numbers[keep], others[keep], query, k)]
                    if len(out) > 10_000:
                        yield _hits(out)
                        out = []
                if out:
                    yield _hits(out)

    return ordered.mapInArrow(work, _HIT)


def _by_leaf(held) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    ids, matrix, leaf = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(leaf, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], leaf[order][1:] != leaf[order][:-1])))
    return {int(leaf[part[0]]): (ids[part], matrix[part]) for part in np.split(order, starts[1:])}
