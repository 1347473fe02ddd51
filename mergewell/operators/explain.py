"""Which features drive a model: Shapley values and signed coefficients."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mergewell.functions.hashing import hashed_ints, seeded_hash
from mergewell.jobs import ship
from mergewell.lineage import cut_lineage
from mergewell.operators.forest import Forest, encoded, matrix
from mergewell.operators.learners import predict_first_level, thresholds
from mergewell.operators.ranking import rank_in_group, small

VIP = "feature string, importance double, sign string"
SENT_MB = 64  # of the cells of all rows, or of their predictions, that are sent to all tasks
STEPS = 500_000  # predictions that a task looks at together
ROWS_PER_PART = 20_000
CELLS_PER_PART = 100_000


def shap_values(
    model, rows: DataFrame, names: list[str], kind: str, nsim: int = 100, seed: int = 42,
    slice_name: str = "full",
) -> DataFrame:
    """Monte-Carlo Shapley values: (row_id, feature, feature_value, phi, slice).

    `rows` has (row_id, features).  Each row meets `nsim` random rows of the same slice
    and, with each, one random order of the features; a feature contributes the change
    of the prediction when it switches from the other row's value to its own.  What
    sampling leaves over of f(x) - mean f is given to the features by the variance of
    their contributions.  The random partner is found by its hash rank, so no part of
    the data is copied to all tasks.

    A forest cannot tell apart values between the same two of its thresholds.  Every mixture of
    rows is taken to its cell, and each cell that occurs is predicted once.
    """
    if isinstance(model, Forest):
        found = _looked_up(model, rows, names, nsim, seed, slice_name)
        if found is not None:
            return found
    rows = cut_lineage(rows.select("row_id", "features"))
    base = cut_lineage(rows.select("row_id", _cell(vector_to_array("features"), thresholds(model, len(names))).alias("x")))
    ranked = rank_in_group(
        base.withColumns({"all": F.lit(1), "order": seeded_hash(F.lit(seed), F.col("row_id"))}),
        ["all"], "order", "place", ("row_id",))
    partners = ranked.select("place", F.col("x").alias("z"))
    scored = predict_first_level(model, rows, kind, "fx")
    totals = scored.agg(F.count(F.lit(1)).alias("n"), F.avg("fx").alias("mean")).first()
    if not totals["n"]:
        raise ValueError("no rows to explain")

    draws = base.withColumn("sim", F.explode(F.sequence(F.lit(1), F.lit(nsim)))).withColumn(
        "place", F.pmod(F.xxhash64(F.lit(seed), "row_id", "sim"), F.lit(totals["n"])) + 1)
    met = draws.join(partners, "place").withColumn("order", F.transform(
        F.sequence(F.lit(0), F.lit(len(names) - 1)),
        lambda j: F.xxhash64(F.lit(seed + 1), F.col("row_id"), F.col("sim"), j)))
    # Features switch to the row's own values one after the other: a draw of p features needs
    # p + 1 predictions, and each contribution is the step from one to the next.
    turns = met.select("row_id", "sim", "x", "z", "order", F.array_sort("order").alias("turns")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.lit(len(names))))).withColumn("turn", F.get("turns", F.col("k") - 1))
    mixed = turns.select(
        "row_id", "sim", "k", (F.array_position("order", F.col("turn")) - 1).cast("int").alias("j"),
        F.transform("x", lambda v, i: F.when(
            F.get("order", i) <= F.col("turn"), v).otherwise(F.get("z", i))).alias("cell"))
    cells = cut_lineage(mixed.select("cell").distinct()).withColumn("features", array_to_vector("cell"))
    predicted = cut_lineage(predict_first_level(model, cells, kind, "at").select("cell", "at"))
    # One shuffle by row serves both groupings.
    stepped = mixed.join(small(predicted, predicted.count()), "cell").select(
        "row_id", "sim", "k", "j", "at").repartition("row_id")
    walk = stepped.groupBy("row_id", "sim").agg(F.array_sort(F.collect_list(F.struct("k", "j", "at"))).alias("walk"))
    steps = F.transform(F.slice("walk", 2, len(names)), lambda s, i: F.struct(
        s["j"].alias("j"), (s["at"] - F.get("walk", i)["at"]).alias("effect")))
    effects = walk.select("row_id", F.explode(steps).alias("s")).select("row_id", "s.j", "s.effect")
    raw = effects.groupBy("row_id", "j").agg(
        F.avg("effect").alias("phi"), F.coalesce(F.var_samp("effect"), F.lit(0.0)).alias("spread"))

    # A row's window holds one line per feature.
    row = W.partitionBy("row_id")
    left_over = F.col("fx") - F.lit(totals["mean"]) - F.sum("phi").over(row)
    share = F.coalesce(
        F.try_divide(F.col("spread"), F.sum("spread").over(row)), F.lit(1.0 / len(names)))
    own_values = scored.select("row_id", "fx", vector_to_array("features").alias("x"))
    return raw.join(own_values, "row_id").select(
        "row_id", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1).alias("feature"),
        F.element_at("x", F.col("j") + 1).alias("feature_value"),
        (F.col("phi") + left_over * share).alias("phi"), F.lit(slice_name).alias("slice"))


def _looked_up(
    model: Forest, rows: DataFrame, names: list[str], nsim: int, seed: int, slice_name: str,
) -> DataFrame | None:
    """shap_values() of a forest with the same draws: each row's task makes its mixtures itself and looks
    their predictions up, so that neither mixtures nor steps are rows.  Rows that repeat an id are
    explained one by one.

    None if the cells of the rows, a byte per feature, or the predictions, 16 bytes for each cell that occurs,
    exceed SENT_MB.
    """
    ship(rows.sparkSession)
    size, cuts = len(names), model.cuts
    sent = rows.sparkSession.sparkContext.broadcast
    x = vector_to_array("features")

    def encode(batches):
        for batch in batches:
            if batch.num_rows:
                cells = [c.tobytes() for c in encoded(matrix(batch, "x"), cuts)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, pa.binary())], names=[*batch.schema.names, "cell"])

    coded = cut_lineage(rows.select(
        "row_id", x.alias("x"), F.xxhash64(F.lit(seed), "row_id").alias("meets"),
        F.xxhash64(F.lit(seed + 1), "row_id").alias("turns")).mapInArrow(
            encode, "row_id string, x array<double>, meets long, turns long, cell binary"))
    n = coded.count()
    if not n:
        raise ValueError("no rows to explain")
    if n * size > SENT_MB * 1_000_000:
        return None
    ordered = coded.select("row_id", "cell").withColumns(
        {"all": F.lit(1), "order": seeded_hash(F.lit(seed), F.col("row_id"))})
    ranked = rank_in_group(ordered, ["all"], "order", "place", ("row_id",)).select("place", "cell").toArrow()
    partners = np.empty((n, size), np.uint8)
    partners[ranked.column("place").to_numpy() - 1] = _codes(ranked.column("cell").to_pylist(), size)
    weights, exact = _key_weights([len(c) + 1 for c in cuts], seed)
    shared = sent(partners)

    def walks(batch):
        """Per few rows: their place in the batch, order of the features, and the keys of the cells they
        go through, from the partner's to their own.  A key is the sum of the weights of its codes."""
        some = max(1, STEPS // (nsim * (size + 1)))
        sims, features = np.arange(1, nsim + 1), np.arange(size)
        own_codes = _codes(batch.column("cell").to_pylist(), size)
        meets, turns = (batch.column(c).to_numpy() for c in ("meets", "turns"))
        for start in range(0, batch.num_rows, some):
            own = slice(start, start + some)
            z = shared.value[hashed_ints(meets[own, None], sims) % n]
            order = hashed_ints(hashed_ints(turns[own, None], sims)[..., None], features).argsort(2)
            codes = own_codes[own]
            start_at = weights[features, z]
            switch = weights[features, codes][:, None, :] - start_at
            keys = np.empty((*order.shape[:2], size + 1), np.int64)
            keys[..., 0] = start_at.sum(2)
            keys[..., 1:] = np.take_along_axis(switch, order, 2)
            yield own, codes, z, order, keys.cumsum(2, out=keys)

    def occurring(batches):
        seen = np.array([], np.int64)
        for batch in batches:
            for _, codes, z, order, keys in walks(batch):
                flat = keys.ravel()
                new = np.unique(flat)
                new = new[~_within(new, seen)]
                if not len(new):
                    continue
                hit = np.flatnonzero(_within(flat, new))
                first = np.empty(len(new), np.int64)
                first[np.searchsorted(new, flat[hit])] = hit
                row, sim, k = np.unravel_index(first, keys.shape)
                own = np.empty((len(new), size), bool)  # the features that have switched by then
                np.put_along_axis(own, order[row, sim], np.arange(size) < k[:, None], 1)
                cells = np.where(own, codes[row], z[row, sim])
                seen = np.sort(np.concatenate([seen, new])) if len(seen) < 8 * STEPS else new
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new), pa.array([c.tobytes() for c in cells], pa.binary())], names=["key", "cell"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    dealt = coded.repartition(max(cores, math.ceil(n / ROWS_PER_PART)))
    cells = cut_lineage(dealt.select("meets", "turns", "cell").mapInArrow(occurring, "key long, cell binary").groupBy(
        "key").agg(F.min("cell").alias("cell"), F.max("cell").alias("other")))
    many = cells.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cell") != F.col("other")).alias("mixed")).first()
    if many["n"] * 16 > SENT_MB * 1_000_000 or (many["mixed"] and not exact):
        return None
    forest = sent(model)

    def predict(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            table = pa.Table.from_batches(batches)
            codes = _codes(table.column("cell").to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [table.column("key").combine_chunks(), pa.array(forest.value.first_class(np.ascontiguousarray(codes.T)))],
                names=["key", "at"])

    table = cells.select("key", "cell").repartition(max(cores, math.ceil(many["n"] / CELLS_PER_PART))).mapInArrow(
        predict, "key long, at double").toArrow()
    keys, at = (table.column(c).to_numpy() for c in ("key", "at"))
    order = keys.argsort()
    keys, at = keys[order], at[order]
    predicted = sent((keys, at))
    mean = float(at[np.searchsorted(keys, weights[np.arange(size), partners].sum(1))].mean())

    def explain(batches):
        keys, at = predicted.value
        for batch in batches:
            values = matrix(batch, "x") if batch.num_rows else None
            for own, _, _, order, walked in walks(batch):
                scores = at[np.searchsorted(keys, walked)]
                effects = np.empty(order.shape)
                np.put_along_axis(effects, order, np.diff(scores, axis=2), 2)
                phi = effects.mean(1)
                spread = effects.var(1, ddof=1) if nsim > 1 else np.zeros(phi.shape)
                total = spread.sum(1, keepdims=True)
                share = np.divide(spread, total, out=np.full(phi.shape, 1.0 / size), where=total > 0)
                phi += (scores[:, 0, -1] - mean - phi.sum(1))[:, None] * share
                ids = batch.column("row_id").take(pa.array(np.repeat(np.arange(batch.num_rows)[own], size)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(names * len(phi), pa.string()), pa.array(values[own].ravel()),
                     pa.array(phi.ravel())], names=["row_id", "feature", "feature_value", "phi"])

    return dealt.filter("row_id IS NOT NULL").select("row_id", "x", "meets", "turns", "cell").mapInArrow(
        explain, "row_id string, feature string, feature_value double, phi double").withColumn(
            "slice", F.lit(slice_name))


def _codes(cells: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.uint8).reshape(-1, size)


def _within(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _key_weights(sizes: list[int], seed: int) -> tuple[np.ndarray, bool]:
    """A weight per feature and code; sums of one weight per feature tell cells apart.  If there are more
    cells than numbers, the weights are random, and False says that sums may coincide."""
    exact = math.prod(sizes) < 2**62
    if not exact:
        return np.random.default_rng(seed).integers(-2**63, 2**63, (len(sizes), max(sizes)), np.int64), False
    steps = np.array([math.prod(sizes[i + 1:]) for i in range(len(sizes))], np.int64)
    return steps[:, None] * np.arange(max(sizes)), True


def _cell(x: Column, cuts: list[list[float] | None] | None) -> Column:
    """Each value replaced by the first threshold that it does not exceed, infinity beyond the last;
    values stay that are not compared with thresholds."""
    if cuts is None:
        return x
    known = F.array(*[F.array(*[F.lit(c) for c in points or []]).cast("array<double>") for points in cuts])
    kept = F.array(*[F.lit(points is None) for points in cuts])
    return F.transform(x, lambda v, i: F.when(F.get(kept, i), v).otherwise(F.coalesce(
        F.get(F.filter(F.get(known, i), lambda c: v <= c), 0), F.lit(float("inf")))))


def shap_importance(values: DataFrame, top: int = 10) -> DataFrame:
    """The features with the largest mean |phi| per slice."""
    ranked = values.groupBy("slice", "feature").agg(F.avg(F.abs("phi")).alias("importance"))
    best = W.partitionBy("slice").orderBy(F.desc("importance"), "feature")
    return ranked.withColumn("place", F.row_number().over(best)).filter(
        F.col("place") <= top)


def signed_importance(model, names: list[str], spark, top: int = 25) -> DataFrame:
    """|coefficient| on the original scale with its sign, largest first."""
    rows = [(n, abs(float(b)), "NEG" if b < 0 else "POS")
            for n, b in zip(names, model.coefficients.toArray())]
    return spark.createDataFrame(rows, VIP).orderBy(F.desc("importance"), "feature").limit(top)
