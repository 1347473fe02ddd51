"""Toxicity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.rows import with_computed
from mergewell.llm.scratch import Scratch

FIT_ROWS = 5_000  # labelled rows, chosen by hash, that the model is fitted on
GRADES = 3  # severities above 0
WIDTH = 1 << 22  # hashed features
LETTERS = re.compile(r"[^\W\d_]+")
SHORTEST = 4  # letters of a word's beginning that count as a feature of their own
SCREEN = 60.0  # chi-square with the toxic label below which a feature is noise
PENALTY = 0.0003  # on the sum of absolute weights
ROUNDS = 3000
KEPT_WORDS = 300_000


def features_of(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its first four and five letters."""
    names = [word, *(f"{word[:n]}*" for n in (SHORTEST, SHORTEST + 1) if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) % WIDTH for x in names)


def counts_of(text: str | None) -> dict[int, int]:
    """How often each feature occurs in a text, letters in lower case."""
    out: Counter = Counter()
    for word, n in Counter(LETTERS.findall((text or "").lower())).items():
        for feature in features_of(word):
            out[feature] += n
    return out


class Severity:
    """P(grade >= k) = logistic(w . x - threshold[k]), thresholds in rising order, one w.

    x is log(1 + count) of the features that differ between the labels.
    """

    def __init__(self):
        self.weights: dict[int, float] = {}
        self.thresholds = np.full(GRADES, 20.0)

    def fit(self, rows: list[tuple[dict[int, int], bool]]) -> Severity:
        """rows: counts of the screened features, and whether the text is toxic."""
        toxic = np.array([t for _, t in rows], bool)
        if not toxic.any() or toxic.all():
            if toxic.any():
                self.thresholds = np.array([-20.0] + [20.0] * (GRADES - 1))
            return self
        chosen = sorted({f for counts, _ in rows for f in counts})
        place = {f: i for i, f in enumerate(chosen)}
        lines, columns, values = [], [], []
        for i, (counts, _) in enumerate(rows):
            for f, n in counts.items():
                lines.append(i)
                columns.append(place[f])
                values.append(np.log1p(n))
        lines, columns, values = np.array(lines, np.int64), np.array(columns, np.int64), np.array(values, float)
        grade = grades(np.bincount(lines, values, len(rows)), toxic)
        w, cuts = np.zeros(len(chosen)), np.linspace(0.5, 2.5, GRADES)
        momentum_w, momentum_c = np.zeros_like(w), np.zeros_like(cuts)
        above = grade[:, None] >= np.arange(1, GRADES + 1)
        scale = 1.0 / (1.0 + np.bincount(columns, values ** 2, len(chosen)) / len(rows))
        for _ in range(ROUNDS):
            line = np.bincount(lines, values * w[columns], len(rows))
            # The likelihood of each threshold's question: is the grade at least k?
            error = 1.0 / (1.0 + np.exp(-np.clip(line[:, None] - cuts, -30, 30))) - above
            gw = np.bincount(columns, values * error.sum(1)[lines], len(chosen)) / len(rows)
            momentum_w = 0.9 * momentum_w - 0.5 * scale * gw
            momentum_c = 0.9 * momentum_c + 0.5 * error.mean(0)
            w = w + momentum_w
            w = np.sign(w) * np.maximum(np.abs(w) - 0.5 * PENALTY * scale, 0.0)
            cuts = np.maximum.accumulate(cuts + momentum_c)
        self.weights = {f: float(x) for f, x in zip(chosen, w) if x}
        self.thresholds = cuts
        return self

    def probabilities(self, line: float) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(line - self.thresholds, -30, 30)))


def screened(sample: DataFrame, rows: int, marked: int) -> DataFrame:
    """(feature) of those that occur more often in toxic rows than chance allows.

    sample: toxic (0 or 1), counts; rows and marked: how many there are, and toxic ones."""
    if not 0 < marked < rows:
        return sample.select(F.explode(F.map_keys("counts")).alias("feature")).limit(0)
    of = sample.select("toxic", F.explode(F.map_keys("counts")).alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("both"), F.count(F.lit(1)).alias("held"))
    expected = F.col("held") * (marked / rows)
    spread = expected * (1 - marked / rows) * (1 - F.col("held") / rows)
    return of.filter((F.col("held") >= 3) & (F.col("held") < rows) & (F.col("both") > expected)).filter(
        F.pow(F.col("both") - expected, 2) >= SCREEN * spread).select("feature")


def grades(evidence: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grade 0 for rows that are not toxic; toxic ones in equal parts by their evidence."""
    cuts = np.quantile(evidence[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(cuts, evidence, side="right"), 0)


_COUNTS = [T.StructField("counts", T.MapType(T.LongType(), T.LongType()))]


def fit_severity(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
) -> Severity:
    """Fit on at most about FIT_ROWS labelled rows, chosen by hash of their ids.

    The labels say only whether a text is toxic: toxic rows are graded by how much of what
    marks toxic texts they hold.  Missing labels or ids are left out; without both kinds of
    labels every text gets the same answer.  Labels of one id that contradict each other count as
    toxic; documents that repeat a labelled id are fitted each.  Other columns are ignored.
    """
    usable = labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("__doc")).agg(F.max(F.col(toxic).cast("int")).alias("__toxic"))
    n = usable.count()
    every = max(1, -(-n // FIT_ROWS))
    picked = usable.filter(F.pmod(F.xxhash64("__doc"), F.lit(every)) == 0)
    joined = documents.select(doc_id, text).join(
        F.broadcast(picked), F.col(doc_id) == F.col("__doc"))  # FIT_ROWS lines
    scratch = Scratch(documents.sparkSession)
    sample = scratch.write(with_computed(
        joined, [text], _COUNTS, lambda: lambda value: (list(counts_of(value).items()),)).select(
        F.monotonically_increasing_id().alias("row"), F.col("__doc").alias("doc"),
        (F.col("__toxic") > 0).cast("int").alias("toxic"), "counts"), "labelled")
    texts = sample.select("row", "doc", "toxic").collect()  # about FIT_ROWS
    chosen = scratch.write(screened(sample, len(texts), sum(r["toxic"] for r in texts)), "features")
    hits = sample.select("row", F.explode("counts").alias("feature", "n")).join(chosen, "feature").collect()
    counts: dict[int, dict[int, int]] = {r["row"]: {} for r in texts}
    for r in hits:
        counts[r["row"]][r["feature"]] = r["n"]
    ordered = sorted(texts, key=lambda r: (r["doc"], sorted(counts[r["row"]].items())))
    scratch.drop(sample, chosen)
    return Severity().fit([(counts[r["row"]], r["toxic"] > 0) for r in ordered])


def score_severity(df: DataFrame, model: Severity, text: str = "text") -> DataFrame:
    """df with severity (expected grade), grade (the most probable one) and toxic (a grade of
    1 or more is likelier than not).

    A missing or empty text has no features and gets the model's answer to none.  Rows are
    independent: repeated rows get equal results, an empty table stays empty, and columns
    named like a result are replaced.  Very long texts are scored whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()),
              T.StructField("toxic", T.BooleanType())]

    def make():
        model, known = shared.value, {}

        def compute(value):
            found: Counter = Counter()
            for word, n in Counter(LETTERS.findall((value or "").lower())).items():
                marked = known.get(word)
                if marked is None:
                    if len(known) >= KEPT_WORDS:
                        known.clear()
                    marked = known[word] = tuple(f for f in features_of(word) if f in model.weights)
                for f in marked:
                    found[f] += n
            line = sum(model.weights[f] * np.log1p(found[f]) for f in sorted(found))
            above = model.probabilities(line)
            each = np.append(1.0, above) - np.append(above, 0.0)
            return float(above.sum()), int(each.argmax()), bool(above[0] >= 0.5)
        return compute

    return with_computed(df, [text], fields, make)
