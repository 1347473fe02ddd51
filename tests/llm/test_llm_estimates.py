"""Estimates of quality and toxicity against plain numpy."""

import numpy as np

from mergewell.llm import quality, toxicity


def plain_vector(words, chars, symbols, lines, repeats):
    return np.array([np.log(chars / words), np.sqrt(symbols / words), np.log1p(lines), np.sqrt(repeats / words)])


def plain_kept(x, language, everything, enough):
    """Verdicts of one group by rows, no grid: concentration steps from many random starts."""
    def robust(x):
        n, p = x.shape
        floor, random = np.diag(np.array(quality.RESOLUTION[:p]) ** 2), np.random.default_rng(1)
        wanted = max(1.0, quality.SHARE * n)
        most = int(np.ceil(wanted))
        best = None
        for _ in range(60):
            take = random.choice(n, min(n, p + 2), replace=False)
            det = np.inf
            while True:
                center, cov = x[take].mean(0), np.cov(x[take].T, bias=True) + floor
                now = np.linalg.det(cov)
                if not now < det * (1 - 1e-9):
                    break
                det = now
                d = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)
                take = np.argsort(d, kind="stable")[:most]
            if best is None or now < best[0]:
                best = (now, center, cov)
        _, center, cov = best
        cov = cov * quality.CONSISTENCY * (1 + quality.SCARCITY / n)
        d = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)
        inside = x[d <= quality.REACH]
        if len(inside) >= wanted:
            center, cov = inside.mean(0), (np.cov(inside.T, bias=True) + floor) * (1 + p / n)
        return center, cov

    center, cov = robust(everything)
    for part in (language, x):
        own = min(1.0, len(part) / enough)
        c, v = robust(part)
        center, cov = own * c + (1 - own) * center, own * v + (1 - own) * cov
    return np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)


def test_verdicts_equal_those_of_an_estimate_by_rows(spark):
    """Groups of 200, 60 and 12 rows with outliers and ties at one point."""
    random = np.random.default_rng(5)
    rows = []
    for lang, source, n in (("en", "a", 200), ("en", "b", 60), ("fr", "a", 60), ("fr", "c", 12)):
        for i in range(n):
            words = [("x" * int(random.integers(2, 9 if i % 10 else 40))) + str(i) + "q" * k for k in range(int(random.integers(20, 90)))]
            symbols = int(random.poisson(3)) if i % 12 else 300
            text = " ".join(words) + " " + " ".join(["a#b"] * 0) + "&" * symbols
            text += ("\nsame line" * 2 + "\nother") if i % 3 == 0 else ""
            rows.append((len(rows), text, lang, source))
        rows += [(len(rows) + k, "tie " + " ".join(f"w{j}" for j in range(30)), lang, source) for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.quality_rules(frame).collect()
    good = [r for r in got if not r["base_failed"]]
    x = np.array([plain_vector(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in good])
    same = near = 0
    for lang, source in {(r["lang"], r["source"]) for r in good}:
        mine = np.array([(r["lang"], r["source"]) == (lang, source) for r in good])
        speech = np.array([r["lang"] == lang for r in good])
        distance = plain_kept(x[mine], x[speech], x, quality.ENOUGH)
        for r, d in zip([r for r, m in zip(good, mine) if m], distance):
            same += r["kept"] == (d <= quality.CUTOFF)
            near += r["kept"] != (d <= quality.CUTOFF) and abs(d - quality.CUTOFF) < 0.35 * quality.CUTOFF
    # Cells of the grid are kept whole, rows one by one: verdicts differ close to the cut-off only.
    assert same + near == len(good) and same >= 0.97 * len(good)
    rejected = sum(not r["kept"] for r in good)
    assert 0 < rejected < 0.3 * len(good)


def test_rows_at_the_cutoff_stay(spark):
    ties = [(i, "one two three four five six seven eight nine ten eleven", "en", "s") for i in range(50)]
    kept = quality.quality_rules(spark.createDataFrame(ties, "doc_id long, text string, lang string, source string"))
    assert kept.filter("kept").count() == 50 and kept.select("distance").distinct().count() == 1


def loss(w, cuts, x, grade):
    line = x @ w
    out = 0.0
    for k, cut in enumerate(cuts, 1):
        z = line - cut
        out += np.mean(np.logaddexp(0, z) - (grade >= k) * z)
    return out + toxicity.PENALTY * np.abs(w).sum()


def test_the_fit_is_the_smallest_loss():
    """Plain proximal steps on the dense table, from zero, find no smaller loss."""
    random = np.random.default_rng(7)
    rows = []
    for i in range(160):
        toxic = i % 3 == 0
        counts = {f: int(random.poisson(2.0 if toxic and f < 3 else 0.4)) for f in range(6)}
        rows.append(({f: n for f, n in counts.items() if n}, toxic))
    model = toxicity.Severity().fit(rows)
    x = np.array([[np.log1p(c.get(f, 0)) for f in range(6)] for c, _ in rows])
    grade = toxicity.grades(x.sum(1), np.array([t for _, t in rows]))
    fitted = loss(np.array([model.weights.get(f, 0.0) for f in range(6)]), model.thresholds, x, grade)
    w, cuts = np.zeros(6), np.array([0.5, 1.5, 2.5])[:toxicity.GRADES]
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(x @ w)[:, None] + cuts))
        error = p - (grade[:, None] >= np.arange(1, len(cuts) + 1))
        w = w - 0.1 * x.T @ error.sum(1) / len(x)
        w = np.sign(w) * np.maximum(np.abs(w) - 0.1 * toxicity.PENALTY, 0)
        cuts = np.maximum.accumulate(cuts + 0.1 * error.mean(0))
    assert fitted <= loss(w, cuts, x, grade) + 1e-3
    assert list(model.thresholds) == sorted(model.thresholds)


def test_contradicting_labels_count_as_toxic(spark):
    docs = spark.createDataFrame([(i, "vile awful words" if i % 2 else "calm gentle words") for i in range(400)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(400)] + [(i, 0) for i in range(1, 400, 2)]
    model = toxicity.fit_severity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score_severity(docs, model).collect()
    assert all(r["toxic"] == bool(r["doc_id"] % 2) for r in got)
