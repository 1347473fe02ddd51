"""Quality verdicts of small groups: judged by their own language and source."""

import random

from mergewell.llm import quality


def test_small_sources_of_another_style_have_their_own_estimate(spark):
    random.seed(4)
    word = lambda low, high: "".join(random.choice("abcdefgh") for _ in range(random.randint(low, high)))
    prose = lambda: " ".join(word(2, 9) for _ in range(random.randint(40, 200)))
    code = lambda: " ".join(word(2, 9) + "**" for _ in range(random.randint(40, 200)))
    rows = [(i, prose(), "en", "prose") for i in range(1000)]
    for n, first in ((20, 1000), (50, 2000), (99, 3000)):
        rows += [(first + i, code(), "en", f"code{n}") for i in range(n)]
    rows += [(5000 + i, prose(), "de", "prose") for i in range(40)]
    rows += [(6000 + i, code(), "de", "prose") for i in range(4)]
    rows += [(7000, code(), "fr", "junk"), (7001, prose(), "fr", "prose")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(frame).collect()}
    assert sum(not kept[i] for i in kept if 1000 <= i < 5000) <= 2
    assert sum(not kept[i] for i in kept if i < 1000 or 5000 <= i < 6000) <= 2
    assert not any(kept[i] for i in range(6000, 6004)) and kept[7001]
