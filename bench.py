"""Times the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mergewell.queries import all_queries  # noqa: E402
from mergewell.session import local_session  # noqa: E402

HEADLINE = [
    "q_na_counts", "q_subject_dupes", "q_number_repeats", "q_date_like", "q_duplicate_columns",
    "q_dedupe_survivor", "q_problem_summary", "q_full_merge", "q_col_completeness",
    "q_complete_table", "q_one_hot", "q_pearson_pairs", "q_spearman_pairs",
    "q_redundant_numeric", "q_corr_groups", "q_ml_table", "q_split", "q_folds",
    "q_null_baseline_cls", "q_null_baseline_reg", "q_cls_metrics", "q_roc_auc",
    "q_reg_metrics", "q_vip", "q_ridge", "q_lasso",
]
# Model training takes long next to everything else; it is timed once.
ONCE = {"q_vip"}


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    all_queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session()
    seconds = {}
    for name in names:
        times = [run(spark, folder, name) for _ in range(1 if name in ONCE else 2)]
        seconds[name] = round(min(times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).lstrip("sf")}))


if __name__ == "__main__":
    main()
