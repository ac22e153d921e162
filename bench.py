"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from hitloom.session import local_session
from workbench.catalog import QUERIES

HEADLINE = (
    "hit_rate_by_year",
    "fuzzy_all_75",
    "fuzzy_all_42",
    "fuzzy_best",
    "left_merge_fanout",
    "normalize_text",
    "recent_window",
    "hist_by_class",
    "corr_matrix",
    "describe",
    "impute_scale",
    "stratified_split",
    "fold_assign",
    "welch_t",
    "mannwhitney_u",
    "roc_auc",
    "pr_best_threshold",
    "cls_report",
    "attr_group",
    "knn_distance",
    "smote_counts",
    "logreg_score",
    "rf_score",
    "mlp_score",
    "stream_ingest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    QUERIES["scan_songs"](spark, folder).count()  # start-up is not a query
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
