"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tastegraph.plans import all_queries  # noqa: E402
from tastegraph.session import local_session  # noqa: E402

HEADLINE = [
    "attach_attributes",
    "explode_interaction_log",
    "candidate_items",
    "basket_sets",
    "group_sample_k",
    "training_examples",
    "split_leave_one_out",
    "context_affinity",
    "frequent_itemsets",
    "rule_recommend",
    "walk_visit_expectation",
    "walk_item_recommend",
    "neighbour_recommend",
    "topk_per_user",
    "tfidf_similar_topk",
    "vector_similar_topk",
    "auc",
    "rank_agreement",
    "histogram",
    "user_user_cf",
    "interaction_classifier",
    "lsi_similar_topk",
    "lda_similar_topk",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, int(cpus))
    queries = all_queries()
    times = {}
    for name in names.split(",") if names else HEADLINE:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
