"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from replyloom.plans.queries import QUERIES  # noqa: E402
from replyloom.session import local_session, scratch  # noqa: E402

HEADLINES = (
    "normalize_for_matching",
    "safe_guidance",
    "rule_label",
    "reply_pairs",
    "thread_root",
    "exclude_held_out",
    "dedupe_first",
    "stratified_split",
    "create_weak_labels",
    "make_label_queue",
    "system_metrics",
    "judge_human_agreement",
    "cohen_kappa",
    "decide",
    "diverse_topk",
    "word_terms",
    "char_terms",
    "tfidf_fit",
    "hybrid_retrieve",
    "judge_table",
    "failure_queue",
    "save_load_index",  # builds an index
    "train_intent_model",  # fits a classifier
    "predict_intent",  # applies one
    "triage",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores), "replyloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session pays for starting the engine; that is not its own cost.
    QUERIES["humanize"](spark, folder).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINES:
        began = time.perf_counter()
        with scratch(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - began, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
