"""Wall time of the headline queries: one warm-up, then the median of the runs.

Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS,
BENCH_QUERIES (comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINE = [
    "weak_supervision_quality", "lbl_vote_matrix", "lbl_rule_overlap", "txt_tokens_from_join", "sch_drop_blank_duplicates",
    "eda_length_stats", "val_status", "drf_ks_lineitem_quantity", "drf_column_drift", "drf_term_divergence", "spl_folds",
    "smp_proportional", "bal_upsample_events", "fea_tfidf", "mod_nb_scores", "mod_nb_batch_scoring", "mod_nb_cross_validation",
    "met_transfer", "met_curve_areas", "met_reject_sweep", "met_ece", "met_latency", "mod_linear_svm", "cal_platt", "ret_topk",
    "ret_hybrid", "aug_table", "abs_crosstab", "top_lda_by_label", "top_coherence_cv", "str_prediction_monitor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    from quillspark.plans import QUERIES
    from quillspark.session import build_session

    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times = {}
    for n in names:
        once(n)
        times[n] = round(statistics.median(once(n) for _ in range(runs)), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}
        )
    )


if __name__ == "__main__":
    main()
