"""Headline queries at one scale; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (table folder), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS``. Every
query is computed in full and its rows are discarded. The value of a query is the best of its runs;
one untimed run of the flagship query warms the JVM up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlens.plans.catalog import all_queries  # noqa: E402
from reviewlens.session import build_session  # noqa: E402

HEADLINE = (
    "rule_score_v2",
    "prediction_doc_v2",
    "worst_products",
    "top_products_sentiment",
    "pred_raw_join",
    "last_by_key",
    "insert_if_absent",
    "upsert_latest",
    "batch_model_score",
    "decode_json",
    "negative_burst",
    "sentiment_trend",
    "word_count",
    "stream_baseline",
    "train_tfidf_lr",
    "predict_tfidf_lr",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "reviewlens-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus), spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("worst_products")
    seconds = {name: round(min(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    reviews = queries["table_counts"](spark, sf_dir).first()["raw"]
    throughput = {name: round(reviews / seconds[name]) for name in HEADLINE if name != "word_count"}
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "reviews": reviews,
                "reviews_per_sec": throughput,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
