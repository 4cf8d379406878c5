"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnlytics.plans.catalogue import all_queries  # noqa: E402
from txnlytics.session import local_session  # noqa: E402

HEADLINE = (
    "validation_report",
    "dedupe",
    "ingest_append",
    "txn_enriched",
    "kpi_summary",
    "spend_by_category",
    "monthly_trend",
    "txn_explorer",
    "zscore",
    "anomaly_merge",
    "iforest",
    "forecast",
    "forecast_cards",
    "clean_text",
    "ngram_vocab",
    "tfidf_weights",
    "classify_batch",
    "classify_fitted",
    "statement_run",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    # Start-up of the JVM, the code generator and the Python workers is not measured.
    catalogue = all_queries()
    for name in ("kpi_summary", "iforest"):
        catalogue[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
