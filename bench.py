"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from catalog.queries import QUERIES
from textmill.session import get_session

HEADLINE = [
    "label_counts", "keyword_mentions", "normalize_text", "lemmatize", "assign_labels", "assign_labels_large_map",
    "hide_own_keywords", "labels_per_document", "dedupe_documents", "build_vocabulary", "vocabulary_all_terms",
    "tfidf_vectors", "count_vectors", "split_rows", "ovr_gd_predict", "classification_report", "multinomial_lr",
    "score_batch", "stream_scoring",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session also pays for class loading and code generation.
    QUERIES["label_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
