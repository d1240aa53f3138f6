"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from textmill.catalog import all_queries
from textmill.session import local_session

HEADLINE = (
    "top_token_counts",
    "word_share",
    "dictionary_filtered",
    "doc2bow",
    "tfidf",
    "bigram_collocations",
    "trigram_collocations",
    "simple_clean_documents",
    "rule_clean_full",
    "html_text",
    "sentence_tags",
    "thread_summary",
    "monthly_agg",
    "text_features",
    "audit_unpivot",
    "describe_exact",
    "umass_coherence",
    "cosine_pairs",
    "lda_predictions",
    "kmeans_labels",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    available = all_queries()
    available["row_count"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        available[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
