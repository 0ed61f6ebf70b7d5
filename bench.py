"""Times the headline queries on BENCH_SF_DIR with local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlake.plans import catalogue  # noqa: E402
from reviewlake.session import local_session  # noqa: E402

HEADLINE = (
    "top_terms_by_language term_counts doc_freq prune_vocabulary vocabulary tfidf tfidf_vectorize sparse_vectors "
    "unwind_reviews dedup_by_key clean_filter_first tag_and_union counts_by_product summary binned_hist_orders "
    "stratified_split stratified_split_orders hist_rating_by_split attach_features "
    "identify_language identify_conversations lemmatise lemmatise_columns token_stats "
    "extra_page_urls extract_embedded_json document_batches roundtrip_partitioned "
    "class_weights undersample oversample_draws confusion guarded_accuracy best_trial gold_table logistic forest"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    catalogue.term_counts(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in wanted:
        started = time.monotonic()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
