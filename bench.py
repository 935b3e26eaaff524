"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tidemark.plans.catalog import QUERIES
from tidemark.workspace import scope

HEADLINE = (
    "clean_documents", "enrich_documents", "score_documents", "quality_tier_counts",
    "timeline_from_enriched", "timeline_from_tiers", "research_prefilter",
    "research_record_rules", "schema_violations", "salience_and_tiers", "candidate_feed",
    "percentile_of_distinct_values", "rank_within_type", "as_of_per_row",
    "near_duplicate_titles", "redacted_documents", "verifier_residue", "postal_findings",
    "log_odds_weights", "classified_heads", "merge_by_slug", "precedence_merge",
    "unresolved_citations", "build_difference",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-bench-"))
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM, the code generator and the Python workers
    QUERIES["summary_of_text"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        with scope(spark):
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "documents_per_sec": {q: round(documents / times[q]) for q in (
            "clean_documents", "enrich_documents", "score_documents", "research_record_rules",
            "redacted_documents")}}))


if __name__ == "__main__":
    main()
