"""Times the headline queries on one machine and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerleaf import plans
from ledgerleaf.session import build_session, scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "vector_topk",
    "vector_topk_batch",
    "client_search",
    "validate_documents",
    "register_validated",
    "route_documents",
    "event_envelope_parse",
    "extract_documents",
    "clean_text",
    "chunk_documents",
    "chunk_stats",
    "embed_hash",
    "classify_rules",
    "parse_rerank",
    "parse_classification",
    "registry_upsert",
    "replace_chunks",
    "archive_run",
    "audit_trail",
    "status_summary",
    "searchable_files",
    "dashboard",
    "my_documents",
    "trade_measures",
    "valuation_share",
    "invoice_totals",
    "reconcile",
    "landing_stream",
    "chain_stream",
)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.log.level": "ERROR",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.load().QUERIES
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            with scratch(spark):
                begun = time.perf_counter()
                queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - begun)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
