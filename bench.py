"""Benchmark the headline queries at one scale factor.

Runs each query to completion with the ``noop`` sink (every row computed,
nothing collected to the driver) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set below).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.registry import queries  # noqa: E402
from ledgerlens.session import get_session  # noqa: E402

HEADLINE = [
    # column profiling / numbers
    "column_documents", "normalized_cells", "normalize_numbers",
    # filings: text, fields, section, chunk, prompts, answers, tables
    "html_to_text", "filing_fields", "item_section", "best_chunk", "best_chunk_lev",
    "extraction_prompts", "pipe_table_cells", "combine_tables", "csv_tables_cells",
    "html_table_cells",
    # vectors
    "embed_documents", "project_vectors", "ensemble_vectors", "topk_search",
    "topk_search_blocked", "cell_embeddings",
    # training data
    "tokenized_docs", "padded_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="ledgerlens-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
                               "spark.sql.files.maxPartitionBytes": str(32 << 20)})
    qs = queries()
    # warm-up (not timed): JVM class loading / JIT and Python workers, on the
    # smallest data set when it exists, so no result of the timed runs is reused
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for w in ("l2_normalize", "column_documents", "filing_fields", "embed_documents", "pipe_table_cells"):
        qs[w](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
