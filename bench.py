"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {name: sec}, "sf": ...,
 "rows": {name: input_rows}, "rows_per_sec": {name: r/s}, "scorer": "lexical"}

Each query is planned and fully executed (noop sink) once after a warm-up;
the time includes planning.  Input rows are the request/sequence rows each
query reads, so rows/s can be compared across scale factors.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "bind_two_numbers",
    "run_job",
    "select_function",
    "decode_calls",
    "extract_numbers_documents",
    "substitute_args",
    "shortest_unique_prefix",
    "allowed_next_tokens",
    "normalize_tokens",
    "constrained_walk",
]

# Input row counts per query: the tables each query reads in full.
INPUTS = {
    "bind_two_numbers": ["lineitem"],
    "run_job": ["lineitem", "orders", "part", "nation", "customer", "supplier", "conversations"],
    "select_function": ["lineitem", "orders", "part", "nation", "customer", "supplier",
                        "conversations"],
    "decode_calls": ["events"],
    "extract_numbers_documents": ["documents"],
    "substitute_args": ["part"],
    "shortest_unique_prefix": ["documents"],
    "allowed_next_tokens": ["documents"],
    "normalize_tokens": ["documents"],
    "constrained_walk": ["embeddings"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    from callsmith.plans.queries import REGISTRY
    from callsmith.session import get_spark, table
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: JVM, codegen and the parquet reader.
    REGISTRY["bind_two_numbers"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    counts: dict[str, int] = {}

    def rows_of(name: str) -> int:
        total = 0
        for t in INPUTS.get(name, []):
            if t not in counts:
                counts[t] = table(spark, sf_dir, t).count()
            total += counts[t]
        return total

    times: dict[str, float] = {}
    rates: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in only:
        t0 = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        rows[name] = rows_of(name)
        rates[name] = round(rows[name] / times[name], 1) if times[name] > 0 else 0.0
    m = re.search(r"sf([0-9.]+)", sf_dir)
    per_request = {q: round(times[q] / rows[q], 9) for q in ("bind_two_numbers", "run_job")
                   if q in times and rows.get(q)}
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
        "rows": rows, "rows_per_sec": rates, "sec_per_request": per_request,
        # lexical scorer does different work, so this is context, not a speed-up.
        "reference_sec_per_prompt": 3.5, "scorer": "lexical",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
