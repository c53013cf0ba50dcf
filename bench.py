"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glossweave.catalog import pools, runs, tables, texts  # noqa: E402,F401
from glossweave.catalog.registry import QUERIES  # noqa: E402
from glossweave.session import build_session  # noqa: E402

HEADLINE = [
    "build_pool", "classify_untranslatable", "residue_score", "greedy_chunks", "apply_memory", "localize_table",
    "localize_rerun", "qa_rounds", "translate_pseudo", "first_appearance", "memory_misses", "completeness_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "glossweave-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, calls = {}, None
    for name in HEADLINE:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        if name == "localize_rerun":
            calls = sum(row["api_calls"] for row in result.collect())
        else:
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "second_run_calls": calls,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
