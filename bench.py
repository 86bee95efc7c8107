"""Headline queries, timed; prints one JSON line.

Every query writes its whole result to the no-op sink, after one warm-up run of
the cheapest text query. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from threadloom.session import build_session  # noqa: E402

HEADLINE = (
    "clean_text",
    "clean_documents",
    "html_unescape",
    "word_count",
    "post_normalise",
    "listing_union",
    "listing_dedup",
    "batch_assign",
    "ingest_counts",
    "tree_flatten",
    "tree_prune",
    "tree_nest",
    "render_thread",
    "render_post",
    "post_blocks",
    "rotate_both",
    "clean_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "threadloom-bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("strip_tags")
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    result = {
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
