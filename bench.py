"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores. Each
query runs once to warm up and then BENCH_RUNS times (default 3); the median counts. All
result rows are produced and dropped (noop sink), so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadsheet import plans  # noqa: E402
from broadsheet.session import build_session  # noqa: E402

HEADLINE = (
    "trending_keywords",
    "keyword_scores",
    "keyword_network_edges",
    "keyword_network_depth2",
    "keyword_sentiment",
    "sentiment_distribution",
    "category_summary",
    "stats_summary",
    "timeline_day",
    "sentiment_trends_day",
    "category_top_topics",
    "articles_page",
    "articles_per_category_topn",
    "search_articles",
    "unprocessed_articles",
    "upsert_merge",
    "validate_articles",
    "extract_articles",
    "page_links",
    "clean_text",
    "doc_keywords",
    "text_stage",
    "chunk_docs",
    "summary_stage",
    "sentiment_stage",
    "sentiment_keywords",
    "topics_lda",
    "extract_articles_by_site",
    "stage_coverage",
    "stream_text_stage",
    "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.ui.enabled": "false",
            **({"spark.broadsheet.tasks": cpus} if cpus.isdigit() else {}),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = plans.queries()
    times = {}
    chosen = os.environ.get("BENCH_QUERIES", "").split()
    for name in chosen or HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        times[name] = round(statistics.median(seconds[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
