"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). A few queries run first so that JVM start and
code generation are not charged to the first headline query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opinari.plans.registry import QUERIES, load_all  # noqa: E402
from opinari.session import build_session  # noqa: E402
from opinari.sources.tables import SPREAD  # noqa: E402

HEADLINE = [
    "aspect_summary", "absa_job", "comment_filter", "sentiment_lexicon", "clean_text",
    "keyword_hits", "dedup_comments", "text_length_profile", "top_words", "quality_report",
    "deep_clean", "detect_language", "game_summary", "event_rate", "latency_quantiles",
    "alerts", "weighted_metrics", "clean_job", "lemmatize", "table_profile", "evaluate_classifier",
]

#: Run once before the clock: JVM start, code generation, Python workers, ML classes.
WARM_UP = ["clean_text", "aspect_summary", "quality_report", "evaluate_classifier"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load_all()
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={SPREAD: cpus})  # the tables are one small file each
    for name in WARM_UP:
        run(QUERIES[name](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    # Throughput of the aspect-sentiment job without a model step.
    n = QUERIES["absa_job"](spark, sf_dir).count()
    kept = QUERIES["comment_filter"](spark, sf_dir).count()
    comments_per_hour = round(kept / times["absa_job"] * 3600) if times["absa_job"] else None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "absa_rows": n, "absa_comments_per_hour": comments_per_hour}))
    spark.stop()


if __name__ == "__main__":
    main()
