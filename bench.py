"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postpulse.checks.queries import QUERIES  # noqa: E402
from postpulse.session import build_session  # noqa: E402

HEADLINE = (
    "clean_dataframe", "dedupe_by_hash", "individual_signals", "generate_signals", "gap_fill_windows",
    "fit_vocabulary", "tfidf_vectors", "tfidf_row_stats", "sample_systematic", "signals_by_hour_day",
    "cap_per_source", "query_time_range", "hashtag_distribution", "rate_audit", "endpoint_summary",
    "stream_signals",
)
# Published rates of the reference, rows per second.
CLAIMED = {"clean_dataframe": 1000, "generate_signals": 100}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    QUERIES["make_tweets"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "posts": rows,
                "posts_per_sec": {n: round(rows / times[n]) for n in CLAIMED},
                "claimed_posts_per_sec": CLAIMED,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
