"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to the end without collecting rows: once to warm up the JVM, then
three times, of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicloom.plans.catalog import catalog  # noqa: E402
from topicloom.session import build_session  # noqa: E402

HEADLINE = [
    "clean_events",
    "null_profile",
    "user_topic_bag",
    "user_topic_star",
    "user_topic_counts",
    "user_topic_counts_star",
    "user_topic_day",
    "user_topic_day_star",
    "topic_user_day",
    "topic_user_day_star",
    "user_repo_day_star",
    "follow_edges",
    "user_user",
    "user_user_star",
    "popular_users",
    "network_topics",
    "network_topics_star",
    "topic_users",
    "topic_users_star",
    "network_topic_users",
    "publish_topic_user",
    "network_topics_requests",
    "topic_users_any_window",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = catalog()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    seconds = {name: round(min(run(name) for _ in range(RUNS)), 3) for name in names}
    spark.stop()
    result = {
        "metric": "total time of the headline queries, best of three warm runs each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
