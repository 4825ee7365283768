"""Time the registered views and main operators at $BENCH_SF_DIR; print one JSON line.

Each query is planned and run to the end (all rows produced, none kept) twice; the better time
counts. Before the first, one query warms the JVM up.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clientele.plans.views import VIEWS
from clientele.queries import GOLD, registry
from clientele.session import local_session

OPERATORS = [
    "clean_customers",
    "clean_transactions",
    "clean_support",
    "clean_web",
    *GOLD,
    "upsert_transactions",
    "session_row_numbers",
    "quality_orphans",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cpus, "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    queries = registry()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("customer_lifetime_value")
    seconds = {name: round(min(run(name), run(name)), 3) for name in [*VIEWS, *OPERATORS]}
    print(
        json.dumps(
            {
                "metric": "total seconds of views and main operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
