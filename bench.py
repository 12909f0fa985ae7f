"""Time the queries and print one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set data, cores and runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quire.session import build_session  # noqa: E402
from quire.trial.catalogue import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def timed(spark, name: str) -> float:
    """Seconds from building the query to its last row; rows are computed in full and thrown away."""
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names: list[str]) -> None:
    spark = build_session(f"local[{CPUS}]", "quire-bench", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "10g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "net_sales")  # starts the executor threads and the Parquet reader
    seconds = {}
    for name in names or QUERIES:
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(FOLDER).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
