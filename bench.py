"""Seconds per query at ``$BENCH_SF_DIR``, on ``local[$BENCH_CPUS]``; one JSON line.

Each query is written out in full to a sink that keeps nothing. ``plain_*`` are the
yardsticks: a bare read and write of the same tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from mirrorwell.plans.queries import QUERIES, table
from mirrorwell.session import work_dir

REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))


def _plain(name: str):
    def run(spark, sf_dir):
        path = work_dir(spark, f"plain-{name}")
        df = table(spark, sf_dir, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mirrorwell-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mirrorwell-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    todo = {f"plain_{t}": _plain(t) for t in ("orders", "lineitem", "documents", "events")}
    todo |= {k: q for k, q in QUERIES.items()}
    chosen = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    if chosen:
        todo = {k: todo[k] for k in chosen}
    table(spark, sf_dir, "lineitem").write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name, run in todo.items():
        best = None
        for _ in range(REPEATS):
            started = time.monotonic()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.monotonic() - started
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    rows = {
        t: table(spark, sf_dir, t).count() for t in ("orders", "lineitem", "documents", "events")
    }
    pairs = {
        "plain_orders": "orders", "copy_direct": "orders", "plain_lineitem": "lineitem",
        "copy_parallel": "lineitem", "plain_documents": "documents", "copy_chunked": "documents",
        "plain_events": "events", "merge_chunks": "events", "copy_ranged": "events",
    }
    speed = {q: round(rows[t] / seconds[q]) for q, t in pairs.items() if q in seconds}
    plain = {k: seconds.pop(k) for k in list(seconds) if k.startswith("plain_")}
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "plain_read_write": plain,
        "rows_per_second": speed,
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
