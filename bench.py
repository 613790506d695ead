"""Times the warehouse's tables, queries and batch jobs, and prints one JSON line.

Tables that several queries read are built first, each under a name of its own (``build_*``), so a
query's time is its own. A query of under two seconds is timed three times and its median counts.

``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) is the input, ``$BENCH_CPUS``
(default 8) the number of local threads. Each query runs in full into a sink that
drops its rows. ``BENCH_QUERIES`` may name a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesloom import registry  # noqa: E402
from salesloom.jobs import warehouse  # noqa: E402
from salesloom.session import build_session  # noqa: E402
from salesloom.sources.tables import FileStore  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action, again: float = 0) -> None:
        """Seconds of the action; the median of three if the first takes less than ``again``."""
        took = []
        while not took or len(took) < 3 and took[0] < again:
            start = time.perf_counter()
            action()
            took.append(time.perf_counter() - start)
        times[name] = round(sorted(took)[len(took) // 2], 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    def run(query) -> None:
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()
    timed("build_staging", lambda: registry.staging(spark, sf_dir))
    if not chosen:
        timed("build_broken_staging", lambda: registry.broken_staging(spark, sf_dir))
        timed("build_star", lambda: registry.star_tables(spark, sf_dir))
        timed("build_snowflake", lambda: registry.stored_snowflake(spark, sf_dir))
        timed("build_snowflake_dense", lambda: registry.stored_dimensions(spark, sf_dir, True))
        timed("build_audit", lambda: registry.audited_snowflake(
            spark, sf_dir, registry.staging(spark, sf_dir), "audit"
        ))
        timed("build_audit_broken", lambda: registry.audited_snowflake(
            spark, sf_dir, registry.broken_staging(spark, sf_dir), "audit-broken"
        ))
        timed("build_two_loads", lambda: registry.two_loads(spark, sf_dir))
    for name, query in registry.QUERIES.items():
        if not chosen or name in chosen:
            timed(name, lambda query=query: run(query), again=2)
    if not chosen:
        out = FileStore(f"{scratch}/warehouse")
        staged = registry.staging(spark, sf_dir)
        timed("job_staging", lambda: out.write(staged, warehouse.STAGING))
        timed("job_snowflake", lambda: warehouse.build_snowflake(spark, out, out))
        timed("job_star", lambda: warehouse.build_star(spark, out, out))
        narrow = FileStore(f"{scratch}/packed")
        timed("job_star_packed", lambda: warehouse.build_star(spark, out, narrow, pack=True))
        timed("job_months", lambda: warehouse.build_months(spark, out, narrow))
        timed("job_marts", lambda: warehouse.build_marts(spark, out, out))
    registry.discard(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of all queries and jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
