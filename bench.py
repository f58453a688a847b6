"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local threads.
Every query is planned from scratch and run to its end into the noop sink, twice; the second run counts,
as a long-lived cluster's JVMs are warm.  `cold` has the first runs.  Nothing is cached between runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suturestar.gate import registry  # noqa: E402
from suturestar.session import build_session  # noqa: E402

HEADLINE = (
    list(registry.VIEWS)
    + list(registry.REPORTS)
    + [
        "op_robot_utilization",
        "op_maintenance_costs",
        "val_unique",
        "etl_extract_procedures",
        "etl_load_telemetry",
        "scd_changed",
        "ups_procedures",
        "key_dense",
        "full_load_report",
        "star_q12",
        "a1_robots",
        "a2_robot_detail",
    ]
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    cold = {name: round(run(queries[name], spark, sf_dir), 3) for name in HEADLINE}
    seconds = {name: round(run(queries[name], spark, sf_dir), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
