"""Times the headline queries and prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (optional comma list of query-name prefixes).

Each query is fully executed by writing it to the ``noop`` sink, so every
row is produced but nothing is gathered on the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from intactly import plans  # noqa: E402
from intactly.session import build_session  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    prefixes = [p for p in os.environ.get("BENCH_QUERIES", "").split(",") if p]
    spark = build_session(f"local[{cpus}]", app="intactly-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="intactly-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    # Generic JVM warm-up (scan, hash, shuffle, join, window) on generated rows,
    # so the first timed query does not carry the JIT start-up cost.
    warm = spark.range(200_000).selectExpr("id", "sha2(cast(id AS string), 256) AS h", "id % 97 AS k")
    (warm.join(warm.groupBy("k").count(), "k")
     .selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY id) AS rn")
     .write.format("noop").mode("overwrite").save())
    # Start the Python workers used by the file-level (mapInPandas) operators.
    spark.range(64).repartition(cpus).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in plans.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep timing the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    # Decode throughput of the honest full-decode query (rows of lineitem per second).
    rates = {}
    if "q01_decode_rowcount" in timings:
        n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        rates["q01_rows_per_sec"] = round(n / timings["q01_decode_rowcount"])
    match = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        **rates,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
