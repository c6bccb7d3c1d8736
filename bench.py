"""Run the queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full into a sink that drops the rows. The time includes
building the DataFrame, as some operators store intermediate tables on the way. Inputs
that several queries share (the lake, the dimensions, the stored fact) are made first and
have times of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from landfall.session import local_session
from verification.queries import all_queries, shared_inputs


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    inputs = {}
    for name, make in () if sys.argv[1:] else shared_inputs().items():
        began = time.perf_counter()
        make(spark, sf_dir)
        inputs[name] = round(time.perf_counter() - began, 3)

    wanted = sys.argv[1:] or list(all_queries())
    seconds = {}
    for name in wanted:
        began = time.perf_counter()
        all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()) + sum(inputs.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "inputs": inputs,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
