"""Times every registered query and prints one JSON line.

Each query is planned and written to a no-op sink, so that all its columns are
computed. Headline queries give the better of two runs, since the first also
compiles code; the others run once in the warm session.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from emberlake import build_session
from emberlake.queries import registry
from emberlake.session import use_local_scratch

HEADLINE = ("star_inner", "overview_kpis", "build_fact", "upsert")


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_scratch(tempfile.mkdtemp(prefix="run-"))
    times = {}
    for name, query in registry().items():
        runs = 2 if name in HEADLINE else 1
        times[name] = round(min(seconds(lambda: query.run(spark, folder)) for _ in range(runs)), 4)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in HEADLINE), 4),
        "unit": "sec",
        "queries": times,
        "headline": list(HEADLINE),
        "all_queries_total": round(sum(times.values()), 4),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
