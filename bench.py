"""Times every registered query; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names (default all)

``raw_tables`` derives and writes the raw feeds, ``trusted_tables`` builds the
trusted tables from them; the queries that read them are timed after that. Every query is forced in full
through the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from dqlake.queries import QUERIES
from dqlake.queries.silver_store import store
from dqlake.session import local_session


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    spark = local_session()
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()

    times = {}
    st = store(spark, sf)
    start = time.perf_counter()
    for name in ("subjects", "visits", "adverse_events", "labs"):
        st.feed(name)
    times["raw_tables"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    for build in (st.subjects, st.history, st.visits, st.adverse_events, st.labs, st.spine):
        build()
    times["trusted_tables"] = round(time.perf_counter() - start, 3)
    for name in only or QUERIES:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
