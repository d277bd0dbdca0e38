"""Seconds per headline query. Prints one JSON line.

Every query starts from the raw table and builds all of its own intermediate tables; nothing is shared
between two measurements.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellamp.plans.queries import QUERIES  # noqa: E402
from cellamp.session import local_session  # noqa: E402

HEADLINE = (
    "looked_linear", "primed_circ", "hamming1_candidates", "rescue_status", "merge_table", "cell_summary",
    "pair_counts", "chunk_assign", "umi_edges_unanchored", "collapsed_cells", "mutation_fraction",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session pays for starting the Python workers and compiling; it is run once unmeasured.
    QUERIES["primer_shift"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
