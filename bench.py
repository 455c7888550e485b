"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is fully executed through Spark's no-op sink (no collect to the
driver), after one untimed warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.session import local_session  # noqa: E402
from tidemark.registry import queries  # noqa: E402

HEADLINE = [
    "itemcf_eval",
    "itemcf_recommend",
    "user_tag_top5",
    "blend",
    "tfidf",
    "cooccurrence",
    "encode_unk",
    "transitions",
    "viterbi",
    "sessions",
    "ab_metrics",
    "info_gain",
    "nb_accuracy",
    "knn_exact",
    "bm25_retrieve",
    "qa_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    qs = queries()
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
