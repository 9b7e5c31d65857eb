"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated
names) other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from coppice.plans.catalog import QUERIES  # noqa: E402
from coppice.session import local_session  # noqa: E402

HEADLINE = [
    "csv_roundtrip", "row_width_hist", "null_counts", "feature_types", "candidate_splits",
    "heavy_hitter_fill", "median_impute_exact", "mode_impute", "wide_fill", "wide_features",
    "wide_numeric", "opening_hours", "exact_sample", "shuffle_positions", "positional_zip",
    "index_by_frequency", "index_many_values", "node_stats", "best_root_split", "tree_nodes",
    "shard_trees", "tree_score", "tree_accuracy", "vector_tree", "flagship", "vector_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
