"""Times the headline queries and prints one JSON line.

One query runs untimed first, so that none pays for the session start; each is then timed once, from building
the plan to a full write to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsweave.plans import registry  # noqa: E402
from newsweave.session import clean_up, local_session  # noqa: E402

HEADLINES = [
    "flag_union", "dedupe_keep_last", "relevance_by_publisher", "length_histogram", "duplicate_rows", "article_features",
    "gazetteer_entities", "cooccurrence_edges", "parse_responses", "explode_relationships", "graph_table_edges",
    "edge_weights", "collapse_multi_edges", "dominant_sentiment", "degree_centrality", "label_threshold", "ego_search", "khop",
    "graph_view_nodes", "graph_view_edges", "explorer_edges", "top_nodes", "modularity", "pagerank", "bipartite_weights",
    "bipartite_degrees", "bipartite_pagerank", "similar_pairs", "greedy_clusters", "resolved_graph", "threshold_sweep",
    "roc_auc", "calibration", "stratified_split", "daily_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINES
    spark = local_session("bench", cores, partitions=int(cores))
    queries = registry.queries()
    queries["edge_weights"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    clean_up(spark)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
