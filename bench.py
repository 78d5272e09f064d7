"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores of the local session.
``BENCH_QUERIES`` (comma separated) picks queries; ``BENCH_DUCKDB=1`` also times DuckDB on the
same machine, for those queries that have a DuckDB text.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleanwell.session import local_session  # noqa: E402
from verification.compare import duckdb_over  # noqa: E402
from verification.registry import ORACLE, QUERIES  # noqa: E402

HEADLINE = [
    "reaction_counts", "reply_counts", "quality_reactions", "quality_replies",
    "export_filtered_casts", "export_quality_casts", "author_scored_casts", "top_posts_per_author",
    "high_quality_casts", "cast_score_describe", "user_activity", "user_text_features",
    "user_temporal_features", "user_engagement", "user_features", "user_segments", "sampled_users",
    "users_to_label", "cluster_representatives", "cluster_keywords", "cluster_records",
    "cluster_weights", "recommended_posts", "users_to_follow", "preference_summary", "parsed_labels",
    "quality_regression", "kmeans_topics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    picked = os.environ.get("BENCH_QUERIES")
    names = picked.split(",") if picked else HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["reaction_counts"](spark, folder).count()  # start-up is not part of any query
    seconds, beside = {}, {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_DUCKDB") and name in ORACLE:
            con = duckdb_over(folder)
            con.execute(f"SET threads = {cpus}")
            start = time.perf_counter()
            con.execute(ORACLE[name]).fetchall()
            beside[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]} {beside.get(name, '')}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if beside:
        result["duckdb"] = beside
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
