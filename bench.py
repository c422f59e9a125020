"""Times the headline queries and prints one JSON line.

Every query runs once to warm up, then twice; the faster run counts. ``kmeans_k*`` is the work of the
baseline's cells: one k-means fit and its silhouette on vectors reduced to 16 axes.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import queries as q  # noqa: E402
from phrasegrove.operators import training  # noqa: E402

HEADLINE = (
    "assign_hierarchy",
    "nearest_centroid",
    "lloyd_step",
    "silhouette",
    "wcss",
    "covariance",
    "l2_normalize",
    "elbow",
    "new_phrases",
    "embedding_reconcile",
    "phrase_batches",
    "embed_documents",
    "cluster_samples",
    "enrich_names",
    "train_hierarchy",
    "stream_assign",
)
BASELINE_KS = (2, 5, 10, 20, 50)


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def best(work) -> float:
    work()
    return min(timed(work) for _ in range(2))


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = q.prepared(q.QUERIES[name])
        seconds[name] = best(lambda: drain(query(spark, sf_dir)))
    with training.kept(q.features(spark, sf_dir)) as rows:
        n = rows.count()
        for k in BASELINE_KS:
            seconds[f"kmeans_k{k}"] = best(
                lambda: training.fit_level(
                    rows, k, 1, training.kmeans(q.SMALL), training.FEATURES_COL, n
                )
            )
    spark.stop()
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
