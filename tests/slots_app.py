"""An application of its own, with executors that have call slots: run by test_calls.py."""

import os
import stat
import sys
import tempfile
import threading
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from phrasegrove.operators.embedding import embed_phrases  # noqa: E402
from phrasegrove.params import EmbedParams  # noqa: E402
from phrasegrove.plans.ship import ship_package  # noqa: E402


def clocked(folder):
    """A client that notes when each of its calls began and ended."""

    class Clocked:
        def embed_batch(self, texts):
            began = time.time()
            time.sleep(0.4)
            name = f"{os.getpid()}-{began}"
            Path(folder, name).write_text(f"{began} {time.time()}")
            return [[0.0] for _ in texts]

    return Clocked


def main() -> None:
    folder = tempfile.mkdtemp(prefix="slots-")
    script = Path(folder, "addresses.sh")
    script.write_text('#!/bin/sh\necho \'{"name": "calls", "addresses": ["0"]}\'\n')
    script.chmod(script.stat().st_mode | stat.S_IEXEC)
    calls = Path(folder, "calls")
    calls.mkdir()
    spark = (
        SparkSession.builder.master("local-cluster[2,2,1024]")
        .config("spark.executor.memory", "512m")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.executor.resource.calls.amount", "1")
        .config("spark.executor.resource.calls.discoveryScript", str(script))
        .config("spark.worker.resource.calls.amount", "1")
        .config("spark.worker.resource.calls.discoveryScript", str(script))
        .config("spark.task.resource.calls.amount", "0.5")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "9000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    params = replace(EmbedParams(), call_slots=True, batch_size=50, dims=1)
    phrases = spark.range(0, 600, 1, 6).select(F.col("id").cast("string").alias("id"), F.lit("x" * 40).alias("frase"))
    done = []

    def run():
        done.append(embed_phrases(phrases, clocked(str(calls)), params).count())

    both = [threading.Thread(target=run) for _ in range(2)]
    for thread in both:
        thread.start()
    for thread in both:
        thread.join()
    spans = [tuple(map(float, p.read_text().split())) for p in calls.iterdir()]
    most = max(sum(a <= at < b for a, b in spans) for at, _ in spans)
    print(f"rows {done} calls {len(spans)} at once {most}")
    spark.stop()


if __name__ == "__main__":
    main()
