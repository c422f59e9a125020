"""Assigning clusters to a stream of embeddings. The step keeps no state, so it needs no watermark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from phrasegrove.params import Tables
from phrasegrove.plans import checks, jobs
from phrasegrove.sources.tables import replace_part


def stream_assign(
    source: DataFrame,
    assign: Callable[[DataFrame], DataFrame],
    output_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Run a batch assignment function on a stream, write parquet, and stop when caught up.

    ``assign`` must be row-wise with stream-static joins only, as all assignment functions
    here are; the sink's log makes every input row appear once, also after a restart.
    """
    return (
        assign(source)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


@dataclass
class BatchAssigner:
    """Assignment of a stream of embeddings, micro-batch by micro-batch, by the current run.

    Every batch asks for the current training run, so one that is published meanwhile counts from
    the next batch on; a run's parts are loaded once. Output and quarantine are tables with a
    partition per ``(stream, batch)``. A batch that runs again, as after a restart, replaces its
    partitions, so nothing is repeated; ``stream`` must be another name for each checkpoint.
    """

    tables: Tables
    stream: str
    dims: int
    now: Callable[[], datetime]
    run: jobs.Run | None = None

    @property
    def output(self) -> str:
        return f"{self.tables.output}_stream"

    @property
    def quarantine(self) -> str:
        return f"{self.tables.quarantine_table}_stream"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = jobs.current_run(spark, self.tables)
        if self.run is None or self.run.run_id != run_id:
            self.run = jobs.load_run(spark, self.tables, run_id)
        rows = batch.select("id", "frase", "embedding")
        output, broken = jobs.outcome(self.run, rows, self.dims, self.now())
        part = {"stream": self.stream, "batch": batch_id}
        replace_part(output.withColumn("run_id", F.lit(run_id)), self.output, part)
        replace_part(broken, self.quarantine, part)


def assign_stream(source: DataFrame, assigner: BatchAssigner, checkpoint_path: str) -> StreamingQuery:
    """Assign what the stream of ``(id, frase, embedding)`` holds, and stop when caught up."""
    checks.require(checks.model_present(source.sparkSession, jobs.runs_path(assigner.tables)))
    return (
        source.writeStream.foreachBatch(assigner)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
