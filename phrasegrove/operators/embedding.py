"""Embedding phrases inside the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions.clients import Embedder, call_with_retry
from phrasegrove.functions.memory import give_back
from phrasegrove.operators.calls import call_profile, dealt, dealt_scan
from phrasegrove.params import EmbedParams


def embed_phrases(
    df: DataFrame,
    make_embedder: Callable[[], Embedder],
    params: EmbedParams,
    id_col: str = "id",
    text_col: str = "frase",
    scanned: bool = False,
) -> DataFrame:
    """``(id, frase, embedding)`` from a client that each task makes for itself.

    A task calls its client one batch at a time, so the number of partitions is the number of
    parallel calls, or with ``call_slots`` the number of the application's slots. Phrases are dealt
    to them in turn, so copies of an id do not meet. A call that fails to the end, or answers
    with a wrong number or size of vectors, fails the job; no phrase is lost unnoticed. ``scanned``
    says that ``df`` is a plain scan of files that hold the phrases in random order.
    """

    def embed(parts: list[pa.RecordBatch], client) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        texts = rows.column("frase").to_pylist()
        vectors = call_with_retry(
            lambda: client.embed_batch(texts),
            params.attempts,
            params.first_delay,
            before=getattr(client, "refresh_token", None),
        )
        sizes = {len(v) for v in vectors}
        if len(vectors) != len(texts) or sizes - {params.dims}:
            raise ValueError(
                f"asked for {len(texts)} vectors of {params.dims}, got {len(vectors)} "
                f"of sizes {sorted(sizes)}"
            )
        ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * params.dims)
        lists = pa.ListArray.from_arrays(ends, pa.array(np.asarray(vectors, "f4").ravel()))
        columns = [rows.column(name).combine_chunks() for name in ("id", "frase")]
        return pa.RecordBatch.from_arrays([*columns, lists], names=["id", "frase", "embedding"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_embedder()
        # Parts of the batch that waits to be full; only a full one becomes Python objects.
        waiting, room = [], params.batch_size
        for batch in batches:
            at = 0
            while batch.num_rows - at >= room:
                yield embed([*waiting, batch.slice(at, room)], client)
                at += room
                waiting, room = [], params.batch_size
            if at < batch.num_rows:
                waiting.append(batch.slice(at))
                room -= batch.num_rows - at
        if waiting:
            yield embed(waiting, client)
        del client, waiting
        give_back()

    phrases = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("frase"))
    deal = dealt_scan if scanned else dealt
    return deal(phrases, params.max_concurrent, params.call_slots).mapInArrow(
        run, "id string, frase string, embedding array<float>", profile=call_profile(params.call_slots)
    )
