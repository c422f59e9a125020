"""Choosing phrases, asking a naming client, and rolling names up the hierarchy."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from phrasegrove.functions import prompts
from phrasegrove.functions.clients import Namer, call_with_retry
from phrasegrove.functions.heaps import Nearest
from phrasegrove.operators.bounded import pin
from phrasegrove.operators.calls import call_profile, dealt
from phrasegrove.operators.packed import merged
from phrasegrove.params import NamingParams


def cluster_samples(
    df: DataFrame,
    n: int,
    cluster_col: str = "cluster_n1",
    distance_col: str = "distance",
    id_col: str = "id",
) -> DataFrame:
    """The ``n`` rows of each cluster nearest its centroid, ties by id, numbered by ``position``.

    A task keeps n rows of each cluster while it reads and never sorts its rows as a whole; what the
    tasks keep is merged in two shuffles, so a large cluster is no single group. Null distances
    come first, as in a sort.
    """
    rows = df.where(F.col(cluster_col).isNotNull()).drop("position")
    order = Nearest(n, cluster_col, distance_col, id_col)
    schema = StructType([*rows.schema, StructField("position", IntegerType(), False)])
    kept = rows.mapInArrow(order.partial, rows.schema)
    return merged(kept, [cluster_col], order.partial, order.numbered, schema)


def attach_texts(samples: DataFrame, phrases: DataFrame, id_col: str = "id") -> DataFrame:
    """The samples with the columns of ``phrases``; a sample without a phrase keeps nulls.

    Samples are few (clusters x n), so they go to the phrases and not the other way round.
    """
    chosen = pin(samples)  # read twice below
    found = phrases.join(chosen.select(id_col), id_col)
    return chosen.join(found, id_col, "left")


def sample_phrases(
    samples: DataFrame, text_col: str = "frase", cluster_col: str = "cluster_n1"
) -> DataFrame:
    """``(cluster_id, phrases)`` in the samples' order; their number bounds the array."""
    ordered = F.sort_array(
        F.collect_list(F.when(F.col(text_col).isNotNull(), F.struct("position", text_col)))
    )
    return samples.groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        F.transform(ordered, lambda s: s[text_col]).alias("phrases")
    )


def child_names(
    mapping: DataFrame, names: DataFrame, child_col: str, parent_col: str
) -> DataFrame:
    """``(cluster_id, phrases)``: the usable names of each parent's children, by child id.

    A parent has at most as many children as its level has clusters.
    """
    pairs = mapping.select(child_col, parent_col).distinct()
    named = pairs.join(names.select(F.col("cluster_id").alias(child_col), "nome"), child_col, "left")
    usable = F.col("nome").isNotNull() & (F.col("nome") != "")
    ordered = F.sort_array(F.collect_list(F.when(usable, F.struct(child_col, "nome"))))
    return named.groupBy(F.col(parent_col).alias("cluster_id")).agg(
        F.transform(ordered, lambda s: s["nome"]).alias("phrases")
    )


def naming_prompts(groups: DataFrame, level: int) -> DataFrame:
    """``(cluster_id, nivel, n_phrases, system_prompt, user_prompt)``."""
    return groups.select(
        "cluster_id",
        F.lit(level).alias("nivel"),
        F.size("phrases").alias("n_phrases"),
        prompts.system_prompt(level).alias("system_prompt"),
        prompts.user_prompt(level, "phrases").alias("user_prompt"),
    )


def ask_namer(
    asked: DataFrame, make_namer: Callable[[], Namer], params: NamingParams
) -> DataFrame:
    """``(cluster_id, nivel, nome, dor, ok)`` from a client that each task makes for itself.

    There are as many partitions as parallel calls are allowed, or with ``call_slots`` each task takes
    one of the application's slots. A group without phrases is not asked about; it, and a call that fails to the end, get the fallback record.
    """

    def answer(client, row):
        if row.n_phrases == 0:
            return None
        try:
            reply = call_with_retry(
                lambda: client.complete_json(row.system_prompt, row.user_prompt),
                params.attempts,
                params.first_delay,
            )
        except Exception:
            return None
        return reply if isinstance(reply, str) else json.dumps(reply, ensure_ascii=False)

    def run(frames):
        client = make_namer()
        for frame in frames:
            replies = [answer(client, row) for row in frame.itertuples(index=False)]
            yield frame[["cluster_id", "nivel"]].assign(answer=replies)

    replies = dealt(asked, params.max_concurrent, params.call_slots, "cluster_id").mapInPandas(
        run, "cluster_id int, nivel int, answer string", profile=call_profile(params.call_slots)
    )
    return replies.withColumn("_record", prompts.parse_answer("answer")).select(
        "cluster_id", "nivel", "_record.*"
    )


def name_level(
    groups: DataFrame, level: int, make_namer: Callable[[], Namer], params: NamingParams
) -> DataFrame:
    return ask_namer(naming_prompts(groups, level), make_namer, params)


def name_hierarchy(
    samples: DataFrame,
    mapping: DataFrame,
    make_namer: Callable[[], Namer],
    params: NamingParams,
    text_col: str = "frase",
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Names of all levels in long form ``(cluster_id, nivel, nome, dor, ok)``.

    Clusters are named from their samples, groups from their clusters' names, categories from
    their groups' names. ``keep`` stores a level's names, so that the next level and the
    final result use one set of answers and no call is repeated.
    """
    n1 = keep(name_level(sample_phrases(samples, text_col), 1, make_namer, params))
    n2 = keep(
        name_level(child_names(mapping, n1, "cluster_n1", "cluster_n2"), 2, make_namer, params)
    )
    n3 = keep(
        name_level(child_names(mapping, n2, "cluster_n2", "cluster_n3"), 3, make_namer, params)
    )
    return n1.unionByName(n2).unionByName(n3)


