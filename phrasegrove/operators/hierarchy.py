"""The three-level hierarchy: its map, and looking it up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.operators.bounded import left_join_dimension
from phrasegrove.operators.nearest import nearest_centroid

LEVELS = (1, 2, 3)


def cluster_mapping(n1: DataFrame, n2: DataFrame, n3: DataFrame) -> DataFrame:
    """``(cluster_n1, cluster_n2, cluster_n3)``, one row per N1 centroid.

    Each argument holds a level's ``(cluster_id, centroid)`` rows; a centroid's parent is
    the nearest centroid of the level above.
    """

    def parents(children, above, child, parent):
        found = nearest_centroid(children, above, "centroid", parent)
        return found.select(F.col("cluster_id").alias(child), parent)

    lower = parents(n1, n2, "cluster_n1", "cluster_n2")
    upper = parents(n2, n3, "cluster_n2", "cluster_n3")
    return lower.join(upper, "cluster_n2").select("cluster_n1", "cluster_n2", "cluster_n3")


def with_parents(points: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``cluster_n2`` and ``cluster_n3``; null where the mapping lacks the cluster."""
    columns = mapping.select("cluster_n1", "cluster_n2", "cluster_n3")
    joined = left_join_dimension(points, columns, "cluster_n1")
    return joined.select(*points.columns, "cluster_n2", "cluster_n3")


def assign_hierarchy(
    points: DataFrame, centroid_rows: DataFrame, mapping: DataFrame, vec_col: str = "embedding"
) -> DataFrame:
    """Nearest N1 centroid, then its parent and grandparent."""
    return with_parents(
        nearest_centroid(points, centroid_rows, vec_col, "cluster_n1"), mapping
    )


def level_names(names: DataFrame, level: int) -> DataFrame:
    return names.where(F.col("nivel") == level).select(
        F.col("cluster_id").alias(f"cluster_n{level}"),
        F.col("nome").alias(f"nome_n{level}"),
        F.col("dor").alias(f"dor_n{level}"),
    )


WIDE_COLUMNS = [f"cluster_n{n}" for n in LEVELS] + [
    f"{field}_n{n}" for n in LEVELS for field in ("nome", "dor")
]


def names_wide(mapping: DataFrame, names: DataFrame) -> DataFrame:
    """One row per N1 cluster with the names of all three levels; a missing name is null."""
    wide = mapping
    for level in LEVELS:
        wide = wide.join(level_names(names, level), f"cluster_n{level}", "left")
    return wide.select(*WIDE_COLUMNS)


def names_long(wide: DataFrame) -> DataFrame:
    """``(cluster_id, nivel, nome, dor)``: the wide rows taken apart, each cluster once."""
    cells = F.array(
        *[
            F.struct(
                F.col(f"cluster_n{n}").alias("cluster_id"),
                F.lit(n).alias("nivel"),
                F.col(f"nome_n{n}").alias("nome"),
                F.col(f"dor_n{n}").alias("dor"),
            )
            for n in LEVELS
        ]
    )
    return wide.select(F.inline(cells)).where(F.col("cluster_id").isNotNull()).distinct()


def attach_names(assigned: DataFrame, wide: DataFrame | None) -> DataFrame:
    """Add name and pain of all three levels from ``names_wide`` rows; nulls without any.

    Stored rows, of a size that Spark knows before it plans, are broadcast when that allows. Rows still
    to be joined look large to it, and all of ``assigned`` would be shuffled by cluster.
    """
    if wide is None:
        fields = [f"{field}_n{level}" for level in LEVELS for field in ("nome", "dor")]
        return assigned.withColumns({field: F.lit(None).cast("string") for field in fields})
    keys = [f"cluster_n{level}" for level in LEVELS]
    # A row without a cluster stays without names.
    wide = wide.where(F.col(keys[0]).isNotNull()).withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(keys[0]) == F.col(f"_{keys[0]}")]
    same += [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys[1:]]
    return assigned.join(wide, same, "left").drop(*(f"_{key}" for key in keys))


def with_names(
    assigned: DataFrame, names: DataFrame | None, mapping: DataFrame | None = None
) -> DataFrame:
    """Add name and pain of all three levels to rows that carry the three cluster ids.

    The names of all levels are one row per N1 cluster of ``mapping`` (or of the rows' own ids),
    so there is one join. Without a names table the columns are null.
    """
    if names is None:
        return attach_names(assigned, None)
    keys = [f"cluster_n{level}" for level in LEVELS]
    pairs = assigned.select(*keys).distinct() if mapping is None else mapping.select(*keys)
    return attach_names(assigned, names_wide(pairs, names))
