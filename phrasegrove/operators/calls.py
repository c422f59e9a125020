"""A limit of parallel calls to an outside service that holds for a whole application.

Executors are started with a number of call slots, as any other resource Spark schedules by::

    --conf spark.executor.resource.calls.amount=5
    --conf spark.executor.resource.calls.discoveryScript=/path/that/prints/the/addresses

A stage that calls the service asks for one slot a task. Then all such stages of all running jobs
together have at most as many tasks as there are slots, and a stage's partitions follow its data
and not the limit. Local mode knows no such resources; there, and with ``call_slots`` off, a stage has
``max_concurrent`` partitions, which limits that stage alone.
"""

from __future__ import annotations

from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame

RESOURCE = "calls"


def call_profile(call_slots: bool) -> ResourceProfile | None:
    """What a stage of calls asks for; None without slots."""
    if not call_slots:
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource(RESOURCE, 1)).build


def dealt(df: DataFrame, max_concurrent: int, call_slots: bool, *keys: str) -> DataFrame:
    """``df`` in the partitions that its calls run in."""
    return df.hint("rebalance", *keys) if call_slots else df.repartition(max_concurrent, *keys)


# A scan with so many partitions for each call is put together; the tasks then differ by a quarter at most.
SCANS_PER_CALL = 4


def dealt_scan(df: DataFrame, max_concurrent: int, call_slots: bool) -> DataFrame:
    """As ``dealt``, for a plain scan: where it has enough partitions, tasks read several of them
    and nothing is shuffled."""
    if not call_slots and df.rdd.getNumPartitions() >= SCANS_PER_CALL * max_concurrent:
        return df.coalesce(max_concurrent)
    return dealt(df, max_concurrent, call_slots)
