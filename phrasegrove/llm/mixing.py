"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

1. The documents of a source are put in a fixed pseudo-random order (by MD5 of the id) and their
   words laid end to end; the line is cut into blocks of ``block`` words, the last one shorter.
2. Targets: the sources share ``budget`` times all words by weight. A target stops at ``repeats``
   times its source's words, and the excess is shared again by weight until none is above. The
   closed form used here fills the sources in the order of cap over weight.
3. Slot k of the schedule has the point frac(k * golden ratio), and takes the source whose
   interval of cumulative target shares holds it. Every prefix of the schedule is near the
   target mix.
4. Slots are ranked within their source; rank r takes block r modulo the number of blocks. Ranks
   beyond ``repeats`` rounds take nothing, so no document is taken more often.
5. A source that the schedule leaves off its target by more than ``NEAR`` of it, as happens with
   targets of few blocks, is settled: its line is taken from the start, round after round, for
   exactly the whole words of its target. These are the blocks of step 4, the last one cut by words.

Ranks and offsets are prefix sums in two steps, over chunks and within a chunk, so a source with a
third of all rows is no single task. The block size follows from the total, so that the schedule
has some ``SLOTS`` slots at any size of input (blocks of one word at least).

Defined cases: null and blank texts have size 0 and take 0; a null source is a source, the last
one; a source without words has target 0; repeated rows are laid on the line one after the other;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phrasegrove.llm.common import WORD, running_sum, stored

#: Slots of the schedule, about.
SLOTS = 1 << 18
#: A source stays as the schedule has it when its words are off its target by this part at most.
NEAR = 0.001
#: Golden ratio times 2^32, and the range of a point. Fixed values.
GOLDEN = 2654435769
RANGE = 1 << 32
#: Low bits of a point within its cell: there are 4,096 cells.
CELL_BITS = 20
#: Weights of the sources by rank, repeating. Fixed values of the contract.
WEIGHTS = (5, 2, 1)
#: Chunks that a source's line is dealt to by the first hex digits of the order key.
CHUNK_DIGITS = 3
#: Slots that are ranked by one task at a time.
SLOT_CHUNK = 1 << 14


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", carry=()) -> DataFrame:
    """``(doc_id, source, size, spot, ...)``: words of each document and its place in the shuffle."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("spot"),
        *carry,
    )


def targets(sizes: DataFrame, weights=WEIGHTS, budget=1.5, repeats=2) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``; one row per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    cap = F.lit(repeats) * F.col("source_size")
    rows = totals.withColumn("weight", weight).withColumn("cap", cap)
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    # The level each source would see if all sources filled before it stood at their caps.
    left = F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    rows = rows.withColumn("level", left / open_weight)
    rows = rows.withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    # Beyond the first source that stays open the levels only fall.
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return rows.select("source", "source_size", target.alias("target"))


def schedule(plan: DataFrame, block: int, total: int) -> DataFrame:
    """``(k, sid)`` of all slots: the source number whose interval holds the slot's point."""
    spark = plan.sparkSession
    slots = spark.range(total).withColumnRenamed("id", "k")
    # k is taken modulo 2^32 first, so the product fits 64 bits.
    point = F.pmod(F.pmod(F.col("k"), F.lit(RANGE)) * F.lit(GOLDEN >> 16), F.lit(RANGE)) * F.lit(1 << 16)
    point = F.pmod(point + F.pmod(F.col("k"), F.lit(RANGE)) * F.lit(GOLDEN & 0xFFFF), F.lit(RANGE))
    slots = slots.withColumn("point", point).withColumn("cell", F.shiftright("point", CELL_BITS))
    # Intervals are cut at the borders of equal cells, so slots meet them by an equality.
    wide = plan.where("lower < upper").select(
        "sid",
        "lower",
        "upper",
        F.explode(
            F.sequence(F.shiftright("lower", CELL_BITS), F.shiftright(F.col("upper") - 1, CELL_BITS))
        ).alias("cell"),
    )
    return slots.join(wide, "cell").where("lower <= point and point < upper").select("k", "sid")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = 1.5,
    repeats: int = 2,
    slots: int = SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, and the columns of
    ``carry``, whose names must differ from those of this operator's steps."""
    rows = stored(sized(docs, id_col, text_col, source_col, carry), "sizes")
    planned = targets(rows, weights, budget, repeats)
    sid = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    # The words that the mix holds by target, as whole numbers that the schedule can cut.
    share = F.floor("target").cast("bigint")
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    plan = stored(
        planned.withColumn("sid", sid).withColumn("upto", F.sum(share).over(upto)), "plan"
    )
    words = plan.agg(F.max("upto")).first()[0] or 0
    block = max(1, words // slots)
    total = -(-words // block) if words else 0
    cut = F.floor(F.col("upto") / F.lit(max(1, words)) * F.lit(RANGE)).cast("bigint")
    cut = F.when(F.col("upto") == words, F.lit(RANGE)).otherwise(cut)
    before = F.coalesce(F.lag("upper").over(Window.orderBy("sid")), F.lit(0))
    plan = plan.withColumn("upper", cut).withColumn("lower", before)

    # The line of each source, cut into blocks.
    wide = rows.join(plan.select("source", "sid"), rows.source.eqNullSafe(plan.source)).select(
        "doc_id", "size", "spot", "sid", F.substring("spot", 1, CHUNK_DIGITS).alias("chunk"), *carry
    )
    lined = running_sum(wide, "sid", "chunk", [F.col("spot"), F.col("doc_id"), F.col("size")], F.col("size"), "start")

    # Slots, ranked within their source.
    drawn = schedule(plan, block, total).withColumn("part", F.floor(F.col("k") / SLOT_CHUNK))
    ranked = running_sum(drawn, "sid", "part", [F.col("k")], F.lit(1), "rank")
    count = F.ceil(F.col("source_size") / F.lit(block)).cast("bigint")
    sources = plan.select("sid", "source_size", "target", count.alias("blocks"))
    used = (
        ranked.join(sources.select("sid", "blocks"), "sid")
        .where(F.col("rank") < F.lit(repeats) * F.col("blocks"))
        .groupBy("sid", F.pmod("rank", "blocks").alias("at"))
        .agg(F.count(F.lit(1)).alias("uses"))
    )

    # Sources that the schedule leaves off their targets get the whole words of these.
    width = F.least(F.lit(block), F.col("source_size") - F.col("at") * block)
    drawn_words = used.join(sources, "sid").groupBy("sid").agg(F.sum(F.col("uses") * width).alias("drawn"))
    off = F.abs(F.coalesce("drawn", F.lit(0)) - F.col("target")) > NEAR * F.col("target")
    sources = sources.join(drawn_words, "sid", "left").withColumn("settled", F.when(off, F.floor("target")))
    sources = stored(sources.drop("blocks", "drawn"), "sources")

    # Each document meets the blocks that it lies in.
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = lined.withColumn("no", F.monotonically_increasing_id())
    pieces = stored(pieces, "line")
    met = pieces.where("size > 0").select(
        "no", "sid", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("at")
    )
    overlap = F.least(F.col("start") + F.col("size"), (F.col("at") + 1) * block) - F.greatest("start", F.col("at") * block)
    taken = (
        met.join(used, ["sid", "at"])
        .groupBy("no")
        .agg(F.sum(overlap * F.col("uses")).alias("taken"))
    )
    again = F.expr("settled % source_size")
    settled = F.expr("settled div source_size") * F.col("size") + F.greatest(
        F.lit(0), F.least(F.col("start") + F.col("size"), again) - F.col("start")
    )
    return (
        pieces.join(taken, "no", "left")
        .join(sources, "sid")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce(settled, "taken", F.lit(0)).cast("bigint").alias("taken"),
            *carry,
        )
    )
