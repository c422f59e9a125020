import hashlib

from pyspark.sql import functions as F

from phrasegrove.llm import warc_fixity as wf


def manifest(spark, n=3000, files=4):
    rows = [
        (i % files, (i // files) * 700, 690, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(n)
    ]
    return spark.createDataFrame(rows, "file bigint, offset bigint, length bigint, digest string")


def found(a, b):
    return sorted((r.file, r.offset, r.status) for r in wf.audit(a, b).collect())


def test_damage_is_located(spark):
    a = manifest(spark)
    b = (
        a.where("not (file = 2 and offset = 7000)")
        .withColumn("digest", F.when(F.expr("file = 1 and offset in (0, 140000)"), "x").otherwise(F.col("digest")))
        .withColumn("length", F.when(F.expr("file = 0 and offset = 700"), 1).otherwise(F.col("length")))
        .union(a.where("file = 3 and offset = 0").withColumn("offset", F.lit(350).cast("bigint")))
    )
    assert found(a, b) == [(0, 700, "changed"), (1, 0, "changed"), (1, 140000, "changed"), (2, 7000, "missing"), (3, 350, "added")]
    assert (3, 350, "missing") in found(b, a)
    assert found(a, a) == []


def test_whole_files_and_empty_sides(spark):
    a = manifest(spark, 40, 2)
    assert [f[2] for f in found(a, a.where("file = 0"))] == ["missing"] * 20
    assert [f[2] for f in found(a.where("false"), a)] == ["added"] * 40
    assert found(a.where("false"), a.where("false")) == []


def test_only_differing_branches_are_compared(spark):
    a = manifest(spark)
    levels = wf.height(a)
    assert levels >= 2
    roots = wf.tree(a, levels)[-1]
    assert roots.count() == 4


def test_records_lie_end_to_end(spark):
    rows = [(i % 5 if i % 3 else None, f"u{i}", None if i % 7 == 0 else "é" * (i % 11)) for i in range(200)]
    rows += rows[:20]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("at", F.lit(1))
    record = wf.warc_record(F.col("url"), F.col("html"))
    placed = wf.place(
        pages.withColumn("digest", F.sha2(record, 256)).withColumn("length", F.octet_length(record).cast("bigint"))
    ).collect()
    assert len(placed) == 220
    by = {}
    for r in placed:
        by.setdefault(r.file, []).append((r.offset, r.length))
    assert sorted(by) == [-1, 0]
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
