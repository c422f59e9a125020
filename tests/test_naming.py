import pytest
from clients import EchoNamer
from pyspark.sql import functions as F

from phrasegrove.functions import prompts
from phrasegrove.functions.clients import TermNamer
from phrasegrove.operators import hierarchy, naming
from phrasegrove.params import NamingParams

PARAMS = NamingParams(max_concurrent=3, attempts=2, first_delay=0.0)


def test_samples_are_the_nearest_with_ties_by_id(spark):
    rows = spark.range(0, 5000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).cast("int").alias("cluster_n1"),
        F.format_string("%05d", "id").alias("id"),
        (F.floor(F.col("id") * 7919 % 1000 / 10) / 10).alias("distance"),
    )
    got = naming.cluster_samples(rows, 6)
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r.distance, r.id)):
        kept = want.setdefault(r.cluster_n1, [])
        if len(kept) < 6:
            kept.append(r.id)
    found = {}
    for r in sorted(got.collect(), key=lambda r: r.position):
        found.setdefault(r.cluster_n1, []).append(r.id)
    assert found == want
    assert "Sort" not in got._jdf.queryExecution().executedPlan().toString()


def test_prompts_and_answers(spark):
    groups = spark.createDataFrame(
        [(1, ["a", "b"]), (2, []), (3, ["boom"]), (4, ["half"]), (5, ["text"])],
        "cluster_id int, phrases array<string>",
    )
    asked = {r.cluster_id: r for r in naming.naming_prompts(groups, 1).collect()}
    assert asked[1].user_prompt.endswith("2 messages:\n\n- a\n- b")
    assert asked[2].n_phrases == 0
    named = {r.cluster_id: r for r in naming.name_level(groups, 1, EchoNamer, PARAMS).collect()}
    assert (named[1].nome, named[1].ok) == ("- b", True)
    for broken in (2, 3, 4, 5):
        assert (named[broken].nome, named[broken].dor, named[broken].ok) == ("ERRO", "ERRO", False)


def test_levels_differ_and_unknown_level_takes_1_and_3(spark):
    one = spark.createDataFrame([(1, ["x"])], "cluster_id int, phrases array<string>")
    texts = {n: naming.naming_prompts(one, n).first() for n in (1, 2, 3, 8)}
    assert len({texts[n].system_prompt for n in (1, 2, 3)}) == 3
    assert texts[8].system_prompt == texts[1].system_prompt
    assert texts[8].user_prompt == texts[3].user_prompt


def test_parse_answer(spark):
    answers = ['{"nome": "n", "dor": "d"}', '{"nome": "n"}', "{", "[]", "", None, '{"dor": null}']
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string")
    got = rows.select("i", prompts.parse_answer("a").alias("r")).select("i", "r.*").collect()
    assert [r.ok for r in sorted(got)] == [True] + [False] * 6
    assert {r.nome for r in got if not r.ok} == {"ERRO"}


def test_term_namer():
    namer = TermNamer()
    answer = namer.complete_json("", "head\n\n- conta bloqueada\n- conta de luz")
    assert answer == {"nome": "conta bloqueada luz", "dor": "conta, bloqueada, luz"}
    with pytest.raises(ValueError):
        namer.complete_json("", "head\n\n- 12 ab")


def mapping_and_names(spark):
    mapping = spark.createDataFrame(
        [(0, 0, 0), (1, 0, 0), (2, 1, 0), (3, 2, 1)],
        "cluster_n1 int, cluster_n2 int, cluster_n3 int",
    )
    names = spark.createDataFrame(
        [(0, 1, "a", "x"), (1, 1, "b", "y"), (2, 1, "", "z"), (0, 2, "ab", "w")],
        "cluster_id int, nivel int, nome string, dor string",
    )
    return mapping, names


def test_child_names_drop_empty_ones_and_keep_all_parents(spark):
    mapping, names = mapping_and_names(spark)
    groups = naming.child_names(mapping, names.where("nivel = 1"), "cluster_n1", "cluster_n2")
    assert {r.cluster_id: r.phrases for r in groups.collect()} == {0: ["a", "b"], 1: [], 2: []}


def test_wide_and_long_names(spark):
    mapping, names = mapping_and_names(spark)
    wide = hierarchy.names_wide(mapping, names)
    assert wide.columns == hierarchy.WIDE_COLUMNS
    rows = {r.cluster_n1: r for r in wide.collect()}
    assert (rows[1].nome_n1, rows[1].nome_n2, rows[1].nome_n3) == ("b", "ab", None)
    long = hierarchy.names_long(wide)
    assert long.count() == 4 + 3 + 2
    assert hierarchy.names_wide(mapping, long).exceptAll(wide).isEmpty()


def test_names_are_null_where_missing(spark):
    mapping, names = mapping_and_names(spark)
    named = {r.cluster_n1: r for r in hierarchy.with_names(mapping, names).collect()}
    assert named[3].nome_n1 is None and named[0].nome_n2 == "ab"
    without = hierarchy.with_names(mapping, None)
    assert without.where("nome_n1 is not null or dor_n3 is not null").isEmpty()
    assert set(without.columns) == set(hierarchy.WIDE_COLUMNS)


def test_a_cluster_without_a_mapping_row_keeps_nulls(spark):
    mapping, _ = mapping_and_names(spark)
    points = spark.createDataFrame([("p", 0), ("q", 77), ("r", None)], "id string, cluster_n1 int")
    rows = {r.id: (r.cluster_n2, r.cluster_n3) for r in hierarchy.with_parents(points, mapping).collect()}
    assert rows == {"p": (0, 0), "q": (None, None), "r": (None, None)}
