"""Each registered query against its DuckDB SQL."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from contract.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_entry_gives_a_row_per_vector(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == ["id", "cluster_n1", "cluster_n2", "cluster_n3"]
    assert rows.count() == 500


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, name):
    frame = entry_module.queries()[name](spark, SF_DIR)
    assert differences(frame, tables, entry_module.oracle_sql()[name]) == []


def test_scan_reads_few_columns_and_pushes_the_day(spark):
    plan = entry_module.queries()["scan_day_filter"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    narrow = entry_module.queries()["existing_ids"](spark, SF_DIR)
    text = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vec_id:bigint>" in text


def test_only_documents_between_the_vectors_ids_meet_them(spark, tmp_path):
    from contract.queries import documents_near_vectors

    given = {"embeddings": "id as vec_id", "documents": "id - 5 as doc_id"}
    for name, ids in given.items():
        spark.range(3, 20 if name == "documents" else 6).selectExpr(ids, "'a' as text").write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(r.id for r in documents_near_vectors(spark, str(tmp_path)).collect()) == ["3", "4", "5"]
