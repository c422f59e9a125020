"""The row forms of the model queries, against brute force over the same vectors."""

import numpy as np
import pytest

import __spark_entry__ as entry_module
from contract import queries as cq
from phrasegrove.operators import training

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def unit(spark):
    rows = cq.vectors(spark, SF_DIR).collect()
    x = np.array([r.embedding for r in rows], float)
    return [r.id for r in rows], x / np.linalg.norm(x, axis=1, keepdims=True)


def ask(spark, name):
    return entry_module.queries()[name](spark, SF_DIR)


def test_pca_project_rows(spark, unit):
    ids, x = unit
    rows = ask(spark, "pca_project_rows").collect()
    got = np.zeros((len(ids), cq.SMALL.pca_dims))
    at = {i: n for n, i in enumerate(ids)}
    for r in rows:
        got[at[r.id], r.dim] = r.value
    assert len(rows) == got.size
    _, axes = np.linalg.eigh(np.cov(x.T))
    want = x @ axes[:, ::-1][:, : cq.SMALL.pca_dims]
    # An axis has no sign of its own.
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)


def test_train_hierarchy_rows(spark, unit):
    ids, x = unit
    trained = training.train_hierarchy(cq.vectors(spark, SF_DIR), cq.SMALL)
    stages = trained.pipeline.stages
    pca = next(s for s in stages if hasattr(s, "pc"))
    centres = np.array(next(s for s in stages if hasattr(s, "clusterCenters")).clusterCenters())
    points = x @ pca.pc.toArray()
    near = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    tree = {r.cluster_n1: (r.cluster_n2, r.cluster_n3) for r in trained.mapping.collect()}
    want = {i: (int(n), *tree[int(n)]) for i, n in zip(ids, near)}
    got = {r.id: tuple(r[1:]) for r in ask(spark, "train_hierarchy_rows").collect()}
    assert got == want


def test_measure_rows(spark):
    ks = list(cq.SMALL.k_candidates)
    sweep = {r.k: r for r in ask(spark, "k_sweep_rows").collect()}
    table = {r.k_n1: r for r in ask(spark, "k_sweep_metrics_rows").collect()}
    assert sorted(sweep) == sorted(table) == ks
    for k in ks:
        assert table[k].inertia_n1 == pytest.approx(sweep[k].inertia, rel=1e-5)
        assert table[k].silhouette_n1 == pytest.approx(sweep[k].silhouette, rel=1e-5)
    assert ask(spark, "train_level_rows").count() == len(ks)


def test_job_rows(spark):
    out = ask(spark, "job_assignment_rows")
    counts = ask(spark, "job_assignment").first()
    assert "cluster_n3" in out.columns and out.count() == counts.n_out
    assert ask(spark, "job_training_rows").count() == len(cq.SMALL.k_candidates) + 1
