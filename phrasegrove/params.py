"""Tunables of the three jobs. The defaults are fixed values of the method."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ClusterParams:
    k_n1: int = 1000
    k_n2: int = 200
    k_n3: int = 50
    init_mode: str = "k-means||"
    init_steps: int = 5
    max_iter: int = 50
    seed: int = 42
    tol: float = 1e-4
    # "block" gives the same result faster, but Spark 4.1 fails in it when the data hold fewer
    # distinct points than k; choose it only where that cannot be.
    solver: str = "auto"
    pca_dims: int = 128
    pca_solver: str = "exact"  # or "range", whose driver memory is dims x axes
    k_candidates: tuple[int, ...] = (50, 100, 200, 300, 500, 750, 1000)
    sample_fraction: float = 0.2
    coreset_per_k: int = 20  # rows of the sweep's coreset, for each cluster of the largest candidate
    silhouette_threshold: float = 0.3
    sweep: bool = True

    @property
    def level_ks(self) -> tuple[int, int, int]:
        return self.k_n1, self.k_n2, self.k_n3


@dataclass(frozen=True)
class EmbedParams:
    batch_size: int = 500
    max_concurrent: int = 20
    attempts: int = 3
    first_delay: float = 2.0
    dims: int = 384
    call_slots: bool = False  # limit calls by the executors' slots, not by max_concurrent
    rows_per_task: int = 50_000  # phrases a lost task has to embed again, at most


@dataclass(frozen=True)
class NamingParams:
    samples_per_cluster: int = 10
    max_concurrent: int = 20
    call_slots: bool = False
    attempts: int = 3
    first_delay: float = 2.0


@dataclass(frozen=True)
class Tables:
    """Catalog names of the tables and the folder that holds the fitted models."""

    raw: str
    embeddings: str
    output: str
    mapping: str
    names: str
    metrics: str
    models: str
    quarantine: str = ""  # rows that a job cannot use; by default beside the output table
    # Vectors by the text's digest, and ids found without a text; by default beside the embeddings.
    digests: str = ""
    textless: str = ""

    @property
    def quarantine_table(self) -> str:
        return self.quarantine or f"{self.output}_quarantine"

    @property
    def digests_table(self) -> str:
        return self.digests or f"{self.embeddings}_digests"

    @property
    def textless_table(self) -> str:
        return self.textless or f"{self.embeddings}_textless"
