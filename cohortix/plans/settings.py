"""Knobs of the end-to-end jobs; the defaults are the production values."""

from __future__ import annotations

from dataclasses import dataclass, field

from cohortix import schema as S
from cohortix.operators.churn import TreeSizes


@dataclass(frozen=True)
class Settings:
    clusters: int = S.N_CLUSTERS
    sweep: tuple[int, ...] = S.SWEEP_K
    kmeans_restarts: int = S.KMEANS_RESTARTS
    mixture_restarts: int = S.MIXTURE_RESTARTS
    sample_rows: int = S.SCORE_SAMPLE
    seed: int = S.SEED
    quantiles: str = "exact"
    trees: TreeSizes = field(default_factory=TreeSizes)
