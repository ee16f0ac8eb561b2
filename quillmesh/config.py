"""Every constant of the engine in one frozen object; jobs pass a changed copy where they need one."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # blocking
    ean_group: tuple[int, int] = (2, 50)
    knn_k: int = 15
    knn_cells: int = 0  # cells of the neighbour search; 0 searches all vectors
    knn_probes: int = 8
    min_similarity: float = 0.60
    weight_ean: float = 1.0
    weight_brand_tokens: float = 0.9
    weight_embedding: float = 0.85
    price_penalty: float = 0.15
    price_penalty_ratio: float = 3.0
    brand_boost: float = 0.10
    brand_penalty: float = 0.7
    jaccard_trigger: float = 0.5
    jaccard_factor: float = 0.1
    brand_group_most: int = 200
    brand_jaccard_least: float = 0.4
    # clustering
    resolution: float = 1.0
    seed: int = 42
    # scoring
    score_ok: float = 0.75
    score_quarantine: float = 0.30
    band: tuple[float, float] = (0.85, 1.15)
    match_ratio: float = 1.15
    blocker_ratio: float = 1.3
    dominance_numeric: float = 0.4
    dominance_string: float = 0.5
    outlier_cluster: int = 5
    core_members: int = 20
    core_share: float = 0.3
    price_iqr: float = 1.5
    price_group_least: int = 4
    # anomaly
    small_cluster: int = 2
    anomaly_distance: float = 0.15
    # routing and review
    rerank_ok: float = 0.85
    rerank_quarantine: float = 0.20
    infer_sources: int = 3
    hard_cap: float = 2.0
    soft_cap: float = 1.15
    new_cluster_least: int = 4
    arbiter_batch: int = 50
    image_ambiguous: float = 0.03
    image_consistency: float = 0.02
    function_majority: int = 2
    attr_dedup: float = 0.05
    # calibration and mining
    weights_cluster: tuple[int, int] = (5, 100)
    weights_block: float = 0.70
    weights_values: int = 3
    weights_clusters: int = 3
    coherence_cluster: int = 3
    coherence_clusters: int = 30
    coherence_names: int = 20
    thresholds: tuple[float, float, float] = (0.70, 0.75, 0.80)
    pairs_per_cluster: int = 5
    pairs_cluster: tuple[int, int] = (3, 50)
    hard_band: tuple[float, float] = (0.55, 0.90)
    head_band: tuple[float, float] = (0.55, 0.92)
    easy_share: float = 0.5
    shares: tuple[float, float, float] = (0.60, 0.25, 0.15)
    # ids
    run_start: int = 100
    gid_floor: int = 400_000


DEFAULT = Config()
