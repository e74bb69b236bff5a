"""Every threshold of the library in one immutable place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Snapshot validity.
    min_rows: int = 5
    min_stock_rows: int = 5
    # Valid-date coverage.
    coverage_ratio: float = 0.8
    # Change detection.
    epsilon: float = 1e-9
    min_scale_samples: int = 3
    min_active_pct: float = 1.0
    strict_overlap: float = 0.90
    strict_size: float = 0.70
    family_overlap: float = 0.50
    family_size: float = 0.50
    # Signals.
    signal_window: int = 3
    core_weight: float = 2.0
    event_streak: int = 3
    min_consensus_issuers: int = 2
    strong_consensus_issuers: int = 3
    # Manager intent.
    intent_windows: tuple[int, ...] = (5, 10)
    min_eligible_days: int = 3
    directional_ratio: float = 0.25
    offset_ratio: float = 0.5
    high_gross: dict[int, float] = field(default_factory=lambda: {5: 8.0, 10: 12.0})
    net_threshold: dict[int, float] = field(default_factory=lambda: {5: 4.0, 10: 6.0})
    intent_evidence: int = 20
    # Traction.
    traction_window: int = 5
    traction_min_events: int = 2
    # Report.
    material_weight: float = 0.5
    top_rank: int = 20
    min_new_funds: int = 2
    mover_min_pct: float = 10.0
    mover_limit: int = 10
    consensus_min_funds: int = 15
    significant_score: float = 6.0
    intent_limit: int = 8
    section_limit: int = 8
    intent_section_limit: int = 4
    observation_limit: int = 3
    observation_delta: float = 1.0
    min_fund_weight: float = 80.0
    # Ingest.
    min_weight: float = 0.01
    row_count_history: int = 5
    low_row_count_ratio: float = 0.6
    equivalence_delta: float = 1.0
    cutoff_hour: int = 15
    calendar_lookback: int = 10


DEFAULT = Params()
