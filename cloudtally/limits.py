"""Every limit, weight and label the plans use, in one place.

The defaults are the published rules; pass a changed copy
(``dataclasses.replace(Limits(), idle_utilisation=15)``) to any plan to try others.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    # --- fixed values: calendar ---
    peak_months: tuple[int, ...] = (1, 2, 3, 7, 8, 9)

    # --- fixed values: performance model ---
    latency_base_ms: float = 150.0
    latency_ms_per_point: float = 3.0
    latency_before_migration_ms: float = 80.0
    latency_after_migration_ms: float = 40.0
    error_tiers: tuple[tuple[float, float], ...] = ((80.0, 3.5), (70.0, 2.0))
    error_floor: float = 0.8
    error_before_migration: float = 0.7

    # --- fixed values: breach limits (strictly above is a breach) ---
    breach_latency_ms: float = 500.0
    breach_error_pct: float = 3.0
    breach_utilisation: float = 85.0

    # --- fixed values: bands and scores ---
    latency_bands: tuple[float, float] = (250.0, 500.0)
    error_bands: tuple[float, float] = (1.0, 3.0)
    band_points: tuple[float, float, float] = (100.0, 70.0, 40.0)
    healthy_utilisation: tuple[float, float] = (20.0, 85.0)
    utilisation_points: tuple[float, float, float] = (100.0, 60.0, 40.0)
    health_weights: tuple[float, float, float] = (0.40, 0.40, 0.20)
    stability_weights: tuple[float, float, float] = (0.4, 0.3, 0.3)

    # --- fixed values: cost ---
    storage_weight: float = 0.05
    egress_weight: float = 0.5
    idle_utilisation: float = 20.0
    spike_growth: float = 0.25
    acceleration_pct: float = 15.0
    high_pressure_index: float = 1.2
    trend_months: int = 3
    seasonal_months: int = 6

    # --- fixed values: governance ---
    min_tagged_pct: float = 80.0

    # --- our own choices where the rules name no number ---
    overrun_months: int = 3
    peak_drop_points: float = 5.0
    high_dependence_share: float = 0.7
    fragmented_index: float = 0.4
    budget_yellow_share: float = 0.10
    forecast_horizon: int = 6
    band_z_80: float = 1.2816
    band_z_95: float = 1.9600


SERVICES = ("IaaS", "PaaS", "SaaS")
PROVIDERS = ("AWS", "Azure", "GCP")
BEFORE_MIGRATION = "Pre"
