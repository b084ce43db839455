"""Parameters of the operators, with the defaults of the price application."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    missing_strategy: str = "interpolate"
    outlier_method: str = "iqr"
    outlier_threshold: float = 3.0
    min_data_points: int = 30
    keep_missing: bool = False
    normalisation: str = "minmax"
    alert_threshold: float = 0.7
    window: int = 6
    trees: int = 100
    seed: int = 42
    nu: float = 1.0
    trend_weight: float = 0.5
    ar_weight: float = 0.5
    interval: float = 0.95
    horizon: int = 12
