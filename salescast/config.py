"""Parameters of the forecasting job.

A configuration is a plain nested dict. Keys that are absent take the values in
``DEFAULTS``; nothing is read from disk here.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

# Section and key names plus the defaults a user expects.
DEFAULTS: dict[str, dict[str, Any]] = {
    "pipeline": {
        "name": "salescast",
        "version": "1.0.0",
    },
    "data_quality": {
        "max_null_rate": 0.05,
        "max_rejected_rate": 0.05,
        "min_records": 90,
        "max_date_gap_days": 7,
        "allow_negative_sales": False,
        "outlier_iqr_multiplier": 1.5,
    },
    "features": {
        "rolling_windows": [7, 14, 30],
        "lag_days": [1, 7, 14],
        "extract_time_features": True,
    },
    "model": {
        "type": "piecewise_seasonal",
        "horizon_days": 30,
    },
    "model.prophet": {
        "changepoint_prior_scale": 0.05,
        "seasonality_prior_scale": 10.0,
        "seasonality_mode": "multiplicative",
        "weekly_seasonality": True,
        "yearly_seasonality": True,
        "interval_width": 0.95,
    },
}


def settings(cfg: Mapping[str, Any] | None, section: str) -> dict[str, Any]:
    """Defaults of ``section`` overlaid with what ``cfg`` says.

    A dotted section name walks into nested mappings, so ``"model.prophet"`` is
    ``cfg["model"]["prophet"]``.
    """
    node: Any = cfg or {}
    for part in section.split("."):
        node = node.get(part) or {}
    known = DEFAULTS[section]
    return {key: node.get(key, default) for key, default in known.items()}
