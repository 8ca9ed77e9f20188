"""Parameters of the library, with the shipped defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Default KPI targets, data quality thresholds and business keys.
DEFAULT_TARGETS = {
    "oee": 0.75,
    "availability": 0.90,
    "performance": 0.90,
    "quality": 0.98,
    "scrap_rate": 0.03,
    "defect_rate": 0.03,
}
# Where scrap and defect rates are to have no status, pass these targets instead.
HIGHER_IS_BETTER_TARGETS = {
    name: DEFAULT_TARGETS[name] for name in ("oee", "availability", "performance", "quality")
}
TARGET_CONFIG_KEYS = {
    "oee": "oee_target",
    "availability": "availability_target",
    "performance": "performance_target",
    "quality": "quality_target",
    "scrap_rate": "scrap_rate_max",
    "defect_rate": "defect_rate_max",
}
LOWER_IS_BETTER = ("scrap_rate", "defect_rate")
DEFAULT_DEDUPE_KEYS = {
    "production": ("factory_id", "line_id", "machine_id", "date", "shift_id"),
    "sensor": ("machine_id", "timestamp", "sensor_type"),
}
MISSING_STRATEGIES = ("median", "mean", "ffill", "drop")


@dataclass(frozen=True)
class Settings:
    """Thresholds, strategies and targets shared by the operators."""

    outlier_z_threshold: float = 3.0
    missing_value_strategy: str = "median"
    dedupe_keys: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(DEFAULT_DEDUPE_KEYS)
    )
    targets: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_TARGETS))
    # Patterns of date columns by name, for texts in another form than ISO.
    date_formats: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.missing_value_strategy not in MISSING_STRATEGIES:
            raise ValueError(
                f"missing_value_strategy must be one of {MISSING_STRATEGIES}, "
                f"not {self.missing_value_strategy!r}"
            )

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> Settings:
        """Read the ``data_quality`` and ``kpi_targets`` sections of a config mapping."""
        quality = config.get("data_quality", {})
        kpi = config.get("kpi_targets", {})
        return cls(
            outlier_z_threshold=quality.get("outlier_z_threshold", 3.0),
            missing_value_strategy=quality.get("missing_value_strategy", "median"),
            dedupe_keys={
                table: tuple(keys)
                for table, keys in quality.get("duplicate_subset_keys", {}).items()
            },
            date_formats=dict(quality.get("date_formats", {})),
            targets={
                name: kpi.get(TARGET_CONFIG_KEYS[name], default)
                for name, default in DEFAULT_TARGETS.items()
            },
        )
