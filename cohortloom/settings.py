"""Run settings as one immutable value that operators receive explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    modules: tuple[str, ...] = (
        "appendicitis",
        "cholecystitis",
        "colorectal_cancer",
        "total_joint_replacement",
        "breast_cancer",
    )
    call_days: tuple[int, ...] = (1, 3, 7, 14)
    archetypes: tuple[str, ...] = (
        "recuperacion_normal",
        "complicacion_leve_vigilancia",
        "complicacion_real",
    )
    noise_intensity: int = 3
    rule_version: str = "v1-implementada-sin-validacion-clinica"
    model_name: str = "plantilla_local"
    catalog: str = "seguimiento"
    # Label share band, both ends allowed.
    min_share: float = 0.05
    max_share: float = 0.75
    # One timestamp per run instead of "now" per row; pass a fixed one to compare reruns.
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    def __post_init__(self) -> None:
        if not self.modules:
            raise ValueError("modules must not be empty")
        if not self.call_days:
            raise ValueError("call_days must not be empty")
        if not self.archetypes:
            raise ValueError("archetypes must not be empty")
        if len(set(self.call_days)) != len(self.call_days):
            raise ValueError("call_days must be distinct: they are part of the row keys")
