"""Settings of a run: command line over environment over profile over defaults."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, fields, replace
from typing import Any

from weftline.pipeline import fingerprint


@dataclass(frozen=True)
class Config:
    """Thresholds and sizes that enter results; their fingerprint is part of every stage's key."""

    profile: str = "balanced"
    seed: int = 20240917
    min_confidence: float = 0.55
    weight_floor: float = 0.15
    auto_merge: float = 0.94
    review_merge: float = 0.86
    max_adjudications: int = 400
    min_support: int = 2
    shortlist_size: int = 24
    hard_negatives: int = 4
    neighbors: int = 24
    published_neighbors: int = 12
    layout_neighbors: int = 25
    min_dist: float = 0.08
    clusters: int = 24
    shards: int = 64
    page_ttl_hours: int = 720

    def fingerprint(self) -> str:
        return fingerprint({k: v for k, v in asdict(self).items() if k != "profile"})


PROFILES: dict[str, dict[str, Any]] = {"balanced": {}, "small": {"shortlist_size": 12, "hard_negatives": 2, "neighbors": 12, "max_adjudications": 100}}


def load_config(overrides: dict[str, Any] | None = None, environment: dict[str, str] | None = None) -> Config:
    """``overrides`` win over ``WEFTLINE_<NAME>`` variables, which win over the profile."""
    env = os.environ if environment is None else environment
    over = {k: v for k, v in (overrides or {}).items() if v is not None}
    profile = over.get("profile") or env.get("WEFTLINE_PROFILE") or "balanced"
    if profile not in PROFILES:
        raise ValueError(f"no profile {profile!r}; there are {', '.join(PROFILES)}")
    base = replace(Config(profile=profile), **PROFILES[profile])
    kinds = {f.name: type(getattr(base, f.name)) for f in fields(base)}
    found = {n: kinds[n](env[f"WEFTLINE_{n.upper()}"]) for n in kinds if n != "profile" and f"WEFTLINE_{n.upper()}" in env}
    unknown = set(over) - set(kinds)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return replace(base, **(found | over))
