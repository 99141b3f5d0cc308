"""Settings of a run from a mapping of strings, such as the environment."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass

from tidemark.operators.cadence import DEFAULT_TIERS, Tier, parse_tiers


def as_number(value: str | None) -> float:
    """A setting's number: NaN if unset or no number; 0 if empty or blank."""
    if value is None:
        return math.nan
    value = value.strip()
    if not value:
        return 0.0
    if re.fullmatch(r"0[xX][0-9a-fA-F]+", value):
        return float(int(value, 16))
    if re.fullmatch(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[+-]?Infinity", value):
        return float(value)
    return math.nan


def or_default(value: str | None, default: float) -> float:
    """The number, or the default where it is missing, no number or 0: such a setting can't be 0."""
    n = as_number(value)
    return default if math.isnan(n) or n == 0 else n


def limit(value: str | None, default: float) -> float:
    """A limit that 0 switches off; empty counts as unset, negative or no number as the default."""
    if not (value or "").strip():
        return default
    n = as_number(value)
    return n if math.isfinite(n) and n >= 0 else default


def switch(value: str | None) -> bool:
    """On unless it says 0, false or no."""
    return (value or "").lower() not in ("0", "false", "no")


@dataclass(frozen=True)
class Settings:
    """Names of the settings and their defaults."""

    tiers: tuple[Tier, ...] = DEFAULT_TIERS
    concurrency: float = 8
    source_concurrency: float = 4
    delay_ms: float = 300
    max_run_ms: float = 45 * 60 * 1000
    flush_every: float = 200
    breaker_threshold: float = 10
    refresh_window: float = 5
    delta_upsert: bool = True

    @staticmethod
    def read(env: Mapping[str, str]) -> Settings:
        """Tiers that can't be read are the default ones."""
        get = env.get
        return Settings(
            (parse_tiers(get("CRON_TIERS") or "") if get("CRON_TIERS") else None) or DEFAULT_TIERS, or_default(get("CRON_CONCURRENCY"), 8), limit(get("CRON_SOURCE_CONCURRENCY"), 4), or_default(get("CRON_BATCH_DELAY"), 300),
            or_default(get("CRON_MAX_RUN_MS"), 45 * 60 * 1000), or_default(get("CRON_FLUSH_EVERY"), 200), or_default(get("CRON_BREAKER_THRESHOLD"), 10), or_default(get("CHAPTER_REFRESH_WINDOW"), 5), switch(get("CHAPTER_DELTA_UPSERT")),
        )
