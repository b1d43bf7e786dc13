"""Where a job's tables are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Paths:
    snapshots: str
    backups: str
    stats: str
    profiles: str
    current_profiles: str
    marks: str
    rejected: str
