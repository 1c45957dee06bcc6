"""The run clock.  It is always handed in, so a run over midnight keeps its target month."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone


@dataclass(frozen=True)
class RunContext:
    """Instant of one run and the texts derived from it (all in UTC)."""

    now: datetime

    @classmethod
    def at(cls, iso: str) -> RunContext:
        return cls(datetime.fromisoformat(iso))

    @classmethod
    def system(cls) -> RunContext:
        return cls(datetime.now(timezone.utc))

    def __post_init__(self):
        aware = self.now if self.now.tzinfo else self.now.replace(tzinfo=timezone.utc)
        object.__setattr__(self, "now", aware.astimezone(timezone.utc))

    @property
    def current_month(self) -> str:
        return self.now.strftime("%Y-%m")

    @property
    def previous_month(self) -> str:
        year, month = divmod(self.now.year * 12 + self.now.month - 2, 12)
        return f"{year:04d}-{month + 1:02d}"

    @property
    def run_date(self) -> str:
        return self.now.strftime("%Y-%m-%d")

    @property
    def run_ts(self) -> str:
        """ISO text with microseconds always present, so that text order is time order."""
        return self.now.strftime("%Y-%m-%dT%H:%M:%S.%f")
