"""Parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class RunConfig:
    start_date: str = "2016-01-01"
    end_date: str = "2025-12-31"
    output: str = "data/articles.jsonl"
    resume: bool = False
    seed: int = 42
    metrics: str | None = None  #: folder for the run's counters
    seen: str | None = None  #: bucketed table of the URLs written, instead of reading the output when resuming
    weeks_per_commit: int = 4  #: a run that ends early has lost so many weeks at most
    # of the fetcher
    request_delay: float = 0.2
    user_agent: str = "siftwell/0.1"
    workers: int = 8  #: tasks that fetch

    def __post_init__(self) -> None:
        if date.fromisoformat(self.end_date) < date.fromisoformat(self.start_date):
            raise ValueError("end_date is before start_date")
        if self.weeks_per_commit < 1:
            raise ValueError("weeks_per_commit must be positive")
