"""Ordered steps that stop at the first failure, and the command line's gates."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

_SUMMARY = re.compile(r"enumerated=(\d+).*?pdf_resolved=(\d+).*?errors=(\d+)", re.S)


@dataclass
class StepResult:
    name: str
    exit_code: int
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def clean(self) -> bool:
        return self.exit_code == 0 and self.counts.get("errors", 0) == 0


def parse_summary(text: str | None) -> dict[str, int]:
    """Counters of a run's summary line; zeros without one."""
    m = _SUMMARY.search(text or "")
    return dict(zip(("enumerated", "resolved", "errors"), map(int, m.groups()) if m else (0, 0, 0), strict=True))


def run_steps(steps: list[tuple[str, Callable[[], StepResult]]]) -> tuple[int, list[StepResult]]:
    """(exit code, results): each step in order; the first that isn't clean ends the run, and later ones don't start."""
    done: list[StepResult] = []
    for _, step in steps:
        done.append(step())
        if not done[-1].clean:
            return done[-1].exit_code or 1, done
    return 0, done


def allowed(live: bool, acknowledged: bool, needs: list[str] | None = None) -> int:
    """Exit code of a gate: 2 for a live run that nobody has acknowledged or that lacks a module it needs, else 0."""
    from importlib.util import find_spec

    if live and not acknowledged:
        return 2
    return 2 if any(find_spec(m) is None for m in needs or []) else 0


def unchanged(before: int, after: int) -> None:
    """Raise if a pass that only annotates changed the number of records."""
    if before != after:
        raise ValueError(f"{before} records became {after}")
