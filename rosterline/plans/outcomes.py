"""What a load did with each table: one outcome per table and phase, folded into the report of an upload.

A failed table is no result: whoever loads gets ``LoadFailed``, which carries the report, after all tables had their turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

#: Statuses, the strongest first: over several phases the strongest stands.
STATUSES = ("failed", "loaded", "skipped", "empty", "absent")


@dataclass(frozen=True)
class Outcome:
    """loaded: rows went in; empty: no valid row; absent: a key column is missing; skipped: a parent isn't there.

    given = rows_upserted + ignored (distinct keys) + collapsed (rows of a key beyond its last) + empty + incomplete +
    rejected + orphaned; before_dedup: the sheet rows that the given ones stand for.
    """

    dataset: str
    status: str = "empty"
    rows_upserted: int = 0
    before_dedup: int = 0
    given: int = 0
    ignored: int = 0
    collapsed: int = 0
    empty: int = 0
    incomplete: int = 0
    rejected: int = 0
    orphaned: int = 0
    error: str | None = None
    cause: Exception | None = field(default=None, compare=False, repr=False)

    COUNTS = ("rows_upserted", "before_dedup", "given", "ignored", "collapsed", "empty", "incomplete", "rejected", "orphaned")

    @property
    def success(self) -> bool:
        return self.status == "loaded"

    def then(self, later: Outcome) -> Outcome:
        """Both phases in one: rows add up, no error gets lost."""
        errors = [e for e in (self.error, later.error) if e]
        return replace(
            self,
            status=min(self.status, later.status, key=STATUSES.index),
            **{c: getattr(self, c) + getattr(later, c) for c in self.COUNTS},
            error="; ".join(errors) or None,
            cause=self.cause or later.cause,
        )


@dataclass
class UploadReport:
    results: dict[str, Outcome] = field(default_factory=dict)

    @property
    def sheets_processed(self) -> list[str]:
        return [name for name, r in self.results.items() if r.success and r.rows_upserted > 0]

    @property
    def success(self) -> bool:
        """Something was loaded and nothing failed."""
        return bool(self.sheets_processed) and not any(r.status == "failed" for r in self.results.values())

    @property
    def errors(self) -> dict[str, str]:
        return {name: r.error for name, r in self.results.items() if r.error}

    def checked(self) -> UploadReport:
        """This report, if no table failed; else ``LoadFailed``, caused by the first error."""
        failed = [r for r in self.results.values() if r.status == "failed"]
        if failed:
            raise LoadFailed(self) from next((r.cause for r in failed if r.cause), None)
        return self


class LoadFailed(RuntimeError):
    """Tables of a load failed; ``report`` says what became of every table."""

    def __init__(self, report: UploadReport):
        super().__init__("; ".join(f"{name}: {r.error}" for name, r in report.results.items() if r.status == "failed"))
        self.report = report


def report(*phases: dict[str, Outcome]) -> UploadReport:
    """The phases' outcomes by table, in the order in which tables first appear."""
    out: dict[str, Outcome] = {}
    for phase in phases:
        for name, outcome in phase.items():
            out[name] = out[name].then(outcome) if name in out else outcome
    return UploadReport(out)
