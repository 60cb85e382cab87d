"""The staged tables of one computation, and giving them back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablesync.sources.staging import Staged, stage

__all__ = ["Scratch"]


class Scratch:
    """Stages frames and remembers them; ``release`` deletes all but those the result still reads."""

    def __init__(self):
        self.held: list[Staged] = []

    def __call__(self, df: DataFrame, label: str) -> Staged:
        self.held.append(stage(df, label))
        return self.held[-1]

    def release(self, *kept: Staged) -> None:
        for staged in self.held:
            if not any(staged is k for k in kept):
                staged.release()
        self.held = list(kept)
