"""Snapshots handed out one version at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.operators.history import apply_snapshot

Source = Callable[[int | None], tuple[DataFrame, int] | None]


def snapshot_source(read: Callable[[], DataFrame], seq: int) -> Source:
    """The snapshot of release ``seq`` for anyone who has not seen it yet, else nothing.

    ``read`` builds the frame only when it is needed.
    """
    def following(last_version: int | None) -> tuple[DataFrame, int] | None:
        if last_version is None or last_version < seq:
            return read(), seq
        return None

    return following


def advance_history(history: DataFrame, last_version: int | None, source: Source,
                    keys: list[str], tracked: list[str]) -> tuple[DataFrame, int | None]:
    """Apply the next snapshot of a source, if it has one, and return the new cursor.

    Store the result before the next step: a step reads the history twice, so plans of unstored
    steps would double each time.
    """
    found = source(last_version)
    if found is None:
        return history, last_version
    snapshot, seq = found
    return apply_snapshot(history, snapshot, seq, keys, tracked), seq
