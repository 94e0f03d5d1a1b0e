"""One input, several outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from .lake import append


def write_by_topic(rows: DataFrame, path: str, topic: str = "topic") -> None:
    """One folder per topic from a single pass; the topics need not be known."""
    append(rows, path, [topic])


def fan_out(
    rows: DataFrame, routes: Mapping[str, tuple[Column, Callable[[DataFrame], None]]]
) -> None:
    """Give each route the rows its condition selects; the input is computed once."""
    held = rows.persist()
    try:
        for condition, write in routes.values():
            write(held.where(condition))
    finally:
        held.unpersist()
