"""A registry that keeps a query next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self) -> None:
        self.entries: dict[str, tuple[Callable, str | None]] = {}

    def add(self, sql: str | None) -> Callable[[Callable], Callable]:
        def register(run: Callable) -> Callable:
            self.entries[run.__name__] = (run, sql)
            return run

        return register
