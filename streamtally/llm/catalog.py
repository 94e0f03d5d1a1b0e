"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import (  # noqa: F401
    ann,
    ball_tree,
    bpe,
    divergence,
    filter_audit,
    jaccard,
    line_dedup,
    line_rules,
    mixing,
    secrets,
    sharding,
    token_files,
    toxicity,
)
from .common import REGISTRY


def queries() -> dict[str, Callable]:
    return {name: run for name, (run, _) in sorted(REGISTRY.items())}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in sorted(REGISTRY.items()) if sql is not None}
