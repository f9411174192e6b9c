"""All registered queries."""

from __future__ import annotations

from gleanmark.catalog.registry import REGISTRY, Entry


def load() -> dict[str, Entry]:
    """Import every module that registers queries."""
    from gleanmark.catalog import (  # noqa: F401
        export_queries,
        model_queries,
        profile_queries,
        quality_queries,
        scoring_queries,
        split_queries,
        text_queries,
    )

    return dict(REGISTRY)
