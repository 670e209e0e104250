"""All registered queries: importing a plan module registers what it defines."""

from __future__ import annotations

from tripweave.plans import flow, kiosk, models, network, registry, tabular  # noqa: F401


def entries() -> dict[str, registry.Entry]:
    return dict(registry.ENTRIES)
