"""Run identifiers (X9, X10, X11). Computed once per run on the driver and
stamped as literals, never read from a clock inside a transform."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone


def ingested_at(now: datetime | None = None) -> str:
    """Run-wide ISO-8601 UTC timestamp."""
    return (now or datetime.now(timezone.utc)).isoformat()


def batch_id(marker: str | None = None, now: datetime | None = None) -> str:
    """The marker a caller gives, or ``local-<UTC seconds>-<8 hex>``
    (fixed layout). Batch ids are opaque; order batches by ``_src_ingested_at``."""
    moment = now or datetime.now(timezone.utc)
    return (marker or "").strip() or f"local-{moment:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def validation_id(now: datetime | None = None) -> str:
    """X11: fixed-width UTC stamp, so the string maximum is the newest run."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S%fZ")
