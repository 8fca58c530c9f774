"""Folders for what a query writes on its way."""

from __future__ import annotations

import uuid

from mailloom.operators.joins import ensure_checkpoint_dir


def scratch(spark) -> str:
    """A new folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
