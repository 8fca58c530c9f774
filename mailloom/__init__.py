"""Mailboxes as Spark tables and streams."""

from mailloom.schema import FetchOptions

__all__ = ["FetchOptions"]
