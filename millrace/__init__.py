"""Warehouse staging on Spark: raw landing tables in, clean keyed staging tables out."""

from millrace.session import pin_session, shared_folder

__all__ = ["pin_session", "shared_folder"]
