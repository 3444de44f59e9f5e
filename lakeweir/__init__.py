"""lakeweir: a medallion (landing, staging, marts) engine written as Spark jobs."""

from lakeweir.session import SETTINGS, build_session, configure

__all__ = ["SETTINGS", "build_session", "configure"]
