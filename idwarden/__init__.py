"""Identity-access analytics as plain PySpark DataFrame jobs."""

from idwarden.sources import Sources, load_sources

__all__ = ["Sources", "load_sources"]
