"""News analytics on Spark: raw, cleaned and aggregated article tables,
reporting models with quality checks, and batch similarity search."""

from newslake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
