"""panelforge: keyed panel time series on PySpark."""

from panelforge.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
