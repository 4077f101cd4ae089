"""Grouped clustering, word counting and distinct items of streams on Spark DataFrames."""

from pointflow.session import get_session, scratch_folder

__all__ = ["get_session", "scratch_folder"]
