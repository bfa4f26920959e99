"""Tallyhouse: a PySpark-native personal-finance analytics engine."""

from tallyhouse.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
