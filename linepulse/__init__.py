"""Assembly-line telemetry analytics on Spark DataFrames."""

from linepulse.session import line_session, shared_dir

__all__ = ["line_session", "shared_dir"]
