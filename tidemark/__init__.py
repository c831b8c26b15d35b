"""tidemark: lakehouse data operators as plain DataFrame, SQL and Structured Streaming functions."""

from tidemark.session import Tables, build_session, scratch_dir

__all__ = ["Tables", "build_session", "scratch_dir"]
