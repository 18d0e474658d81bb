"""Skyweave: aviation surveillance analytics written as Spark DataFrame plans.

Raw payloads are archived, parsed into typed tables, merged by natural key, derived into flight
legs and a versioned aircraft dimension, and answered by a set of marts. Everything is expressed
with the DataFrame, SQL and Structured Streaming APIs.
"""

from skyweave.session import build_session, configure, shared_folder

__all__ = ["build_session", "configure", "shared_folder"]
