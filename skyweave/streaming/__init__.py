"""Structured Streaming jobs."""

from skyweave.streaming.jobs import (
    bronze_stream,
    density,
    deduplicated,
    heartbeat,
    latest_density,
    run_density,
    run_freshness,
    run_ingest,
    run_legs,
    run_upsert,
    run_arrivals,
    run_watch,
    watch,
)

__all__ = [
    "bronze_stream", "density", "deduplicated", "latest_density", "run_density", "run_freshness",
    "run_ingest", "run_legs", "run_upsert", "heartbeat", "run_arrivals", "run_watch", "watch",
]
