"""Parse jobs: archived payloads (or reference files) to typed rows.

Each job is a plain function from DataFrame to DataFrame. ``PARSERS`` names the jobs that read the
payload archive, and the table each one fills; a new feed is added by adding an entry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from skyweave.sources import advisories, aviation, nas_status, reference, space


@dataclass(frozen=True)
class Parser:
    table: str
    parse: Callable[[DataFrame], DataFrame]


PARSERS: dict[str, Parser] = {
    "surveillance": Parser("fct_position", aviation.parse_positions),
    "opensky": Parser("fct_opensky_state", aviation.parse_states),
    "metar": Parser("fct_weather_obs", aviation.parse_metar),
    "taf": Parser("fct_weather_forecast", aviation.parse_taf),
    "sigmet": Parser("fct_hazard", advisories.parse_sigmet),
    "gairmet": Parser("fct_hazard", advisories.parse_gairmet),
    "notam": Parser("fct_notam", advisories.parse_notam),
    "disruption": Parser("fct_disruption", nas_status.parse_disruption),
    "launches": Parser("fct_launch_window", space.parse_launches),
    "launch_updates": Parser("fct_launch_update", space.parse_launch_updates),
    "orbital": Parser("fct_orbital_element", space.parse_orbital),
    "spaceweather": Parser("fct_space_weather", space.parse_kp),
    "airports": Parser("dim_airport", reference.parse_airport_pages),
    "runways": Parser("dim_runway", reference.parse_runway_pages),
    "registry": Parser("dim_aircraft_registry", reference.parse_registry_pages),
    "fuel": Parser("fct_fuel_price", advisories.parse_fuel),
}
