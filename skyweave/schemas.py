"""Table registry: columns, natural keys, layer and partitioning of every table.

Every table is partitioned by a function of its key, so rows with equal keys always share a
partition: a merge then touches only the partitions of its new rows, and merging inside partitions
removes duplicates from the whole table. Tables whose key holds a time use its date (and hour);
the others use a hash bucket of the key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


NO_VALUE = "__none__"


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    keys: tuple[str, ...]
    ddl: str
    # one of ("hour", column), ("day", column), ("month", column of ISO text), ("bucket", number)
    split: tuple[str, str | int]
    nullable_keys: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def partition_columns(self) -> list[str]:
        return {"hour": ["dt", "hh"], "day": ["dt"], "month": ["month"], "bucket": ["bucket"]}[self.split[0]]

    @property
    def partition_types(self) -> dict[str, str]:
        return {"dt": "string", "hh": "string", "month": "string", "bucket": "int"}

    def partition_values(self) -> dict[str, Column]:
        """Expressions for the partition columns of a row."""
        how, what = self.split
        if how == "bucket":
            return {"bucket": F.pmod(F.xxhash64(*self.keys), F.lit(int(what))).cast("int")}
        column = F.col(str(what))
        if isinstance(self.schema[str(what)].dataType, T.StringType):  # ISO text
            values = {"dt": F.substring(column, 1, 10), "hh": F.substring(column, 12, 2), "month": F.substring(column, 1, 7)}
        else:
            at = F.timestamp_seconds(column)
            values = {"dt": F.date_format(at, "yyyy-MM-dd"), "hh": F.date_format(at, "HH")}
        # text too short for a part of the time would be the null partition, which no value equals
        return {c: F.coalesce(F.nullif(values[c], F.lit("")), F.lit(NO_VALUE)) for c in self.partition_columns}


_TABLES = [
    Table(
        "fct_position", "silver", ("hex", "snapshot_time"),
        "hex string, snapshot_time bigint, hub string, source string, callsign string, registration string, "
        "aircraft_type string, category string, latitude double, longitude double, alt_baro int, alt_geom int, "
        "on_ground boolean, ground_speed double, track double, baro_rate int, geom_rate int, squawk string, "
        "emergency string, nav_altitude_mcp int, nav_qnh double, distance_nm double, bearing_deg double, "
        "rssi double, messages int, seen_pos double, mlat boolean",
        ("hour", "snapshot_time"),
    ),
    Table(
        "fct_opensky_state", "silver", ("icao24", "snapshot_time"),
        "icao24 string, callsign string, origin_country string, time_position bigint, last_contact bigint, "
        "longitude double, latitude double, baro_altitude double, on_ground boolean, velocity double, "
        "true_track double, vertical_rate double, geo_altitude double, squawk string, spi boolean, "
        "position_source int, snapshot_time bigint, authenticated boolean, sensor_count int",
        ("hour", "snapshot_time"),
    ),
    Table(
        "fct_weather_obs", "silver", ("station", "obs_time"),
        "station string, obs_time bigint, report_time string, name string, latitude double, longitude double, "
        "elevation_m int, flight_category string, temp_c double, dewpoint_c double, wind_dir_deg int, "
        "wind_speed_kt int, wind_gust_kt int, visibility_sm double, ceiling_ft int, altimeter_hpa double, "
        "sea_level_pressure double, raw string",
        ("hour", "obs_time"),
    ),
    Table(
        # The change indicator is part of the key: a base period and the TEMPO inside it may start together.
        "fct_weather_forecast", "silver", ("station", "issue_time", "period_from", "change_indicator"),
        "station string, issue_time string, period_from bigint, period_to bigint, valid_from bigint, "
        "valid_to bigint, change_indicator string, probability int, wind_dir_deg int, wind_speed_kt int, "
        "wind_gust_kt int, wind_shear_hgt int, visibility_sm double, ceiling_ft int, vertical_vis_ft int, "
        "weather string, raw string",
        ("hour", "period_from"), ("change_indicator",),
    ),
    Table(
        "fct_hazard", "silver", ("hazard_id",),
        "hazard_id string, kind string, hazard string, hazard_name string, valid_from string, valid_to string, "
        "altitude_base_ft string, altitude_top_ft string, min_lat double, max_lat double, min_lon double, "
        "max_lon double, crosses_antimeridian boolean, fir_id string, fir_name string, icao_id string, "
        "series string, qualifier string, movement_dir string, movement_speed_kt string, change string, "
        "raw string, issue_time string, severity string, frequency string",
        ("bucket", 16),
    ),
    Table(
        "fct_disruption", "silver", ("airport", "delay_type", "observed_at"),
        "airport string, delay_type string, observed_at bigint, reason string, avg_delay string, "
        "max_delay string, min_delay string, arrival_delay_min string, arrival_delay_max string, "
        "departure_delay_min string, departure_delay_max string, end_time string, reopen_time string, extra string",
        ("hour", "observed_at"),
    ),
    Table(
        "fct_launch_window", "silver", ("launch_id", "net", "status"),
        "launch_id string, net string, status string, status_abbrev string, observed_at string, name string, "
        "slug string, provider string, mission string, mission_type string, orbit string, vehicle string, "
        "program string, window_start string, window_end string, net_precision string, probability int, "
        "weather_concerns string, hold_reason string, fail_reason string, pad_name string, pad_latitude double, "
        "pad_longitude double, pad_location string, country_code string, pad_turnaround string, "
        "orbital_attempt_count_year int, webcast_live boolean",
        ("month", "net"),
    ),
    Table(
        "fct_launch_update", "silver", ("update_id",),
        "update_id string, launch_id string, created_on string, comment string, info_url string, created_by string",
        ("bucket", 16),
    ),
    Table(
        "fct_orbital_element", "silver", ("norad_cat_id", "epoch"),
        "norad_cat_id int, epoch string, object_name string, object_id string, launch_designator string, "
        "launch_year int, mean_motion double, eccentricity double, inclination double, ra_of_asc_node double, "
        "arg_of_pericenter double, mean_anomaly double, bstar double, mean_motion_dot double, rev_at_epoch int, "
        "period_minutes double, `group` string",
        ("hour", "epoch"),
    ),
    Table(
        "fct_space_weather", "silver", ("observed_at",),
        "observed_at bigint, time_tag string, kp_index int, estimated_kp double, kp_label string, storm boolean, "
        "source string",
        ("hour", "observed_at"),
    ),
    Table(
        "fct_notam", "silver", ("notam_id",),
        "notam_id string, number string, location string, icao_location string, type string, "
        "classification string, effective_start string, effective_end string, issued string, "
        "affected_fir string, selection_code string, minimum_fl string, maximum_fl string, text string, "
        "formatted_text string",
        ("bucket", 16),
    ),
    Table(
        "fct_fuel_price", "silver", ("period", "series"),
        "period string, series string, product string, product_name string, area string, price double, units string",
        ("month", "period"),
    ),
    Table(
        "dim_airport", "silver", ("ident",),
        "ident string, icao string, iata string, name string, kind string, latitude double, longitude double, "
        "elevation_ft int, continent string, iso_country string, iso_region string, municipality string, "
        "scheduled_service boolean",
        ("bucket", 4),
    ),
    Table(
        "dim_runway", "silver", ("runway_id",),
        "runway_id string, airport_ident string, length_ft int, width_ft int, surface string, lighted boolean, "
        "closed boolean, le_ident string, le_latitude double, le_longitude double, le_heading_deg double, "
        "he_ident string, he_latitude double, he_longitude double, he_heading_deg double",
        ("bucket", 4),
    ),
    Table(
        "dim_aircraft_registry", "silver", ("icao24",),
        "icao24 string, registration string, aircraft_type string, model string, manufacturer string, "
        "operator string, operator_icao string, operator_iata string, operator_callsign string, owner string, "
        "country string, category string, built string, serial_number string",
        ("bucket", 16),
    ),
    Table(
        "fct_flight_leg", "gold", ("leg_id",),
        "leg_id string, hex string, callsign string, registration string, aircraft_type string, hub string, "
        "start_time bigint, end_time bigint, duration_s bigint, dep_airport string, arr_airport string, "
        "dep_observed boolean, arr_observed boolean, complete boolean, fix_count bigint, max_alt_ft int, "
        "max_ground_speed_kt double, track_distance_nm double, direct_distance_nm double, "
        "track_efficiency double, emergency string",
        ("day", "start_time"),
    ),
    Table(
        # Working table of the leg job: what one chunk of one aircraft contributes to its legs.
        "leg_piece", "work", ("hex", "chunk", "piece"),
        "hex string, chunk bigint, piece int, first_t bigint, last_t bigint, first_ground boolean, "
        "last_ground boolean, air_n int, event_n int, maybe boolean, callsign string, registration string, "
        "aircraft_type string, emergency string, hub string, "
        "first_latitude double, last_latitude double, from_latitude double, to_latitude double, "
        "first_longitude double, last_longitude double, from_longitude double, to_longitude double, airborne boolean, "
        "fix_count bigint, max_alt_ft int, max_ground_speed_kt double, flown double",
        ("day", "first_t"),
    ),
    Table(
        "dim_aircraft", "gold", ("hex", "valid_from"),
        "hex string, registration string, aircraft_type string, operator string, operator_icao string, "
        "valid_from bigint, valid_to bigint, is_current boolean, first_seen bigint, last_seen bigint",
        ("bucket", 16),
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
