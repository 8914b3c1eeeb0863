"""Explicit StructTypes for every stored layer (no schema inference)."""

from pyspark.sql import types as T

I, L, D, F, S, B = (T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(),
                    T.StringType(), T.BooleanType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE_EVENTS = _st(
    ("match_id", L), ("team_id", I), ("team", S), ("player_id", D), ("player", S),
    ("type", S), ("period", I), ("minute", I), ("second", I), ("location", S),
    ("possession_team", S), ("play_pattern", S), ("carry_end_location", S),
    ("shot_statsbomb_xg", D), ("shot_body_part", S), ("shot_outcome", S),
    ("under_pressure", S), ("event_order", L),
    ("_ingested_at", T.TimestampType()), ("_source", S),
    ("competition_id", L), ("season_id", L),
)

BRONZE_MATCHES = _st(
    ("match_id", L), ("match_date", S), ("home_team", S), ("away_team", S),
    ("home_score", S), ("away_score", S),
    ("_ingested_at", T.TimestampType()), ("_source", S),
    ("competition_id", L), ("season_id", L),
)

BRONZE_LINEUPS = _st(
    ("match_id", L), ("team_name", S), ("player_id", L), ("player_name", S),
    ("jersey_number", L),
    ("_ingested_at", T.TimestampType()), ("_source", S),
    ("competition_id", L), ("season_id", L),
)

#: Raw text of values that a typed Bronze column could not hold, as a JSON object by column.
UNPARSED = "_unparsed"
#: Fields of a feed's JSON lines that are no column of the table, as a VARIANT object.
EXTRA = "_extra"

BRONZE_COMPETITIONS = _st(
    ("competition_id", L), ("season_id", L), ("competition_name", S), ("season_name", S),
    ("_ingested_at", T.TimestampType()), ("_source", S),
)

SILVER_EVENTS = _st(
    ("match_id", L), ("team_id", I), ("team_name", S), ("player_id", I), ("player_name", S),
    ("type", S), ("period", I), ("minute", I), ("second", I), ("location_x", F),
    ("location_y", F), ("possession_team_name", S), ("play_pattern", S),
    ("event_order", L), ("competition_id", L), ("season_id", L),
)

GOLD_FINGERPRINTS = _st(
    ("match_id", L), ("team_name", S), ("ppda", F), ("press_height", D),
    ("high_turnover_rate", F), ("defensive_line_height", D), ("progressive_carry_rate", F),
    ("press_success_rate", D), ("compactness", D), ("counter_attack_speed", D),
    ("competition_id", L), ("season_id", L),
)

SEASON_KEYS = ("competition_id", "season_id")

SILVER_SHOTS = _st(
    ("match_id", L), ("team_name", S), ("player_id", I), ("player_name", S), ("minute", I),
    ("second", I), ("xg", F), ("location_x", F), ("location_y", F), ("body_part", S),
    ("outcome", S), ("under_pressure", B), ("event_order", L),
    ("competition_id", L), ("season_id", L),
)

SILVER_PRESSURES = _st(
    ("match_id", L), ("team_id", I), ("team_name", S), ("location_x", F), ("location_y", F),
    ("minute", I), ("second", I), ("event_order", L), ("competition_id", L), ("season_id", L),
)

SILVER_CARRIES = _st(
    ("match_id", L), ("player_id", I), ("player_name", S), ("start_x", F), ("start_y", F),
    ("end_x", F), ("end_y", F), ("delta_x", F), ("delta_y", F), ("event_order", L),
    ("competition_id", L), ("season_id", L),
)

SILVER_LINEUPS = _st(
    ("match_id", L), ("team_name", S), ("player_id", I), ("player_name", S),
    ("jersey_number", I), ("competition_id", L), ("season_id", L),
)

SILVER = {
    "events": SILVER_EVENTS, "shots": SILVER_SHOTS, "pressures": SILVER_PRESSURES,
    "carries": SILVER_CARRIES, "lineups": SILVER_LINEUPS,
}
