"""Gold: per (match, team) tactical fingerprints, for every match of every season.

Plan shape (see README "Gold plan"):

* One ``groupBy(competition, season, match, team, player)`` over Silver events
  with conditional aggregates (the only scan of events) is rolled up to the
  (match, team) spine, own passes, own defensive actions in the pressing zone,
  pressure height / final-third share and defensive-line height, and also
  gives each player's Carry-event count per team. Partial aggregation runs
  map-side, so a hot match or team ships one row per player and map task.
* Opponent passes = (all passes of the match by named teams) - (own passes):
  a window over the *aggregated* rows of one match (a handful of teams),
  never a self-join of raw events and never a fan-out.
* Progressive-carry rate: carries pre-aggregated to (match, player) stand beside
  the player's Carry-event counts per team, so nothing sees carries x events.
* Only these aggregated rows are dealt by the match, once; every later step
  (carries to players, players to teams, teams to opponents) needs no further
  exchange: one exchange per source, and one of rows per player.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.config import DEFAULT_THRESHOLDS, PLACEHOLDER_METRIC, Thresholds

TEAM_MATCH = ("competition_id", "season_id", "match_id", "team_name")
MATCH = ("competition_id", "season_id", "match_id")
#: Passes of a match that one task joins; most matches whose passes may be dealt over several.
SALT_ROWS, MOST_HOT = 100_000, 1000


def _ratio(num, den):
    """num / den as FLOAT, NULL when den is 0."""
    return F.when(den != 0, num / den).cast("float")


def _event_aggs(t: Thresholds) -> list:
    """Conditional counts and (sum, count) pairs over events; additive, so the
    same columns can be rolled up from a finer grouping."""
    x = F.col("location_x")
    kind = F.col("type")
    is_def = kind.isin(*t.defensive_kinds)
    is_press = kind == "Pressure"
    in_line = is_def & (x < t.own_half_max_x)
    return [
        F.count_if((kind == "Pass") & (x < t.opp_pass_max_x)).alias("own_passes"),
        F.count_if(is_def & (x > t.press_zone_min_x)).alias("zone_def_actions"),
        F.sum(F.when(is_press, x)).alias("press_x_sum"),
        F.count(F.when(is_press, x)).alias("press_x_n"),
        F.count_if(is_press & (x > t.high_turnover_min_x)).alias("high_pressures"),
        F.count_if(is_press).alias("pressures"),
        F.sum(F.when(in_line, x)).alias("line_x_sum"),
        F.count(F.when(in_line, x)).alias("line_x_n"),
        F.count_if(kind == "Carry").alias("carry_events"),
    ]


_ADDITIVE = ("own_passes", "zone_def_actions", "press_x_sum", "press_x_n", "high_pressures",
             "pressures", "line_x_sum", "line_x_n", "carry_events")


def player_match_counts(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The one pass over events for Gold: the additive counts per (match, team,
    player). Team metrics roll up from it and the carry attribution reads its
    Carry counts, so events are scanned once; averages are kept as (sum, count)
    so the roll-up is exact."""
    return events.groupBy(*TEAM_MATCH, "player_id").agg(*_event_aggs(t))


def team_match_counts(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS,
                      per_player: DataFrame | None = None) -> DataFrame:
    """Spine + every event-based count and mean per (match, team); rolled up
    from ``per_player`` when given, else aggregated directly (one shuffle)."""
    if per_player is None:
        base = events.groupBy(*TEAM_MATCH).agg(*_event_aggs(t))
    else:
        base = per_player.groupBy(*TEAM_MATCH).agg(*[F.sum(c).alias(c) for c in _ADDITIVE])

    def mean(s, n):
        return F.when(F.col(n) > 0, F.col(s) / F.col(n))

    return base.select(*TEAM_MATCH, "own_passes", "zone_def_actions",
                       mean("press_x_sum", "press_x_n").alias("press_height"),
                       "high_pressures", "pressures",
                       mean("line_x_sum", "line_x_n").alias("defensive_line_height"))


def with_opponent_passes(counts: DataFrame) -> DataFrame:
    """opp_passes(t) = passes of the match by named teams other than t.

    A NULL team name matches no one (``!=`` on NULL is unknown): its own passes
    count for no opponent and it faces no passes.
    """
    named = F.col("team_name").isNotNull()
    match_total = F.sum(F.when(named, F.col("own_passes")).otherwise(0)).over(
        Window.partitionBy(*MATCH))
    return counts.withColumn(
        "opp_passes", F.when(named, match_total - F.col("own_passes")).otherwise(0))


def ppda(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """PPDA = opponent passes (x < 80) / own defensive actions (x > 40)."""
    c = with_opponent_passes(team_match_counts(events, t))
    named = F.col("team_name").isNotNull()
    def_actions = F.when(named, F.col("zone_def_actions")).otherwise(0)
    return c.select(*TEAM_MATCH,
                    F.col("opp_passes").cast("bigint").alias("opp_passes"),
                    def_actions.cast("bigint").alias("def_actions"),
                    _ratio(F.col("opp_passes"), def_actions).alias("ppda"))


def press_metrics(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Per (match, team) with at least one pressure: mean x and final-third share."""
    press = events.where(F.col("type") == "Pressure")
    x = F.col("location_x")
    return press.groupBy(*TEAM_MATCH).agg(
        F.avg(x).alias("press_height"),
        _ratio(F.count_if(x > t.high_turnover_min_x), F.count(F.lit(1))).alias(
            "high_turnover_rate"))


def defensive_line(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Mean x of defensive actions in the own half (x < 60)."""
    x = F.col("location_x")
    return (events.where(F.col("type").isin(*t.defensive_kinds) & (x < t.own_half_max_x))
            .groupBy(*TEAM_MATCH).agg(F.avg(x).alias("defensive_line_height")))


def defensive_actions(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return events.where(F.col("type").isin(*t.defensive_kinds)).select(
        *TEAM_MATCH, "location_x", "location_y", "type", "minute", "second")


def match_teams(events: DataFrame) -> DataFrame:
    return events.select(*TEAM_MATCH).distinct()


def opponent_passes(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Passes with x < 80 attributed to every *other* team of the match.

    A join of the passes with the (match, team) spine on the match plus ``team != passer``. A match
    with more than ``salt_rows`` passes, and more than a share ``1 / MOST_HOT`` of all of them, is hot:
    its passes are dealt over salts, as many as its count asks for, and its few spine rows are repeated
    per salt. There are at most ``MOST_HOT`` hot matches, so the list of them is broadcast.
    """
    is_pass = (F.col("type") == "Pass") & (F.col("location_x") < t.opp_pass_max_x)
    passes = (events.where(is_pass)
              .select(*MATCH, F.col("team_name").alias("pass_team"), "location_x", "event_order"))
    per_team = events.groupBy(*TEAM_MATCH).agg(F.count_if(is_pass).alias("n"))
    per_match = per_team.groupBy(*MATCH).agg(F.sum("n").alias("n"))
    share = F.greatest(F.lit(salt_rows), F.ceil(per_match.agg(F.sum("n")).scalar() / MOST_HOT))
    hot = F.broadcast(per_match.where(F.col("n") > share).select(
        *MATCH, F.ceil(F.col("n") / share).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    dealt = passes.join(hot, list(MATCH), "left").withColumn(
        "salt", F.pmod(F.xxhash64("event_order", "pass_team", "location_x"), salts).cast("int")).drop("salts")
    spine = per_team.select(*TEAM_MATCH).join(hot, list(MATCH), "left").select(
        *TEAM_MATCH, F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    return (dealt.join(spine, [*MATCH, "salt"])
            .where(F.col("pass_team") != F.col("team_name"))
            .select(*MATCH, "team_name", "pass_team", "location_x", "event_order"))


def progressive_carry_rate(events: DataFrame, carries: DataFrame,
                           t: Thresholds = DEFAULT_THRESHOLDS,
                           per_player: DataFrame | None = None) -> DataFrame:
    """Share of progressive carries per (match, team).

    Carries have no team; a player's carries are attributed to the team(s)
    of their Carry events in the match. With ``carry_weighting='reference'``
    each carry counts once per matching Carry event (the many-to-many join
    semantics): rate = sum(p*m) / sum(n*m), p/n = progressive/all carries of
    the player, m = Carry events of the player for the team. ``'plain'``
    counts every carry once (m -> 1).
    """
    per_carrier = _per_carrier(carries, t)
    pp = per_player if per_player is not None else player_match_counts(events, t)
    carry_events = (pp.where(F.col("player_id").isNotNull() & (F.col("carry_events") > 0))
                    .select(*TEAM_MATCH, "player_id", F.col("carry_events").alias("m")))
    weight = F.col("m") if t.carry_weighting == "reference" else F.lit(1)
    return (carry_events.join(per_carrier, [*MATCH, "player_id"])
            .groupBy(*TEAM_MATCH)
            .agg(_ratio(F.sum(F.col("p") * weight), F.sum(F.col("n") * weight))
                 .alias("progressive_carry_rate")))


def _per_carrier(carries: DataFrame, t: Thresholds) -> DataFrame:
    gain = F.col("end_x") - F.col("start_x")
    return (carries.where(F.col("player_id").isNotNull())
            .groupBy(*MATCH, "player_id")
            .agg(F.count_if(gain > t.progressive_gain).alias("p"),
                 F.count(F.lit(1)).alias("n")))


def fingerprints(events: DataFrame, carries: DataFrame,
                 t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The Gold table: one row per (match, team) seen in the events.

    Plan: each source is aggregated once, map-side first: events to (match, team, player), carries to
    (match, player). These rows, one per player, go through one exchange on the match; all that
    follows finds its rows together there: a player's carries beside the player's rows (a window),
    the roll-up to (match, team) with the weighted carry sums, the passes of the match's other teams
    (a window). Raw rows are never dealt by the match, so a hot match is no hot task.
    """
    pp = player_match_counts(events, t)
    carriers = _per_carrier(carries, t)
    counts = [c for c in pp.columns if c not in (*TEAM_MATCH, "player_id")]
    nothing = F.lit(0).cast("long")
    players = pp.select(*MATCH, "team_name", "player_id", *counts, nothing.alias("p"), nothing.alias("n"),
                        F.lit(True).alias("seen"))
    carried = carriers.select(
        *MATCH, F.lit(None).cast("string").alias("team_name"), F.col("player_id").cast(pp.schema["player_id"].dataType),
        *[F.lit(None).cast(pp.schema[c].dataType).alias(c) for c in counts], "p", "n", F.lit(False).alias("seen"))
    own = Window.partitionBy(*MATCH, "player_id")
    j = (players.unionByName(carried).repartition(*MATCH)
         .withColumns({"p": F.sum("p").over(own), "n": F.sum("n").over(own)}).where("seen"))
    m = F.when(F.col("player_id").isNotNull(), F.col("carry_events")).otherwise(0)
    w = m if t.carry_weighting == "reference" else F.when(m > 0, 1).otherwise(0)

    def mean(s, n):
        return F.when(F.sum(n) > 0, F.sum(s) / F.sum(n))

    team = j.groupBy(*TEAM_MATCH).agg(
        F.sum("own_passes").alias("own_passes"),
        F.sum("zone_def_actions").alias("zone_def_actions"),
        mean("press_x_sum", "press_x_n").alias("press_height"),
        F.sum("high_pressures").alias("high_pressures"),
        F.sum("pressures").alias("pressures"),
        mean("line_x_sum", "line_x_n").alias("defensive_line_height"),
        F.sum(F.col("p") * w).alias("carry_prog_w"),
        F.sum(F.col("n") * w).alias("carry_all_w"))
    c = with_opponent_passes(team)
    named = F.col("team_name").isNotNull()
    def_actions = F.when(named, F.col("zone_def_actions")).otherwise(0)
    const = F.lit(PLACEHOLDER_METRIC).cast("double")
    return c.select(
        "match_id", "team_name",
        _ratio(F.col("opp_passes"), def_actions).alias("ppda"),
        F.when(named, F.col("press_height")).alias("press_height"),
        F.when(named, _ratio(F.col("high_pressures"), F.col("pressures"))).alias(
            "high_turnover_rate"),
        F.when(named, F.col("defensive_line_height")).alias("defensive_line_height"),
        F.when(named, _ratio(F.col("carry_prog_w"), F.col("carry_all_w"))).alias(
            "progressive_carry_rate"),
        const.alias("press_success_rate"), const.alias("compactness"),
        const.alias("counter_attack_speed"),
        "competition_id", "season_id")


def carry_join_counts(events: DataFrame, carries: DataFrame,
                      t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Row counts of the carries x Carry-events join per (match, team), without
    materialising it: joined = sum(n*m), progressive = sum(p*m)."""
    per_player = _per_carrier(carries, t)
    carry_events = (events.where((F.col("type") == "Carry") & F.col("player_id").isNotNull())
                    .groupBy(*TEAM_MATCH, "player_id").agg(F.count(F.lit(1)).alias("m")))
    return (carry_events.join(per_player, [*MATCH, "player_id"])
            .groupBy(*TEAM_MATCH)
            .agg(F.sum(F.col("n") * F.col("m")).alias("joined_rows"),
                 F.sum(F.col("p") * F.col("m")).alias("progressive_rows")))


def pressure_counts(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Pressures per (match, team): all rows, rows with a location, final-third rows."""
    x = F.col("location_x")
    return (events.where(F.col("type") == "Pressure").groupBy(*TEAM_MATCH)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(x).alias("n_with_location"),
                 F.count(F.when(x > t.high_turnover_min_x, 1)).alias("n_final_third")))


def zone_actions_left_join(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Spine LEFT JOIN own defensive actions with x > 40 (the range test applied to
    the right side before the join), counted per (match, team)."""
    spine = match_teams(events)
    acts = (events.where(F.col("type").isin(*t.defensive_kinds)
                         & (F.col("location_x") > t.press_zone_min_x))
            .groupBy(*TEAM_MATCH).agg(F.count(F.lit(1)).alias("def_actions")))
    return (spine.join(acts, list(TEAM_MATCH), "left")
            .select(*TEAM_MATCH, F.coalesce("def_actions", F.lit(0)).alias("def_actions")))
