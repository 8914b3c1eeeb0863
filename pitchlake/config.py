"""Tunable thresholds and fixed values.

Pitch coordinates follow the feed: x in 0..120 (towards the opponent goal),
y in 0..80.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the metric definitions they reproduce)
# ---------------------------------------------------------------------------
# Event kinds counted as defensive actions:
DEFENSIVE_KINDS = ("Pressure", "Interception", "Tackle", "Foul Committed", "Block")
# Pitch size:
PITCH_LENGTH = 120
PITCH_WIDTH = 80
# Placeholder value of the three not-yet-modelled metrics:
PLACEHOLDER_METRIC = 0.5
# Minute of the closing point of the momentum series:
MOMENTUM_END_MINUTE = 95
# The five team metrics and their display labels, in display order:
METRIC_LABELS = (
    ("ppda", "Pressing Intensity (PPDA)"),
    ("press_height", "Press Height"),
    ("high_turnover_rate", "High Turnovers"),
    ("defensive_line_height", "Defensive Line"),
    ("progressive_carry_rate", "Prog. Carries"),
)
# Style labels and the PPDA ratios that trigger them:
STYLE_AGGRESSIVE = "Aggressive Pressing"
STYLE_PASSIVE = "Passive Block"
STYLE_LOW_RATIO = 0.9
STYLE_HIGH_RATIO = 1.1
# Radar axis head-room factor:
RADAR_HEADROOM = 1.2
# Text forms that mean "missing" in stringified Bronze columns:
MISSING_TEXT = ("nan", "NaN", "None", "")
# Source tag written into Bronze audit columns:
DEFAULT_SOURCE = "open_event_feed"
# ---------------------------------------------------------------------------

METRICS = tuple(k for k, _ in METRIC_LABELS)


@dataclass(frozen=True)
class Thresholds:
    """Zone thresholds of the Gold metrics (x in pitch units)."""

    opp_pass_max_x: float = 80.0        # opponent passes counted for PPDA when x < this
    press_zone_min_x: float = 40.0      # own defensive actions counted for PPDA when x > this
    high_turnover_min_x: float = 80.0   # pressure in the final third when x > this
    own_half_max_x: float = 60.0        # defensive-line actions when x < this
    progressive_gain: float = 10.0      # carry is progressive when end_x - start_x > this
    defensive_kinds: tuple[str, ...] = DEFENSIVE_KINDS
    # "reference": each carry weighted by the player's Carry-event count per team
    # (the many-to-many join semantics); "plain": every carry counted once.
    carry_weighting: str = "reference"


DEFAULT_THRESHOLDS = Thresholds()
