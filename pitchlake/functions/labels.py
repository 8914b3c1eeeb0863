"""Display labels as native string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.config import METRIC_LABELS


def _text(c) -> Column:
    # an f-string prints a missing value as 'None'; concat would give NULL
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("None"))


def competition_label(name="competition_name", season="season_name") -> Column:
    """'<competition> (<season>)'."""
    return F.concat(_text(name), F.lit(" ("), _text(season), F.lit(")"))


def match_label(date="match_date", home="home_team", home_score="home_score",
                away_score="away_score", away="away_team") -> Column:
    """'<date> | <home> <hs>-<as> <away>'."""
    return F.concat(_text(date), F.lit(" | "), _text(home), F.lit(" "), _text(home_score),
                    F.lit("-"), _text(away_score), F.lit(" "), _text(away))


def title_label(metric_key) -> Column:
    """'press_height' -> 'Press Height'."""
    c = F.col(metric_key) if isinstance(metric_key, str) else metric_key
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def metric_label(metric_key) -> Column:
    """Fixed display label of one of the five metrics (NULL for other keys)."""
    c = F.col(metric_key) if isinstance(metric_key, str) else metric_key
    expr = None
    for key, label in METRIC_LABELS:
        expr = (F.when(c == key, label) if expr is None else expr.when(c == key, label))
    return expr
