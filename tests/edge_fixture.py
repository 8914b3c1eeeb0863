"""Hand-made Bronze rows for the edge cases of SURVEY §3.5 (Q1-Q3, Q10-Q17)."""

from pitchlake import schemas

FIELDS = [f for f in schemas.BRONZE_EVENTS.fields if not f.name.startswith("_")]


def ev(order, match, team, kind, loc=None, player=None, minute=1, second=0, period=1,
       end=None, xg=None, under=None, season=1):
    row = dict.fromkeys(f.name for f in FIELDS)
    row.update(match_id=match, team_id=None if team is None else hash(team) % 100, team=team,
               player_id=None if player is None else float(player),
               player=None if player is None else f"P{player}", type=kind, period=period,
               minute=minute, second=second, location=loc, possession_team=team,
               play_pattern="Regular Play", carry_end_location=end, shot_statsbomb_xg=xg,
               under_pressure=under, event_order=order, competition_id=1, season_id=season)
    return row


def rows():
    r = []
    o = iter(range(1, 1000))
    # ---- match 1: team A vs B
    for loc in ("nan", "None", "", None, "[90.0]", "[90.0, 40.0]"):      # Q2, Q15, P3
        r.append(ev(next(o), 1, "A", "Pressure", loc))
    r.append(ev(next(o), 1, "A", "Interception", "[40.0, 10.0]"))      # x = 40: not > 40
    r.append(ev(next(o), 1, "A", "Tackle", "[60.0, 10.0]"))            # x = 60: not < 60
    r.append(ev(next(o), 1, "A", "Block", "[50.0, 10.0]"))
    for sx, exx in ((10, 25), (30, 35), (40, 50)):                      # Q3: gains 15, 5, 10
        r.append(ev(next(o), 1, "A", "Carry", f"[{sx}.0, 10.0]", player=7, end=f"[{exx}.0, 10.0]"))
    r.append(ev(next(o), 1, "A", "Carry", "[0.0, 0.0]", player=8, end="[20.0, 0.0]"))
    r.append(ev(next(o), 1, "A", "Pass", "[20.0, 5.0]"))
    for under in ("nan", "None", None, "True"):                         # Q1
        r.append(ev(next(o), 1, "A", "Shot", "[100.0, 40.0]", player=9, xg=0.1, under=under))
    r.append(ev(next(o), 1, "B", "Pass", "[30.0, 10.0]"))
    r.append(ev(next(o), 1, "B", "Pass", "[80.0, 10.0]"))               # x = 80: not < 80
    r.append(ev(next(o), 1, "B", "Pass", "[10.0, 10.0]"))
    r.append(ev(next(o), 1, "B", "Pressure", "[80.0, 5.0]"))            # x = 80: not > 80
    # ---- match 2: three team names and a NULL team (Q14, Q16)
    r.append(ev(next(o), 2, "C", "Pass", "[10.0, 10.0]"))
    r.append(ev(next(o), 2, "C", "Pass", "[20.0, 10.0]"))
    r.append(ev(next(o), 2, "D", "Pass", "[30.0, 10.0]"))
    r.append(ev(next(o), 2, "D", "Pressure", "[70.0, 10.0]"))
    r.append(ev(next(o), 2, "E", "Block", "[50.0, 10.0]"))
    r.append(ev(next(o), 2, None, "Pass", "[10.0, 10.0]"))
    r.append(ev(next(o), 2, None, "Pressure", "[90.0, 10.0]"))
    r.append(ev(next(o), 2, "C", None, "[90.0, 10.0]"))                 # no kind: not in Silver
    # ---- match 3: momentum (Q10-Q12, H8); home H shoots, away W does not
    r.append(ev(100, 3, "H", "Shot", "[100.0, 30.0]", minute=10, second=5, xg=0.05))
    r.append(ev(99, 3, "H", "Shot", "[100.0, 30.0]", minute=10, second=5, xg=0.01))
    r.append(ev(101, 3, "H", "Shot", "[100.0, 30.0]", minute=45, second=0, period=2, xg=0.2))
    r.append(ev(102, 3, "H", "Shot", "[100.0, 30.0]", minute=46, second=0, period=1, xg=0.1))
    r.append(ev(103, 3, "H", "Shot", "[100.0, 30.0]", minute=50, second=0, xg=None))
    r.append(ev(104, 3, "H", "Shot", "[110.0, 70.0]", minute=97, second=0, xg=0.3))
    r.append(ev(105, 3, "W", "Pass", "[50.0, 40.0]", minute=3))
    return r


def bronze(spark):
    from pyspark.sql import types as T
    return spark.createDataFrame(rows(), T.StructType(FIELDS))


def matches(spark):
    data = [(1, "2024-01-01", "A", "B", "2", "0", 1, 1),
            (2, "2024-01-02", "C", "D", "2.0", "nan", 1, 1),
            (3, "2024-01-03", "H", "W", "abc", None, 1, 1)]
    return spark.createDataFrame(
        data, "match_id long, match_date string, home_team string, away_team string, "
              "home_score string, away_score string, competition_id long, season_id long")
