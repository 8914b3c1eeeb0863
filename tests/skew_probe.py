"""Skew probe (own Spark process with an event log): one match / team holds a
third of all rows; for each plan, report the largest share of a stage's
shuffled records that one task reads (16 partitions: ideal ~0.06; a hot key
kept in one task: >= 0.33).

    python tests/skew_probe.py <scratch_dir>     -> prints one JSON line
"""

from __future__ import annotations

import glob
import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

N = 300_000


def main(scratch: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from pitchlake.operators import gold as G
    from pitchlake.operators.running import running_total, running_total_single_window

    logs = os.path.join(scratch, "events")
    os.makedirs(logs, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             # AQE skew handling with thresholds scaled to the probe's size
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
             .getOrCreate())
    hot = F.col("id") % 3 == 0                       # a third of all rows
    kinds = F.element_at(F.array(*[F.lit(k) for k in
                                   ("Pass", "Carry", "Pressure", "Block", "Shot")]),
                         (F.col("id") % 5 + 1).cast("int"))
    ev = (spark.range(N, numPartitions=16).select(
        F.lit(1).cast("bigint").alias("competition_id"), F.lit(1).cast("bigint").alias("season_id"),
        F.when(hot, 1).otherwise((F.col("id") % 500) + 2).cast("int").alias("match_id"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), (F.col("id") % 7).cast("string")))
         .alias("team_name"),
        (F.col("id") % 40).cast("int").alias("player_id"), kinds.alias("type"),
        ((F.col("id") * 37) % 1200 / 10.0).cast("float").alias("location_x"),
        (F.col("id") % 95).cast("int").alias("minute"), (F.col("id") % 60).cast("int").alias("second"),
        F.col("id").alias("event_order"), (F.col("id") % 100 / 100.0).alias("xg")))
    carries = ev.where(F.col("type") == "Carry").select(
        "competition_id", "season_id", "match_id", "player_id", F.col("location_x").alias("start_x"),
        (F.col("location_x") + 5).cast("float").alias("end_x"))

    jobs = {}

    def run(name, df):
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        jobs[name] = True

    run("gold", G.fingerprints(ev, carries))
    keys = ["match_id", "team_name"]
    run("running_two_level", running_total(ev, keys, ["minute", "second"], ["event_order"],
                                          "xg", "cum"))
    run("running_one_window", running_total_single_window(
        ev, keys, ["minute", "second", "event_order"], "xg", "cum"))
    run("opponent_passes", G.opponent_passes(ev))
    # the salts alone: AQE splits nothing here
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    run("opponent_passes_salted", G.opponent_passes(ev, salt_rows=100))
    run("opponent_passes_unsalted", G.opponent_passes(ev))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    from pitchlake.plans import serving as V
    matches = ev.select("match_id").distinct().select(
        "match_id", F.lit("1").alias("competition_id"), F.lit("1").alias("season_id"),
        F.lit("2024-01-01").alias("match_date"), F.lit("HOT").alias("home_team"),
        F.lit("T1").alias("away_team"), F.lit("0").alias("home_score"),
        F.lit("0").alias("away_score"))
    run("match_momentum", V.match_momentum(matches, ev.where(F.col("type") == "Shot")))
    from pitchlake.sources import bronze as B
    spark.sparkContext.setJobGroup("landing_write", "landing_write")
    B.land_events(ev.drop("xg", "location_x"), os.path.join(scratch, "lake"))
    spark.stop()

    # per job group: the largest share of shuffle records read by one task
    files = sorted(p for p in glob.glob(os.path.join(logs, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not p.endswith(".inprogress"))
    stage_group, totals, lines = {}, {}, []
    for path in files:                       # rolling event log: events_1_..., events_2_...
        with open(path) as f:
            lines += [json.loads(x) for x in f if x.startswith("{")]
    for e in lines:
        if e.get("Event") == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
    per_stage = {}
    for e in lines:
        if e.get("Event") != "SparkListenerTaskEnd":
            continue
        m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
        n = m.get("Total Records Read", 0)
        if n:
            per_stage.setdefault(e["Stage ID"], []).append(n)
    for sid, counts in per_stage.items():
        g = stage_group.get(sid)
        if g is None or sum(counts) < 1000:      # skip stages over a few aggregated rows
            continue
        # share of the stage's shuffled records read by its largest task
        totals[g] = max(totals.get(g, 0), max(counts) / sum(counts))
    share = {g: round(v, 4) for g, v in totals.items()}
    print(json.dumps(share))


if __name__ == "__main__":
    main(sys.argv[1])
