"""Write PLANS.md: physical plans of the headline queries (sf0.01, stored layers).

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SHOW = [
    ("silver_shots", "Silver from stored Bronze: filter and column pruning at the scan"),
    ("gold_fingerprints", "Gold: one partial/final aggregation, window over aggregated rows, "
                          "pre-aggregated carry join"),
    ("match_momentum", "Momentum: two-level running total (bucketed window + bucket prefix)"),
    ("pressing_leaders", "Top-5 per season: partial WindowGroupLimit before the shuffle"),
    ("team_dna", "Team DNA: team and league means joined per season, unpivoted"),
]


def _shorten(line: str) -> str:
    """Keep what a reviewer needs from long lines; scans keep their filters."""
    if "FileScan" in line:
        head = line[:line.index("FileScan")]
        m = re.search(r"FileScan \w+ \[[^\]]*\]", line)
        keep = [m.group(0)] if m else ["FileScan"]
        for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
            # long lists are abbreviated by Spark as "[a, b, ..." (no closing bracket)
            k = re.search(key + r": (\[[^\]]*?(?:\]|\.\.\.)|struct<[^>]*>)", line)
            if k:
                keep.append(f"{key}: {k.group(1)}")
        return head + ", ".join(keep)
    return line if len(line) < 300 else line[:300] + " ..."


def main(argv):
    from pitchlake.plans import catalog
    from pitchlake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir)}` "
           "(initial AQE plans; sizes decide broadcast vs shuffle at run time).", ""]
    for key, why in SHOW:
        df = catalog.run(key, spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = "\n".join(_shorten(line) for line in plan.splitlines())
        out += [f"## {key}", "", why, "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
