"""Measured skew: with one match/team holding a third of all rows, no task of the
Gold plan or the two-level running total reads a large share of the shuffled
records, while the naive single window does (the probe can tell the difference)."""

import json
import os
import subprocess
import sys
import tempfile

HERE = os.path.dirname(os.path.abspath(__file__))


def test_hot_key_is_spread():
    scratch = tempfile.mkdtemp(prefix="run-skew-")
    out = subprocess.run([sys.executable, os.path.join(HERE, "skew_probe.py"), scratch],
                         capture_output=True, text=True, timeout=900, check=True).stdout
    share = json.loads(out.strip().splitlines()[-1])
    print(share)
    # largest share of a stage's shuffled records read by one task (16 partitions)
    assert share["running_one_window"] > 0.30          # the hot key in one task
    assert share["gold"] < 0.20                        # partial aggregation
    assert share["running_two_level"] < 0.15           # hot key spread over its buckets
    assert share["opponent_passes"] < 0.25             # AQE splits the hot match
    assert share["opponent_passes_unsalted"] > 0.25    # without AQE and salts one task has it
    assert share["opponent_passes_salted"] < 0.15      # without AQE, the salts deal it out
    assert share["match_momentum"] < 0.20
    assert share["landing_write"] < 0.20               # rebalance splits the hot match
