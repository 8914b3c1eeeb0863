"""Command line: run the pipeline for a set of seasons and print the status table.

    spark-submit pitchlake/cli.py (--feed DIR [--feed-format json|parquet] | --input DIR)
        [--seasons 11:26,11:27] [--limit 10] [--lake <root>]

``--feed`` is a landed feed: ``DIR/{events,matches,lineups,competitions}/`` files
(``sources.landing`` schemas). ``--input`` is a directory with the generic
``events.parquet`` the adapter derives a feed from. ``--lake`` defaults to a
folder under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None) -> int:
    from pitchlake.plans import pipeline
    from pitchlake.session import build_session, input_bytes, lake_root, size_for
    from pitchlake.sources.adapter import Feed
    from pitchlake.sources.landing import LandedFeed

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input")
    src.add_argument("--feed")
    ap.add_argument("--feed-format", default="json")
    ap.add_argument("--seasons", help="comma list of competition:season; default: the whole catalogue")
    ap.add_argument("--limit", type=int, default=None, help="first N matches per season")
    ap.add_argument("--lake", default=None)
    a = ap.parse_args(argv)
    seasons = [tuple(int(x) for x in p.split(":")) for p in a.seasons.split(",") if p] if a.seasons else None
    spark = build_session()
    size_for(spark, input_bytes(spark, a.feed or a.input))
    root = a.lake or lake_root(spark, "cli")
    feed = LandedFeed(spark, a.feed, a.feed_format) if a.feed else Feed(spark, a.input)
    status = pipeline.run_pipeline(spark, feed, root, seasons, a.limit)
    status.orderBy("competition_id", "season_id").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
