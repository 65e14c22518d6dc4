"""Run the jobs of one run date: ``spark-submit ... clickloom/__main__.py 2024-01-15 --export path``."""

from __future__ import annotations

import argparse

from clickloom.plans import daily
from clickloom.plans.layout import Layout
from clickloom.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="clickloom")
    parser.add_argument("ds", help="run date, YYYY-MM-DD")
    parser.add_argument("--part", choices=("all", "events", "training"), default="all")
    parser.add_argument("--export", help="folder for the training CSVs")
    for database in ("shards", "events", "shop", "train"):
        parser.add_argument(f"--{database}", default=getattr(Layout, database), help="database (default %(default)s)")
    args = parser.parse_args()
    layout = Layout(args.shards, args.events, args.shop, args.train)
    spark = build_session()
    if args.part != "training" and not daily.run_events(spark, layout, args.ds):
        raise SystemExit(f"no event shard for {args.ds} yet")
    if args.part != "events":
        daily.run_training(spark, layout, args.ds, args.export)


if __name__ == "__main__":
    main()
