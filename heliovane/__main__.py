"""Command line of the batch jobs, for ``spark-submit`` or ``python -m heliovane``.

Exits with 1 when a job fails, so that whatever starts the jobs can hold back the next one.
"""

from __future__ import annotations

import argparse
import json
import sys

from heliovane.config import PANEL, REGIONS, TURBINE, Region, SolarPanel, WindTurbine, check_catalog
from heliovane.plans.jobs import (
    Month,
    run_all,
    run_daily,
    run_days,
    run_feed,
    run_gold,
    run_gold_switched,
    run_history,
    run_silver,
    run_table,
)
from heliovane.session import build_session
from heliovane.sources.bronze import LAYOUTS
from heliovane.sources.published import publish_view
from heliovane.streaming.feed import LATENESS


def _month(text: str) -> Month:
    if text == "none":
        return None, None
    year, month = text.split("-")
    return int(year), int(month)


def read_model(path: str | None) -> tuple[tuple[Region, ...], SolarPanel, WindTurbine]:
    """Regions, panel and turbine from a JSON file; what it does not name keeps its default."""
    if path is None:
        return REGIONS, PANEL, TURBINE
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    regions = tuple(Region(**region) for region in given["regions"]) if "regions" in given else REGIONS
    return (
        check_catalog(regions),
        SolarPanel(**given.get("panel", {})),
        WindTurbine(**given.get("turbine", {})),
    )


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="heliovane")
    jobs = parser.add_subparsers(dest="job", required=True)

    silver = jobs.add_parser("silver", help="bronze to silver")
    history = jobs.add_parser("history", help="new historical files to a silver table of their own")
    feed = jobs.add_parser("feed", help="new feed files to a silver table of their own")
    days = jobs.add_parser("days", help="daily averages of new feed files, without silver")
    gold = jobs.add_parser("gold", help="silver to gold")
    refresh = jobs.add_parser("refresh", help="months of a published view, in one step for its readers")
    daily = jobs.add_parser("daily", help="gold to the region-day rollup")
    table = jobs.add_parser("table", help="gold as a table of the session's catalog")
    both = jobs.add_parser("all", help="silver, gold and, if named, the rollup")

    for job in (silver, history, both):
        job.add_argument("--history", required=True)
        job.add_argument("--history-layout", choices=LAYOUTS, default="json")
    for job in (silver, both):
        job.add_argument("--record-head", help="how each record starts, to save a pass over the text")
    for job in (silver, feed, days, both):
        job.add_argument("--feed", required=True)
    for job in (silver, history, feed, both):
        job.add_argument("--silver", required=True)
    history.add_argument("--manifest", required=True, help="lists the files read, kept between runs")
    for job in (silver, history, feed, days, gold, refresh, both):
        job.add_argument("--model", help="JSON file with regions, panel and turbine")
    for job in (silver, gold, refresh, both):
        job.add_argument("--dedup", action="store_true", help="one row per point and time")
    for job in (feed, days):
        job.add_argument("--state", required=True, help="folder kept between runs")
        job.add_argument("--files-per-batch", type=int)
    feed.add_argument("--repeats-within", help="time in which repeated deliveries are left out, as '2 days'")
    days.add_argument("--days", required=True)
    days.add_argument("--rejected", required=True, help="table of readings that are in no average")
    days.add_argument("--finished-only", action="store_true", help="each day once, when it is over")
    days.add_argument("--lateness", default=LATENESS, help="how long after its end a day stays open")
    for job in (gold, refresh):
        job.add_argument("--silver", required=True, action="append", help="may be repeated")
    refresh.add_argument("--refreshed", required=True, help="where refreshed months are written")
    refresh.add_argument("--view", required=True)
    for job in (gold, daily, table, both):
        job.add_argument("--gold", required=True)
    daily.add_argument("--daily", required=True)
    both.add_argument("--daily")
    table.add_argument("--name", default="gold_weather_metrics")
    table.add_argument("--view", action="store_true", help="publish a view, whose months can be refreshed in one step")
    gold.add_argument("--table", help="the catalog table of --gold, whose partitions are to follow")
    for job in (gold, refresh, daily):
        job.add_argument(
            "--month", type=_month, action="append", required=job is refresh,
            help="YYYY-MM, may be repeated; rows without a time (none) always come with it",
        )
    return parser.parse_args(argv)


def run(args: argparse.Namespace) -> None:
    spark = build_session(f"heliovane-{args.job}")
    regions, panel, turbine = read_model(getattr(args, "model", None))
    if args.job == "silver":
        written = run_silver(
            spark, args.history, args.feed, args.silver, regions,
            args.history_layout, args.record_head, args.dedup,
        )
        rows = {"silver": written}
    elif args.job == "history":
        added = run_history(spark, args.history, args.silver, args.manifest, regions, args.history_layout)
        rows = {"history": added}
    elif args.job == "refresh":
        written = run_gold_switched(
            spark, args.silver, args.refreshed, args.view, args.month, panel, turbine, args.dedup
        )
        rows = {"refresh": written}
    elif args.job == "feed":
        total = run_feed(
            spark, args.feed, args.silver, args.state, regions, args.files_per_batch, args.repeats_within
        )
        rows = {"feed": total}
    elif args.job == "days":
        rejected = run_days(
            spark, args.feed, args.days, args.rejected, args.state, regions,
            args.files_per_batch, args.finished_only, args.lateness,
        )
        rows = {"rejected": rejected}
    elif args.job == "gold":
        rows = {"gold": run_gold(spark, args.silver, args.gold, args.month, panel, turbine, args.dedup, args.table)}
    elif args.job == "daily":
        rows = {"daily": run_daily(spark, args.gold, args.daily, args.month).count()}
    elif args.job == "table" and args.view:
        publish_view(spark, args.gold, args.name)
        print(f"{args.name}: view of {args.gold}")
        return
    elif args.job == "table":
        print(f"{args.name}: {run_table(spark, args.gold, args.name)} partitions")
        return
    else:
        rows = run_all(
            spark, args.history, args.feed, args.silver, args.gold, args.daily,
            regions, panel, turbine, args.history_layout, args.record_head, args.dedup,
        )
    for table, count in rows.items():
        print(f"{table}: {count} rows")


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    try:
        run(args)
    except Exception as error:
        print(f"{args.job} failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
