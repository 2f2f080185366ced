"""The jobs: ``python -m touchtrail JOB``, or with spark-submit; ``--help`` lists them."""

from __future__ import annotations

import argparse
import sys
from datetime import date, timedelta

from pyspark.sql import functions as F

from touchtrail.params import Params
from touchtrail.plans import pipeline, publish
from touchtrail.session import get_session
from touchtrail.sources import landing
from touchtrail.sources.batch import read_nested_events
from touchtrail.streaming import ingest, refresh


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = get_session(f"touchtrail-{args.job}")
    return _JOBS[args.job](spark, args)


def _create_landing(spark, args) -> int:
    landing.create_landing(spark, args.landing)
    return 0


def _ingest(spark, args) -> int:
    landing.create_landing(spark, args.landing)
    sent = ingest.read_stream(spark, args.inbox)
    ingest.ingest_available(sent, args.landing, args.checkpoint, args.rejects)
    return 0


def _compact(spark, args) -> int:
    # What an earlier run packed goes first; this run's readers may still be at what it packs.
    removed = landing.clean(spark, args.landing, timedelta(minutes=args.grace_minutes))
    packs = landing.compact(spark, args.landing, least=args.least)
    print(f"{packs} packs written, {removed} packed deliveries removed")
    return 0


def _rebuild(spark, args) -> int:
    nested = read_nested_events(spark, args.events, args.first_day, args.last_day)
    landed = landing.read_landing(spark, args.landing)
    try:
        pipeline.rebuild(
            spark, nested, landed, args.out, _params(args), tested=True,
            require_passing=args.require_passing,
        )
    except pipeline.FailedTests as failed:
        print(failed, file=sys.stderr)
        return 1
    publish.expire(spark, args.out, args.keep)
    results = pipeline.test_results(spark, args.out)
    results.orderBy(F.desc("failures")).show(50, truncate=False)
    return 1 if results.where("failures > 0").limit(1).count() else 0


def _refresh(spark, args) -> int:
    landing.create_landing(spark, args.landing)
    query = refresh.start_refresh(
        ingest.read_stream(spark, args.inbox),
        lambda session: read_nested_events(session, args.events),
        args.landing,
        args.out,
        args.checkpoint,
        _params(args),
        once=not args.forever,
        rejects=args.rejects,
        keep=args.keep,
    )
    query.awaitTermination()
    return 0


def _roll_back(spark, args) -> int:
    print(publish.roll_back(spark, args.out))
    return 0


_JOBS = {
    "create-landing": _create_landing,
    "ingest": _ingest,
    "compact": _compact,
    "rebuild": _rebuild,
    "refresh": _refresh,
    "roll-back": _roll_back,
}


def _params(args) -> Params:
    return Params(conversion_event=args.conversion_event, lookback_days=args.lookback_days)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    defaults = Params()
    parser = argparse.ArgumentParser(prog="touchtrail", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    create = jobs.add_parser("create-landing", help="create the landing table unless it exists")
    land = jobs.add_parser("ingest", help="land all files that are new in the inbox")
    pack = jobs.add_parser("compact", help="pack small deliveries of the landing table")
    build = jobs.add_parser("rebuild", help="build all tables, run the tests, publish the build")
    keep_up = jobs.add_parser("refresh", help="land new files and publish the marts after each batch")
    back = jobs.add_parser("roll-back", help="publish the build before the current one again")
    for job in (create, land, pack, build, keep_up):
        job.add_argument("--landing", required=True)
    for job in (land, keep_up):
        job.add_argument("--inbox", required=True)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--rejects", help="folder for malformed lines; without it they fail the batch")
    pack.add_argument("--least", type=int, default=landing.LEAST_IN_PACK, help="deliveries in a pack")
    pack.add_argument("--grace-minutes", type=float, default=60, help="packed deliveries stay so long")
    for job in (build, keep_up):
        job.add_argument("--events", required=True, help="folder of the events_YYYYMMDD shards")
        job.add_argument("--conversion-event", default=defaults.conversion_event)
        job.add_argument("--lookback-days", type=int, default=defaults.lookback_days)
        job.add_argument("--keep", type=int, default=3, help="builds that stay")
    for job in (build, keep_up, back):
        job.add_argument("--out", required=True)
    for end in ("--first-day", "--last-day"):
        build.add_argument(end, type=date.fromisoformat, help="YYYY-MM-DD; give both or none")
    build.add_argument(
        "--require-passing", action="store_true", help="do not publish a build that fails a test"
    )
    keep_up.add_argument("--forever", action="store_true", help="wait for more files")
    return parser.parse_args(argv)


if __name__ == "__main__":
    sys.exit(main())
