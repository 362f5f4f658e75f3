"""Run one job: ``python -m fairwait <job> ...``, or this file under spark-submit.

    land   --url U --out BRONZE (--start D --end D | --incremental N)
    clean  --input BRONZE --output SILVER
    gate   --input SILVER                exits with 1 when a rule fails
    load   --input SILVER (--table T | --path P) [--dry-run]
    build  (--table T | --path P) --seed CSV (--output MARTS | --database D)
    upsert --input BRONZE --log LOG --progress DIR [--output SILVER] [--counts COUNTS]
    marts  --counts COUNTS --seed CSV --output MARTS
    census --input BRONZE                exits with 1 when a declared field is absent or has another type
    compare --input SILVER (--table T | --path P)   exits with 1 when rows differ
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from fairwait.plans import jobs, maintained, star
from fairwait.schemas import HIGH_VOLUME
from fairwait.session import build_session
from fairwait.sources.census import field_census
from fairwait.sources.pages import AT_ONCE, http_count, http_fetch
from fairwait.sources.scans import scan_raw, scan_seed, scan_silver
from fairwait.sources.windows import incremental_window
from fairwait.streaming.upsert import append_versions


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fairwait")
    commands = top.add_subparsers(dest="job", required=True)

    land = commands.add_parser("land")
    land.add_argument("--url", required=True)
    land.add_argument("--out", required=True)
    land.add_argument("--start", help="first day, YYYY-MM-DD")
    land.add_argument("--end", help="day after the last one")
    land.add_argument("--incremental", type=int, metavar="DAYS")
    land.add_argument("--slice-hours", type=float, default=24)
    land.add_argument("--at-once", type=int, default=AT_ONCE, help="slices fetched at the same time")
    land.add_argument(
        "--verify", action=argparse.BooleanOptionalAction, default=True,
        help="slice by the service's counts and compare with them",
    )

    clean = commands.add_parser("clean")
    clean.add_argument("--input", required=True)
    clean.add_argument("--output", required=True)

    gate = commands.add_parser("gate")
    gate.add_argument("--input", required=True)

    load = commands.add_parser("load")
    load.add_argument("--input", required=True)
    load.add_argument("--dry-run", action="store_true")

    build = commands.add_parser("build")
    build.add_argument("--seed", required=True)
    written = build.add_mutually_exclusive_group(required=True)
    written.add_argument("--output")
    written.add_argument("--database")
    build.add_argument("--at-least", type=int, default=HIGH_VOLUME)

    census = commands.add_parser("census")
    census.add_argument("--input", required=True)

    compare = commands.add_parser("compare")
    compare.add_argument("--input", required=True)

    marts = commands.add_parser("marts")
    marts.add_argument("--counts", required=True)
    marts.add_argument("--seed", required=True)
    marts.add_argument("--output", required=True)
    marts.add_argument("--at-least", type=int, default=HIGH_VOLUME)

    for command in (load, build, compare):
        target = command.add_mutually_exclusive_group(required=True)
        target.add_argument("--table")
        target.add_argument("--path")

    upsert = commands.add_parser("upsert")
    upsert.add_argument("--input", required=True)
    upsert.add_argument("--log", required=True)
    upsert.add_argument("--progress", required=True)
    upsert.add_argument("--output")
    upsert.add_argument("--counts")
    upsert.add_argument("--buckets", type=int, help="of a new log: some GB of versions each")
    return top


def landing_window(args: argparse.Namespace) -> tuple[str, str]:
    """The asked window; ``--incremental 0`` counts as not given."""
    if args.incremental:
        return incremental_window(datetime.now(timezone.utc).date(), args.incremental)
    if args.start and args.end:
        return args.start, args.end
    parser().error("which days? give --start with --end, or --incremental with a number of days")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    window = landing_window(args) if args.job == "land" else None
    spark = build_session(f"fairwait {args.job}")
    if args.job == "land":
        fetch = http_fetch(args.url)
        options = {"slice_hours": args.slice_hours, "at_once": args.at_once}
        if args.verify:
            options["count"] = http_count(args.url)
        print(jobs.land_pages(spark, fetch, *window, args.out, **options))
    elif args.job == "clean":
        print(jobs.build_silver(spark, args.input, args.output))
    elif args.job == "gate":
        results = jobs.gate(scan_silver(spark, args.input)).collect()
        for rule in results:
            print("PASS" if rule["success"] else "FAIL", rule["rule"], rule["column"])
        return 0 if all(rule["success"] for rule in results) else 1
    elif args.job == "load":
        silver = scan_silver(spark, args.input)
        if args.dry_run:
            plan = jobs.load_plan(silver).orderBy("position")
            plan.show(len(silver.columns), truncate=False)
        else:
            print(jobs.load(silver, table=args.table, path=args.path))
    elif args.job == "build":
        raw, seed = scan_raw(spark, args.table, args.path), scan_seed(spark, args.seed)
        results = []

        def check(models):
            results.extend(jobs.model_tests(models).collect())
            for test in results:
                print(test["status"], test["model"], test["test"], test["column"], test["failures"])
            return all(test["status"] != "fail" for test in results)

        jobs.build_marts(
            raw, seed, out=args.output, database=args.database, at_least=args.at_least, check=check
        )
        return 1 if any(test["status"] == "fail" for test in results) else 0
    elif args.job == "upsert":
        append_versions(spark, args.input, args.log, args.progress, buckets=args.buckets)
        maintained.advance(spark, args.log, args.output, args.counts)
    elif args.job == "marts":
        areas = star.dim_area(star.stg_census(scan_seed(spark, args.seed)))
        jobs.publish_models(spark, maintained.marts(spark, args.counts, areas, args.at_least), args.output)
    elif args.job == "census":
        findings = field_census(spark, args.input).orderBy("pull", "field").collect()
        for row in findings:
            print(row["pull"], row["finding"], row["field"], row["kind"] or "-", row["expected"] or "-", row["records"])
        return 1 if any(row["finding"] in ("absent", "renamed", "retyped") for row in findings) else 0
    elif args.job == "compare":
        differ = jobs.load_differences(scan_silver(spark, args.input), args.table, args.path)
        differ.orderBy("SR_NUMBER").show(100, truncate=False)
        return 0 if differ.isEmpty() else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
