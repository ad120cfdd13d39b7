"""Command line: run the groups of a lake, or print one of its queries.

    python -m halfspace run --lake LAKE --source SOURCE [--groups ingestion ...]
    python -m halfspace query team_xg --lake LAKE
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from halfspace import plans
from halfspace.formats import DEFAULT_COMPETITION_ID, DEFAULT_SEASON_ID
from halfspace.sources import FileFeed, read_table

# Each query and the trusted table it reads.
QUERIES = {
    "home_standings": (plans.home_standings, "matches"),
    "team_xg": (plans.team_xg, "events"),
    "shot_map": (plans.shot_map, "events"),
    "pass_density": (plans.pass_density, "events"),
    "team_passing": (plans.team_passing, "events"),
    "top_pressers": (plans.top_pressers, "events"),
    "event_mix": (plans.event_mix, "events"),
}


def scope(text: str) -> tuple[int, int]:
    competition, season = text.split("/")
    return int(competition), int(season)


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="halfspace")
    commands = main.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="land, check and publish")
    run.add_argument("--source", required=True, help="folder of raw files")
    run.add_argument("--groups", nargs="+", choices=plans.GROUPS, default=list(plans.GROUPS))
    run.add_argument("--sample-matches", type=int, help="check only the first matches")
    query = commands.add_parser("query", help="print a query's rows")
    query.add_argument("name", choices=QUERIES)
    query.add_argument("--rows", type=int, help="rows to print; all of them by default")
    for command in (run, query):
        command.add_argument("--lake", required=True, help="folder of the lake's tables")
        command.add_argument(
            "--scopes",
            nargs="+",
            type=scope,
            default=[(DEFAULT_COMPETITION_ID, DEFAULT_SEASON_ID)],
            help="COMPETITION/SEASON ...",
        )
    return main


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("halfspace").getOrCreate()
    if given.command == "run":
        lake = plans.Lake(given.lake, tuple(given.scopes), given.sample_matches)
        metrics = plans.run(spark, lake, FileFeed(given.source), given.groups)
        for stage, values in metrics.items():
            print(stage, *(f"{name}={value}" for name, value in values.items()))
    else:
        lake = plans.Lake(given.lake, tuple(given.scopes))
        query, table = QUERIES[given.name]
        rows = lake.in_scope(read_table(spark, lake.path(f"trusted/{table}")))
        found = query(rows)
        found.show(found.count() if given.rows is None else given.rows, truncate=False)


if __name__ == "__main__":
    main()
