"""Command line: ``python -m starloom arrivals|music|create|drop ...``."""

from __future__ import annotations

import argparse

from starloom.plans.jobs import arrivals_job, music_job
from starloom.schemas import CONTRACTS
from starloom.session import build_session, sized_conf
from starloom.sinks.tables import create_tables, drop_tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starloom")
    commands = top.add_subparsers(dest="command", required=True)

    arrivals = commands.add_parser("arrivals", help="load the arrivals star")
    for name in ("arrivals", "temperature", "country-codes", "demographics", "output"):
        arrivals.add_argument(f"--{name}", required=True)
    arrivals.add_argument("--arrivals-format", default="csv")
    arrivals.add_argument("--reload", choices=("all", "partitions"), default="all")
    arrivals.add_argument("--load-size", type=int)
    arrivals.add_argument("--strict-codes", action="store_true")
    arrivals.add_argument("--cube", action="store_true", help="also load the counts that questions are answered from")

    music = commands.add_parser("music", help="load the song play star")
    for name in ("logs", "songs", "output"):
        music.add_argument(f"--{name}", required=True)
    music.add_argument("--rebuild", action="store_true")
    music.add_argument("--salts", type=int, default=1)
    music.add_argument("--hot-rows", type=int)
    music.add_argument("--progress", help="folder kept between runs: read only new log files")

    for name in ("create", "drop"):
        command = commands.add_parser(name, help=f"{name} the declared tables")
        command.add_argument("tables", nargs="*", choices=[[], *CONTRACTS], metavar="table")
    arrivals.add_argument("--state-codes", help="state code list to check the arrivals against")
    arrivals.add_argument("--monthly", action="store_true", help="the arrivals are files or folders named by month")
    for command in (arrivals, music):
        command.add_argument("--allowed-rejects", type=int, default=0, help="bad records that do not fail the load")
        command.add_argument("--input-bytes", type=int, help="size of the input: sets the partitions")
        command.add_argument("--cores", type=int, help="cores of the cluster, with --input-bytes")
    for command in commands.choices.values():
        command.add_argument("--database")
    return top


def partition_conf(input_bytes: int | None, cores: int | None) -> dict[str, str]:
    """Settings for an input of known size; all of it may have to be shuffled."""
    if input_bytes is None:
        return {}
    return sized_conf(input_bytes, input_bytes, cores or 1)


def main(arguments: list[str] | None = None) -> None:
    given = vars(parser().parse_args(arguments))
    command = given.pop("command")
    conf = partition_conf(given.pop("input_bytes", None), given.pop("cores", None))
    spark = build_session(f"starloom {command}", **conf)
    if command in ("create", "drop"):
        run = create_tables if command == "create" else drop_tables
        run(spark, given["tables"] or list(CONTRACTS), given["database"])
        return
    result = (arrivals_job if command == "arrivals" else music_job)(spark, **given)
    result.load_report.show(truncate=False)
    result.quality_report.show(100, truncate=False)


if __name__ == "__main__":
    main()
