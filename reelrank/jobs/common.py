"""Arguments shared by the jobs."""

from __future__ import annotations

import argparse

from reelrank.sources.tables import TableStore


def parser(description: str) -> argparse.ArgumentParser:
    result = argparse.ArgumentParser(description=description)
    result.add_argument("--store", default="", help="folder of the table store")
    result.add_argument("--format", default="parquet", help="Spark format of the tables")
    result.add_argument(
        "--table-option", help="connector option that carries the table name, if not a path"
    )
    result.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE", help="connector option"
    )
    result.add_argument(
        "--keep-seconds",
        type=int,
        default=3_600,
        help="how long replaced versions of a table stay for readers still on them",
    )
    return result


def options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def table_store(args: argparse.Namespace) -> TableStore:
    return TableStore(
        args.store, args.format, options(args.option), args.table_option, args.keep_seconds
    )
