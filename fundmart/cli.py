"""Command line, for ``spark-submit`` or ``python -m fundmart.cli``.

    verwerk <source> <target>          one raw file to prepared tables
    star <folder...> --output <folder> prepared tables to star schema and report

Exit codes: 0 done, 1 wrong input, 3 quality status fail (everything is written then).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fundmart.functions.pseudonym import KEY_ENV, load_key
from fundmart.operators.checks import QualityError, count_severity, status
from fundmart.plans.jobs import run_pipeline, run_star
from fundmart.plans.report import QUALITY_FILE, read_status, table_totals
from fundmart.session import new_session
from fundmart.sinks import FORMATS
from fundmart.texts import ERROR, FAIL

EXIT_CODES: dict[type[Exception], int] = {
    QualityError: 3,
    ValueError: 1,
    FileNotFoundError: 1,
    AnalysisException: 1,
}


@dataclass
class Done:
    """What a command has to tell: its tables, where they are, and their quality."""

    what: str
    tables: dict[str, DataFrame]
    place: str
    status: str
    errors: int

    def lines(self) -> list[str]:
        number, rows = table_totals(self.tables)
        told = [f"{self.what}: {number} tabellen, {rows} rijen in {self.place}"]
        if self.status == FAIL:
            told.append(f"Status {FAIL} met {self.errors} fout(en), maar dat is toegestaan.")
        return told


def verwerk(spark: SparkSession, given: argparse.Namespace) -> Done:
    key = None
    if given.geen_pseudonimisering:
        print("Persoonsnummers worden NIET gepseudonimiseerd.", file=sys.stderr)
    else:
        key = load_key(key_file=given.sleutelbestand)
    found = run_pipeline(
        spark,
        given.source,
        given.target,
        given.fmt,
        key,
        pseudonymise=key is not None,
        fail_on_errors=not given.allow_quality_errors,
    )
    errors = count_severity(found.messages, ERROR)
    return Done("Verwerkt", found.tables, given.target, status(found.messages), errors)


def star(spark: SparkSession, given: argparse.Namespace) -> Done:
    tables = run_star(spark, given.sources, given.output, not given.allow_quality_errors)
    report = f"{given.output}/{QUALITY_FILE}"
    return Done("Sterschema", tables, given.output, *read_status(spark, report))


# Each command: what runs it, what it is for, and its arguments besides the common one.
COMMANDS: dict[str, tuple[Callable, str, dict[str, dict]]] = {
    "verwerk": (
        verwerk,
        "een ruw bestand omzetten in tabellen",
        {
            "source": {"help": "het ruwe bestand"},
            "target": {"help": "map voor de tabellen"},
            "--fmt": {"choices": FORMATS, "default": FORMATS[0]},
            "--sleutelbestand": {"help": f"bestand met de sleutel; anders geldt {KEY_ENV}"},
            "--geen-pseudonimisering": {"action": "store_true"},
        },
    ),
    "star": (
        star,
        "tabellen samenvoegen tot een sterschema",
        {
            "sources": {"nargs": "+", "help": "mappen met tabellen (Parquet)"},
            "--output": {"required": True, "help": "map voor sterschema en rapport"},
        },
    ),
}


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fundmart")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (function, purpose, arguments) in COMMANDS.items():
        command = commands.add_parser(name, help=purpose)
        for argument, options in arguments.items():
            command.add_argument(argument, **options)
        command.add_argument("--allow-quality-errors", action="store_true")
        command.set_defaults(function=function)
    return parser


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; what goes wrong becomes a message and an exit code."""
    given = build_parser().parse_args(argv)
    try:
        done = given.function(spark or new_session(), given)
    except tuple(EXIT_CODES) as error:
        print(error, file=sys.stderr)
        return next(code for kind, code in EXIT_CODES.items() if isinstance(error, kind))
    print("\n".join(done.lines()))
    return 0


if __name__ == "__main__":
    sys.exit(run())
