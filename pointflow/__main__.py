"""`python -m pointflow {clusters,fairness,words,distinct,generate} ...`"""

from __future__ import annotations

import argparse

from pointflow import get_session
from pointflow.operators.fair import SELECTIONS
from pointflow.plans import programs


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pointflow")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("clusters", "fairness", "words"):
        command = commands.add_parser(name)
        command.add_argument("path")
        command.add_argument("--parts", type=int)
        if name != "words":
            command.add_argument("k", type=int)
            command.add_argument("rounds", type=int)
            command.add_argument("--dims", type=int)
            command.add_argument("--seed", type=int, default=42)
    commands.choices["fairness"].add_argument("--selection", choices=SELECTIONS, default=SELECTIONS[0])
    command = commands.add_parser("distinct")
    command.add_argument("path")
    command.add_argument("threshold", type=int)
    command.add_argument("--interval")
    command.add_argument("--folder", help="keep the tables here, to go on after a restart")
    command = commands.add_parser("generate")
    command.add_argument("path")
    command.add_argument("n", type=int)
    command.add_argument("k", type=int)
    command.add_argument("--seed", type=int, default=42)
    for name in ("clusters", "fairness", "words", "distinct"):
        commands.choices[name].add_argument("--out", help="write all rows as JSON lines below this folder")
        commands.choices[name].add_argument("--rows", type=int, default=100, help="rows of a table that are shown")
    return parser


def show(name: str, frame, rows: int) -> None:
    """The first rows of a table, and how many there are if that is not all."""
    print(name)
    frame.show(rows, truncate=False)
    total = frame.count()
    if total > rows:
        print(f"{rows} of {total} rows; --out writes all of them")


RUN = {
    "clusters": programs.clusters,
    "fairness": programs.fairness,
    "words": programs.word_report,
    "distinct": programs.distinct_report,
    "generate": programs.generate,
}


def main(argv: list[str] | None = None) -> None:
    options = vars(arguments().parse_args(argv))
    out, rows = options.pop("out", None), options.pop("rows", 100)
    frames = RUN[options.pop("command")](get_session(), **options)
    for name, frame in (frames or {}).items():
        if out:
            frame.write.mode("error").json(f"{out.rstrip('/')}/{name}")
        else:
            show(name, frame, rows)


if __name__ == "__main__":
    main()
