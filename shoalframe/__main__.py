"""python -m shoalframe segment|predict TASK.yaml, or config segment|predict."""

from __future__ import annotations

import argparse
import datetime
import os
import sys

from . import config


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shoalframe")
    parser.add_argument("command", choices=["segment", "predict", "config"])
    parser.add_argument("what", help="a task file, or, for config, a task's name")
    a = parser.parse_args(args)
    if a.command == "config":
        print(config.example(a.what), end="")
        return 0
    task = config.load(a.what, a.command)
    folder = os.path.dirname(os.path.abspath(a.what))
    sys.path.insert(0, folder)
    os.chdir(folder)
    from .plans import tasks
    from .session import session

    spark = session()
    if a.command == "segment":
        tasks.run_segment(spark, task, datetime.datetime.now().isoformat(timespec="seconds"))
    else:
        tasks.run_predict(spark, task)
    return 0


if __name__ == "__main__":
    sys.exit(main())
