"""``python -m pairclf classify|sweep|words ...``, or the same through spark-submit."""

from __future__ import annotations

import argparse

from .plans.programs import classify, total_words
from .session import build_session, drop_tables


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pairclf")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("classify", "train at the standard shares"), ("sweep", "train at every share of the sweep")):
        command = commands.add_parser(name, help=text)
        command.add_argument("features_dir")
        command.add_argument("features_dir_all")
        command.add_argument("--out", default="output")
        command.add_argument("--strict", action="store_true", help="raise on empty feature files")
        command.add_argument("--seed", default="", help="another seed is another split")
        command.add_argument("--drop-tables", action="store_true", help="delete intermediate tables at the end")
    words = commands.add_parser("words", help="total 'word count' lines")
    words.add_argument("path")
    words.add_argument("--out", default="output/words")
    options = parser.parse_args(arguments)
    spark = build_session()
    if options.command == "words":
        total_words(spark, options.path, options.out)
    else:
        classify(
            spark, options.features_dir, options.features_dir_all, options.out,
            sweep=options.command == "sweep", strict=options.strict, seed=options.seed,
        )
        if options.drop_tables:
            drop_tables(spark)


if __name__ == "__main__":
    main()
