"""Command line: ``init``, ``ingest``, ``lists`` and ``search``."""

from __future__ import annotations

import argparse
import json

from lexmill.api import Engine
from lexmill.config import Settings
from lexmill.operators.search import Filters, Request
from lexmill.plans import ingest
from lexmill.session import get_session


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="lexmill")
    top.add_argument("--store", help="folder of the tables")
    commands = top.add_subparsers(dest="command", required=True)
    init = commands.add_parser("init", help="make the tables")
    init.add_argument("--drop-all", action="store_true")
    take = commands.add_parser("ingest", help="ingest a folder of PDF files")
    take.add_argument("--pdf-dir")
    take.add_argument("--limit", type=int, default=0)
    take.add_argument("--retry-failed", action="store_true")
    take.add_argument("--embedding-batch-size", type=int)
    lists = commands.add_parser("lists", help="store the index by inverted lists")
    lists.add_argument("--n-lists", type=int)
    look = commands.add_parser("search", help="find chunks")
    look.add_argument("query")
    look.add_argument("--top-k", type=int, default=10)
    for name, kind in (("year-from", int), ("year-to", int), ("case-type", str), ("outcome", str), ("judge-name", str), ("act-cited", str)):
        look.add_argument(f"--{name}", type=kind)
    given = top.parse_args(args)
    settings = Settings.load()
    spark = get_session()
    if given.command == "ingest":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", given.embedding_batch_size or settings.embedding_batch_size)
    engine = Engine(spark, given.store, settings)
    if given.command == "init":
        engine.store.create(drop=given.drop_all)
    elif given.command == "ingest":
        print(json.dumps(ingest.run(spark, engine.store, given.pdf_dir or settings.pdf_dir, settings, limit=given.limit or None, retry_failed=given.retry_failed)))
    elif given.command == "lists":
        print(json.dumps({"lists": ingest.rebuild_lists(engine.store, given.n_lists or settings.n_lists or 256)}))
    else:
        filters = Filters(given.year_from, given.year_to, given.case_type, given.outcome, given.judge_name, given.act_cited)
        print(engine.search(Request(given.query, given.top_k, filters)).toJSON().first())


if __name__ == "__main__":
    main()
