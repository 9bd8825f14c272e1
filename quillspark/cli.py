"""Command line: ``python -m quillspark.cli COMMAND ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from . import session
from .plans.catalog import Catalog, schema_of_yaml
from .plans.ledger import Ledger
from .plans.pipeline import KINDS, Settings, run
from .sources import readers, sinks


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quillspark", description=__doc__)
    p.add_argument("--database", default="default")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    for name in ("ensure", "show", "drop", "create"):
        c = sub.add_parser(name)
        c.add_argument("names", nargs="*" if name == "ensure" else "+")
        c.add_argument("--yes-i-know", action="store_true")
    c = sub.add_parser("ingest")
    c.add_argument("name")
    c.add_argument("path")
    c.add_argument("--key", required=True, help="columns of the id, with commas")
    c.add_argument("--max-errors", type=int, default=10)
    c = sub.add_parser("run")
    c.add_argument("path")
    c.add_argument("output")
    c.add_argument("--kind", choices=KINDS, default="text")
    c.add_argument("--recursive", action="store_true")
    c.add_argument("--chunk-size", type=int, default=800)
    c.add_argument("--chunk-overlap", type=int, default=100)
    c.add_argument("--formats", default="text,json")
    c.add_argument("--ledger")
    a = p.parse_args(args)
    spark = session.build()
    if a.command == "run":
        docs = readers.load(spark, a.path, a.recursive)
        ledger = Ledger(spark, a.ledger) if a.ledger else None
        docs = ledger.remaining(docs, "source_path") if ledger else docs
        out = run(docs, Settings(kind=a.kind, chunk_size=a.chunk_size, chunk_overlap=a.chunk_overlap))
        sinks.write_formats(out, a.output, tuple(a.formats.split(",")))
        if ledger:
            ledger.add(docs.where(F.col("error").isNull()), "source_path")
            ledger.add(docs.where(F.col("error").isNotNull()), "source_path", "failed")
        return 0
    cat = Catalog(spark, a.database)
    if a.command == "list":
        print("\n".join(cat.list()))
    elif a.command == "ensure":
        print("\n".join(cat.ensure(a.names or None)))
    elif a.command == "create":
        for path in a.names:
            with open(path, encoding="utf-8") as f:
                cat.create(*schema_of_yaml(f.read()))
    elif a.command == "show":
        for n in a.names:
            cat.describe(n).show(200, truncate=False)
    elif a.command == "drop":
        cat.drop(a.names, a.yes_i_know)
    elif a.command == "ingest":
        cat.ingest(a.name, readers.json_lines(spark, a.path), a.key.split(","), a.max_errors)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
